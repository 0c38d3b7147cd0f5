"""Connected components of an edge table, as shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.llm.common import materialize, present, temporary


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node it is connected to.

    Alternating star contraction: every node hands its smallest neighbour to its larger neighbours,
    then to its smaller ones, until only stars are left; the number of rounds grows with the
    logarithm of the longest path. Both steps are a minimum per node, combined before the shuffle,
    and an equi-join that adaptive execution splits where a node has very many neighbours.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    with temporary(edges.sparkSession) as keep:
        turn = 0
        pairs = keep(pairs, "pairs-0")
        if not present(pairs):
            return materialize(pairs.select(F.col("a").alias("node"), F.col("b").alias("component")))
        before = _state(pairs)
        while True:
            both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
            # In each pair a is the larger. Nodes below all their neighbours keep their place through the neighbours' edges.
            large = pairs.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least, "a")
            large = large.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
            least = large.groupBy("a").agg(F.min("b").alias("least"))
            small = large.join(least, "a").select(F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("least").alias("b"))
            turn += 1
            pairs = keep(small.filter("a <> b").distinct(), f"pairs-{turn}")
            keep.drop(f"pairs-{turn - 1}")
            now = _state(pairs)
            if now == before:
                break
            before = now
        roots = pairs.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
        return materialize(pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots))


def _state(pairs: DataFrame) -> tuple:
    """Equal for equal tables: the number of pairs and the sum of their hashes."""
    return pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
