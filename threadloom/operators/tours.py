"""Order of the messages of trees by list ranking, with rows of fixed width at any depth.

The tour of a tree goes down into every message and up out of it again: down to its first child or, where
there is none, up out of itself; from there down to the next sibling or up out of the parent. The tours are
linked lists, two places per message. Each round a place jumps to where its successor points and adds what
lies between, so a list of n places takes log2(n) rounds. A place has one predecessor and keeps at most one,
so no key of these joins is ever hot, however many children a message has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from threadloom.session import materialize, materialize_counted

_PLACE = ["node", "out", "next", "next_out", "ahead", "done"]


def next_siblings(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(src, dst, sibling)`` for every edge, and ``(src, child)`` with the first child of every parent.

    Children are ordered by ``ord``, then ``dst``, in one distributed sort. They are linked inside the pieces
    (parent, sort partition); a popular parent costs one small row per piece to link these."""
    ordered = edges.select("src", "dst", "ord").orderBy("src", "ord", "dst").withColumn("at", F.monotonically_increasing_id())
    ordered = materialize(ordered.withColumn("piece", F.shiftright("at", 33)).drop("ord"))
    heads = ordered.groupBy("src", "piece").agg(F.min_by("dst", "at").alias("head"))
    pieces = Window.partitionBy("src").orderBy("piece")
    heads = heads.select(
        "src", "piece", "head", F.lead("head").over(pieces).alias("onward"), F.row_number().over(pieces).alias("nth")
    )
    following = F.lead("dst").over(Window.partitionBy("src", "piece").orderBy("at"))
    linked = ordered.withColumn("following", following).join(heads, ["src", "piece"])
    return (
        linked.select("src", "dst", F.coalesce("following", "onward").alias("sibling")),
        heads.where("nth = 1").select("src", F.col("head").alias("child")),
    )


def tour_places(edges: DataFrame) -> DataFrame:
    """Both places of every message below a top, with their successors. ``ahead`` counts the ways down from
    a place to just before its successor. The way up out of a top has no row: there the tour ends."""
    siblings, children = next_siblings(edges)
    down = siblings.select(F.col("dst").alias("node")).join(children.withColumnRenamed("src", "node"), "node", "left")
    down = down.select(
        "node", F.lit(False).alias("out"), F.coalesce("child", "node").alias("next"),
        F.col("child").isNull().alias("next_out"), F.lit(1).cast("bigint").alias("ahead"), F.lit(False).alias("done"),
    )
    up = siblings.select(
        F.col("dst").alias("node"), F.lit(True).alias("out"), F.coalesce("sibling", "src").alias("next"),
        F.col("sibling").isNull().alias("next_out"), F.lit(0).cast("bigint").alias("ahead"), F.lit(False).alias("done"),
    )
    return down.unionByName(up)


def rank_messages(edges: DataFrame) -> DataFrame:
    """``(tid, rank)`` of every message below a top; ``edges(src, dst, ord)`` are whole trees.

    ``rank`` falls along the tour from message to message: descending it puts a message before its replies
    and the replies of an earlier sibling before those of a later one, so among the messages of a level it
    gives the order of a queue. It compares messages of one tree only. No edges give no rows; a circle, which no
    top leads to, must be left out before.
    """
    active, finished = materialize(tour_places(edges)), []
    while True:
        onward = reduce(DataFrame.unionByName, [*finished, active]).select(
            F.col("node").alias("next"), F.col("out").alias("next_out"), F.col("next").alias("then"),
            F.col("next_out").alias("then_out"), F.col("ahead").alias("more"), F.col("done").alias("ends"),
        )
        jumped = active.drop("done").join(onward, ["next", "next_out"], "left").select(
            "node", "out", F.coalesce("then", "next").alias("next"), F.coalesce("then_out", "next_out").alias("next_out"),
            (F.col("ahead") + F.coalesce("more", F.lit(0))).alias("ahead"), F.coalesce("ends", F.lit(True)).alias("done"),
        )
        table, counts = materialize_counted(jumped.select(*_PLACE), done=F.col("done"))
        finished.append(table.where("done"))
        active = table.where("NOT done")
        if counts["done"] in (0, counts["rows"]):
            ranked = reduce(DataFrame.unionByName, finished).where("NOT out")
            return ranked.select(F.col("node").alias("tid"), F.col("ahead").alias("rank"))
