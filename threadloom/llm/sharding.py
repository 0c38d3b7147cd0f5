"""Shards and slots from a permutation of global row numbers; column functions only.

Rows are numbered by one range partitioning on the given order. A Feistel network over a grid of
a x b cells, walked along its cycle until it lands below the number of rows, permutes the numbers.
The permuted number gives the shard (modulo) and the slot (quotient), so counts differ by one at
most, and both can be computed, forwards and backwards, without the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import fresh, materialize, prepare

ROUNDS = 6


def _grid(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid of n cells or more."""
    a = max(1, math.isqrt(n))
    return a, max(1, -(-n // a))


def _push(half: Column, seed: int, number: int, modulus: int) -> Column:
    return F.pmod(F.xxhash64(half, F.lit(seed), F.lit(number)), F.lit(modulus).cast("bigint"))


def feistel(x: Column, n: int, seed: int, inverse: bool = False) -> Column:
    """One pass over the grid: the halves are moved in turn by a hash of the other half."""
    a, b = _grid(n)
    left = F.call_function("div", x, F.lit(b))
    state = F.struct(left.cast("bigint").alias("l"), (x % F.lit(b)).cast("bigint").alias("r"))

    def step(s: Column, i: int) -> Column:
        sign = -1 if inverse else 1
        if i % 2 == 0:
            moved = F.pmod(s["l"] + sign * _push(s["r"], seed, i, a), F.lit(a).cast("bigint"))
            return F.struct(moved.alias("l"), s["r"].alias("r"))
        moved = F.pmod(s["r"] + sign * _push(s["l"], seed, i, b), F.lit(b).cast("bigint"))
        return F.struct(s["l"].alias("l"), moved.alias("r"))

    # A fold keeps each round one evaluation; nested columns would double with every round.
    order = reversed(range(ROUNDS)) if inverse else range(ROUNDS)
    numbers = F.array(*(F.lit(i) for i in order))

    def fold(s: Column, i: Column) -> Column:
        chosen = step(s, ROUNDS - 1)
        for k in range(ROUNDS - 1):
            chosen = F.when(i == k, step(s, k)).otherwise(chosen)
        return chosen

    return F.aggregate(numbers, state, fold, lambda s: s["l"] * F.lit(b) + s["r"])


def permute(df: DataFrame, column: str, out: str, n: int, seed: int, inverse: bool = False) -> DataFrame:
    """Add ``out``: the permutation of 0 .. n - 1 applied to ``column``.

    The grid has under sqrt(n) + 1 spare cells, and a cycle leaves them after as many steps at most,
    so the walk always ends inside. Only the few rows that land on a spare cell take any steps.
    """
    a, b = _grid(n)
    spare = a * b - n
    once = df.withColumn(out, feistel(F.col(column), n, seed, inverse))
    if spare == 0:
        return once
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(spare)), F.col(out),
        lambda at, _: F.when(at >= n, feistel(at, n, seed, inverse)).otherwise(at),
    )
    return once.withColumn(out, F.when(F.col(out) >= n, walk).otherwise(F.col(out)))


def number_rows(df: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """Add ``row_number`` 0, 1, 2, ... in the given order, and count the rows.

    One range partitioning; the partition sizes (one row each) give the offsets. Fully equal rows
    take their numbers in any order. The rows are stored in between, so that a lost executor cannot
    deal them out anew.
    """
    # The place in the source breaks the ties of equal rows, so that no hot key fills a partition.
    tie, at, part, before = fresh(df.columns, "_tie", "_id", "_part", "_before")
    placed = df.withColumn(tie, F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(*order, F.col(tie)).sortWithinPartitions(*order, tie).drop(tie)
    local = materialize(dealt.withColumn(at, F.monotonically_increasing_id()))
    number = F.shiftrightunsigned(at, 33).cast("long")
    sizes = {r["part"]: r["n"] for r in local.groupBy(number.alias("part")).agg(F.count("*").alias("n")).collect()}  # one per partition
    total, offsets = 0, []
    for own in sorted(sizes):
        offsets.append((own, total))
        total += sizes[own]
    table = df.sparkSession.createDataFrame(offsets, f"{part} long, {before} long")
    numbered = local.withColumn(part, number).join(F.broadcast(table), part)
    row = F.col(before) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn("row_number", row).drop(part, before, at), total


def assign_shards(df: DataFrame, order: list[str], shards: int = 16, seed: int = 20240601) -> DataFrame:
    """Add ``row_number``, ``shard`` and ``slot`` to every row.

    Counts of the shards differ by one at most; slots run from 0 without gaps. Null keys sort first,
    rows that are equal in all order columns are told apart by their place in the source. An empty
    table gives no rows. Columns already called row_number, shard or slot are replaced.
    """
    prepare(df.sparkSession)
    df = df.drop("row_number", "shard", "slot")
    numbered, n = number_rows(df, [F.col(c) for c in order])
    if n == 0:
        return numbered.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("bigint")})
    [place] = fresh(numbered.columns, "_at")
    at = permute(numbered, "row_number", place, n, seed)
    return at.select(
        *numbered.columns, (F.col(place) % shards).cast("int").alias("shard"),
        F.call_function("div", F.col(place), F.lit(shards)).cast("bigint").alias("slot"),
    )


def locate(places: DataFrame, n: int, shards: int = 16, seed: int = 20240601) -> DataFrame:
    """Add ``row_number`` to rows with ``shard`` and ``slot``: the permutation backwards."""
    [place] = fresh(places.columns, "_at")
    at = places.withColumn(place, F.col("slot") * shards + F.col("shard"))
    return permute(at, place, "row_number", n, seed, inverse=True).drop(place)
