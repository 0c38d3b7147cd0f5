"""Keep-first removal of repeats and deterministic samples."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window, functions as F

from threadloom import constants as C
from threadloom.functions.text import prefix_key, sampling_key

# Samples up to this many rows may be broadcast to filter a large table.
BROADCAST_SAMPLE = 10_000
# Samples up to this many rows are merged in one task.
ONE_TASK_SAMPLE = 100_000


def keep_first(df: DataFrame, key: str, *order: str) -> DataFrame:
    """First row per key. The planner applies the limit before the shuffle, so a hot key is harmless."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rn", first).where("_rn = 1").drop("_rn")


def prefix_dedup(df: DataFrame, text: str, *order: str) -> DataFrame:
    """Keep the first row per text prefix (lower case, outer white space removed)."""
    return keep_first(df.withColumn("prefix", prefix_key(F.col(text))), "prefix", *order)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = C.SEED) -> DataFrame:
    """Uniform sample of ``n`` rows, all rows when there are fewer; same rows on any partitioning.

    The sample is the first ``n`` rows in the order of a hash of the key, then of a hash of the whole row;
    rows without a key come first. Rows that are still tied are equal. A large sample is cut at a hash
    prefix instead of being sorted into one task: all rows below the prefix, and the first rows of
    the prefix itself, which is made longer until few rows have it.
    """
    content = F.lpad(F.lower(F.hex(F.xxhash64(*_hashable(df)))), 16, "0")
    rank = F.concat(F.coalesce(sampling_key(F.col(key), seed), F.lit("0" * 32)), content)
    if n <= ONE_TASK_SAMPLE:
        return df.orderBy(rank).limit(n)
    taken, edge, inside = 0, "", df
    for digits in range(4, 49, 4):
        prefix = F.substring(rank, 1, digits)
        sizes = inside.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n")).collect()  # at most 65,536 rows
        for name, size in sorted((r["prefix"], r["n"]) for r in sizes):
            if taken + size > n:
                edge = name
                break
            taken += size
        else:
            return df
        inside = df.where(prefix == edge)
        if size <= ONE_TASK_SAMPLE:
            break
    # More rows than that are left only where whole rows are equal.
    rest = inside.orderBy(rank) if size <= ONE_TASK_SAMPLE else inside
    return df.where(prefix < edge).unionByName(rest.limit(n - taken))


def _hashable(df: DataFrame) -> list:
    """The columns that can be hashed: all but maps and variants."""
    return [df[f"`{f.name}`"] for f in df.schema.fields if not ({"map", "variant"} & set(re.findall(r"[a-z]+", f.dataType.simpleString())))]


def sample_threads(turns: DataFrame, n: int = C.THREAD_SAMPLE, seed: int = C.SEED, key: str = "thread_id") -> DataFrame:
    """All turns of ``n`` sampled threads."""
    chosen = sample_rows(turns.select(key).distinct(), key, n, seed)
    if n <= BROADCAST_SAMPLE:
        chosen = F.broadcast(chosen)
    return turns.join(chosen, key, "left_semi")


def golden_sample(pairs: DataFrame, n: int = C.GOLDEN_SAMPLE, seed: int = C.SEED, key: str = "thread_id") -> DataFrame:
    """Sample of question/answer pairs without repeated questions; label columns start empty."""
    candidates = prefix_dedup(pairs, "customer_query", key)
    blank = [F.lit("").alias(c) for c in ("intent", "escalate", "escalation_reason", "notes")]
    sample = sample_rows(candidates, key, n, seed)
    rest = [c for c in pairs.columns if c not in ("brand_response", "brand_seq", "customer_seq")]
    return sample.select(*rest, F.col("brand_response").alias("brand_response_actual"), *blank)


def shortfall(sample: DataFrame, requested: int) -> DataFrame:
    """How many rows a sample has and how many it lacks."""
    rows = sample.agg(F.count("*").alias("n_rows"))
    return rows.select("n_rows", F.greatest(F.lit(0), requested - F.col("n_rows")).alias("shortfall"))


def stratified_sample(df: DataFrame, stratum: str, key: str, quota: int, seed: int = C.SEED) -> DataFrame:
    """Up to ``quota`` rows of every stratum, chosen like :func:`sample_rows`."""
    order = Window.partitionBy(stratum).orderBy(sampling_key(F.col(key), seed), key)
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= quota)
