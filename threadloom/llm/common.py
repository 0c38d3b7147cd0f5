"""Settings and stored intermediate tables shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom import session
from threadloom.session import checkpoint_dir, configure, scratch_path

# Rows of an Arrow batch: long documents must not make a batch of gigabytes.
BATCH_ROWS = 500
# Spark's setting for shuffle files to go with the execution that made them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    checkpoint_dir(spark)
    return spark


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in the block go as soon as it is written, not when the driver next collects
    its garbage. Only for tables that are read from their own files afterwards."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """``session.materialize``, without leaving shuffle files."""
    with shuffles_freed(df.sparkSession):
        return session.materialize(df.select("*"))  # planned anew: plans that are run again need their shuffle files


def _write(df: DataFrame, path: str) -> DataFrame:
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, executors may go."""
    return _write(df, scratch_path(df.sparkSession, name))


@contextmanager
def temporary(spark: SparkSession) -> Iterator:
    """Tables written with the given function go when the block ends, or with ``keep.drop(name)`` before. Where they
    are small, a task reads several of their files, while a checkpoint takes a task for each of its partitions."""
    paths: list[tuple[str, str]] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        paths.append((name, path))
        return _write(df, path)

    def drop(*names: str) -> None:
        for entry in [x for x in paths if x[0] in names]:
            paths.remove(entry)
            where = spark._jvm.org.apache.hadoop.fs.Path(entry[1])
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)

    keep.drop = drop
    try:
        yield keep
    finally:
        drop(*[name for name, _ in paths])


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """The names, lengthened where a column already has one of them in any case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def low_hash(hashed: Column, rows: int, among: Column | int) -> Column:
    """True for a share of all hashes, from the smallest on, that holds the ``rows`` smallest of ``among``: twice
    as many and 1,000 more on average, so that a lack is beyond 30 standard deviations. What is ranked after
    this filter no longer grows with the table; ``among`` may be off by a fifth."""
    wanted = F.lit(2.0 * rows + 1000.0) / F.greatest(F.lit(among) if isinstance(among, int) else among, F.lit(1))
    return hashed.cast("double") <= F.lit(-(2.0**63)) + F.least(F.lit(1.0), wanted) * F.lit(2.0**64)


def held_out(key: str = "doc_id") -> Column:
    """True for rows that no model may learn from: crc32 of the id's text modulo 5 is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def present(df: DataFrame) -> bool:
    return bool(df.take(1))


__all__ = ["prepare", "stored", "temporary", "fresh", "low_hash", "held_out", "present", "materialize", "shuffles_freed"]
