"""Keyed tables: write once, reuse while the key is the same, append without repeating keys."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

# Bytes of vectors per bucket of a vector table.
BUCKET_BYTES = 256 << 20


def table_path(base: str, name: str, **key: object) -> str:
    """Path that changes with every parameter that changes the content."""
    parts = [f"{k}={key[k]}" for k in sorted(key)]
    digest = hashlib.md5("&".join(parts).encode()).hexdigest()[:12]
    return f"{base}/{name}-{digest}"


def input_state(df: DataFrame) -> str:
    """A digest of what a table holds: for one read from files their names, sizes and times of change
    with the plan over them, else the count and the sum of hashes of its rows.

    Files are looked up by a scan that gives a row per file and opens none; only its count and sum of
    hashes reach the driver. The plan is written out in full, however many columns or values it names."""
    spark, files = df.sparkSession, df.inputFiles()
    if not files:
        return _digest(df.columns, _content(df))
    found = spark.read.format("binaryFile").option("__globPaths__", "false").load([unquote(f) for f in files])
    return _digest(_content(found.select("path", "length", "modificationTime")), _plan_text(df))


def _content(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)"))).first())


def _digest(*parts: object) -> str:
    return hashlib.md5("\n".join(map(str, parts)).encode()).hexdigest()[:12]


def _plan_text(df: DataFrame) -> str:
    conf, fields = df.sparkSession.conf, "spark.sql.debug.maxToStringFields"
    usual = conf.get(fields)
    conf.set(fields, str(2**31 - 1))
    try:
        return str(df._jdf.queryExecution().optimizedPlan().canonicalized())
    finally:
        conf.set(fields, usual)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a finished write left its success mark; a broken write does not count."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the table at ``path``; build and write it first when there is no finished one."""
    if not is_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _vector_table(path: str) -> str:
    return f"threadloom_vectors_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def write_vectors(df: DataFrame, path: str, key: str = "thread_id", vector: str = "embedding", buckets: int | None = None) -> None:
    """Vector table in buckets of ``key``, sorted by it, one file per bucket. Unless ``buckets`` is given, the
    number follows from the rows and the widest vector. ``path``-layout keeps it with the columns, so that
    :func:`read_vectors` finds both in any session, also of an empty table."""
    if buckets is None:
        rows, width = df.agg(F.count("*"), F.coalesce(F.max(F.size(vector)), F.lit(0))).first()
        buckets = max(1, math.ceil(rows * max(width, 1) * 8 / BUCKET_BYTES))
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).saveAsTable(_vector_table(path), format="parquet")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    layout = df.sparkSession.createDataFrame([(columns, key, buckets)], "columns string, key string, buckets int")
    layout.coalesce(1).write.mode("overwrite").json(f"{path}-layout")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """A table of :func:`write_vectors` with its buckets: a join or a grouping by its key does not shuffle it."""
    layout, name = spark.read.json(f"{path}-layout").first(), _vector_table(path)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # an entry of the catalog; the files stay
    spark.sql(
        f"CREATE TABLE {name} ({layout['columns']}) USING parquet CLUSTERED BY (`{layout['key']}`) "
        f"SORTED BY (`{layout['key']}`) INTO {layout['buckets']} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)


def write_metrics(metrics: DataFrame, path: str, fmt: str = "parquet") -> None:
    metrics.write.mode("overwrite").partitionBy("system").format(fmt).save(path)
