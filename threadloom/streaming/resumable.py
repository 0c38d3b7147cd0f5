"""Predictions that continue after a crash: append what is missing, in batch or as a stream."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from threadloom.operators.predictions import pending
from threadloom.session import configure, materialize
from threadloom.sources.tables import is_complete

Scorer = Callable[[DataFrame], DataFrame]


def one_per_key(queries: DataFrame, key: str | list[str]) -> DataFrame:
    """The rule of both ways: one row for each key, the first by the hash of its content, whatever
    the partitioning; a row without a key stops the run, for its result could never be found again."""
    keys = [key] if isinstance(key, str) else list(key)
    bad = reduce(or_, [F.col(k).isNull() for k in keys])
    checked = queries.withColumn("_bad", F.when(bad, F.raise_error(F.lit("a query without a key")).cast("int")).otherwise(0))
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(*queries.columns))
    first = checked.where("_bad = 0").withColumn("_rn", F.row_number().over(order)).where("_rn = 1")
    return first.select(*queries.columns)


def run_pending(queries: DataFrame, score: Scorer, sink: str, key: str | list[str] = "example_id") -> int:
    """Score the queries the sink lacks and append them; returns how many rows the sink has now.
    A stored result is never computed again, and a new query is found by its key, not its place."""
    spark = queries.sparkSession
    queries = one_per_key(queries, key)
    if is_complete(spark, sink):
        queries = pending(queries, spark.read.parquet(sink), key)
    score(queries).write.mode("append").parquet(sink)
    return spark.read.parquet(sink).count()


def start_scoring(
    spark: SparkSession, source: str, schema: StructType, score: Scorer, sink: str, checkpoint: str,
    key: str | list[str] = "example_id", files_per_batch: int = 1_000, file_pattern: str = "*",
) -> StreamingQuery:
    """Score new query files until none is left. ``source`` is a folder of files, or one file.

    The keys of earlier micro-batches are in the stream's state store, so a batch costs what its own rows
    cost and the sink is never read. Every micro-batch owns one folder of the sink and replaces it when it
    is run again, on the state of the batch before: a restart neither loses nor repeats a key.
    """
    configure(spark)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    queries = reader.option("pathGlobFilter", file_pattern).parquet(_listed(spark, source))

    def write(batch: DataFrame, batch_id: int) -> None:
        # Stored first: whatever the scorer does with the rows, the state is asked once.
        fresh = materialize(rows_of_new_keys(batch, key))
        score(fresh).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    return (
        with_new_keys(queries, key).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _listed(spark: SparkSession, source: str) -> str:
    """The source as Spark's file stream lists it: a folder stays, one file becomes a pattern that fits it alone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path) or files.getFileStatus(path).isDirectory():
        return source
    return f"{source[:-1]}[{source[-1]}]"


def with_new_keys(queries: DataFrame, key: str | list[str]) -> DataFrame:
    """The rows of a stream, and beside them a row ``_new`` for each key that no micro-batch had before.
    The state holds the keys alone, not what the rows say."""
    keys = [key] if isinstance(key, str) else list(key)
    bad = reduce(or_, [F.col(k).isNull() for k in keys])
    checked = queries.withColumn("_new", F.when(bad, F.raise_error(F.lit("a query without a key")).cast("boolean")).otherwise(False))
    seen_first = queries.select(*keys).dropDuplicates(keys).withColumn("_new", F.lit(True))
    return checked.unionByName(seen_first, allowMissingColumns=True)


def rows_of_new_keys(batch: DataFrame, key: str | list[str]) -> DataFrame:
    """One row for each new key of a micro-batch, chosen as ``one_per_key`` does."""
    keys = [key] if isinstance(key, str) else list(key)
    names = [c for c in batch.columns if c != "_new"]
    own = Window.partitionBy(*keys)
    place = F.row_number().over(own.orderBy("_new", F.xxhash64(*names)))
    marked = batch.withColumns({"_known": F.max("_new").over(own), "_rn": place})
    return marked.where("_known AND _rn = 1").select(*names)
