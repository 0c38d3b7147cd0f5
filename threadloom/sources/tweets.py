"""Message dump in CSV: all columns text, quoted newlines allowed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from threadloom.functions.text import truthy
from threadloom.schemas import TWEETS

CSV_OPTIONS = {
    "header": True,
    "multiLine": True,
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_tweets(spark: SparkSession, path: str, file_order: bool = False) -> DataFrame:
    """Read the dump. A file with quoted newlines cannot be split, so a large dump should come as
    many files. ``file_order`` adds ``position``, which rises with the files by name and with the
    lines of each file, however Spark packs files into tasks."""
    reader = spark.read.schema(TWEETS).options(**CSV_OPTIONS)
    tweets = reader.csv(path)
    if not file_order:
        return tweets
    # A file is read whole by one task, so the running number of the task rises inside each file.
    lines = tweets.withColumns({"_file": F.col("_metadata.file_path"), "_line": F.monotonically_increasing_id()})
    first = lines.groupBy("_file").agg(F.min("_line").alias("_first"), F.max("_line").alias("_last"))
    # One row per file; a file takes as many numbers as its lines span.
    before = F.sum(F.col("_last") - F.col("_first") + 1).over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    files = first.select("_file", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    placed = lines.join(F.broadcast(files), "_file")
    return placed.withColumn("position", F.col("_line") - F.col("_first") + F.col("_before")).drop("_file", "_line", "_first", "_before")


def write_tweets(tweets: DataFrame, path: str) -> None:
    tweets.select(*TWEETS.fieldNames()).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def with_inbound_flag(tweets: DataFrame) -> DataFrame:
    """``is_inbound`` from the flag text; a dump without that column has customers only."""
    flag = truthy(F.col("inbound")) if "inbound" in tweets.columns else F.lit(True)
    return tweets.withColumn("is_inbound", flag)
