"""Golden examples: flat CSV for people, JSON with the whole thread for programs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.schemas import GOLDEN_CSV, TURN
from threadloom.sources.tweets import CSV_OPTIONS

_OPTIONS = {k: v for k, v in CSV_OPTIONS.items() if k != "nullValue"} | {"nullValue": "\u0000"}


def write_golden_csv(golden: DataFrame, path: str) -> None:
    """The seven flat columns; other columns are dropped, NULL is written as empty text."""
    columns = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in GOLDEN_CSV.fieldNames()]
    golden.select(*columns).write.mode("overwrite").options(**_OPTIONS).csv(path)


def read_golden_csv(spark: SparkSession, path: str) -> DataFrame:
    """Golden rows; an empty cell is empty text, not NULL."""
    rows = spark.read.schema(GOLDEN_CSV).options(**_OPTIONS).csv(path)
    return rows.na.fill("")


def write_golden_json(golden: DataFrame, pages: DataFrame, path: str, key: str = "root_id") -> None:
    """Two tables: one row per golden example, and the pages of the whole threads beside it, so that
    the length of a thread does not change the number of examples."""
    golden.write.mode("overwrite").json(f"{path}/examples")
    pages.select(key, "page", F.col("turns").alias("full_thread")).write.mode("overwrite").json(f"{path}/threads")


def read_golden_json(spark: SparkSession, path: str) -> DataFrame:
    """The golden examples, one row each."""
    schema = f"{GOLDEN_CSV.toDDL()}, auto_labeled BOOLEAN, root_id STRING, example_id BIGINT"
    return spark.read.schema(schema).json(f"{path}/examples")


def read_golden_threads(spark: SparkSession, path: str, key: str = "root_id") -> DataFrame:
    """The whole threads of the golden examples in pages; examples join them by the key."""
    return spark.read.schema(f"{key} STRING, page BIGINT, full_thread ARRAY<STRUCT<{_fields(TURN)}>>").json(f"{path}/threads")


def with_example_ids(edited: DataFrame, golden: DataFrame) -> DataFrame:
    """Rows of an edited CSV with the ids of the golden set they came from, for the evaluation.

    People see the short ``thread_id``; where two examples share one, the question tells them apart.
    Rows that fit no example, or several, stop the job."""
    ids = golden.select("thread_id", F.coalesce("customer_query", F.lit("")).alias("customer_query"), "root_id", "example_id")
    ids = ids.groupBy("thread_id", "customer_query").agg(F.collect_set(F.struct("root_id", "example_id")).alias("_ids"))
    joined = edited.join(ids, ["thread_id", "customer_query"], "left")
    lost = F.raise_error(F.concat(F.lit("golden row without its example: "), F.col("thread_id"))).cast("string")
    one = F.when(F.size("_ids") == 1, F.lit("ok")).otherwise(lost)
    return joined.withColumn("_found", one).where("_found = 'ok'").select(*edited.columns, F.col("_ids")[0]["root_id"].alias("root_id"), F.col("_ids")[0]["example_id"].alias("example_id"))


def _fields(struct) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in struct.fields)
