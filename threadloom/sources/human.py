"""Scoring sheet that people fill in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.constants import DIMENSIONS
from threadloom.schemas import HUMAN_SHEET
from threadloom.sources.tweets import CSV_OPTIONS


def write_human_sheet(sheet: DataFrame, path: str) -> None:
    sheet.select(*HUMAN_SHEET.fieldNames()).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_human_scores(spark: SparkSession, path: str) -> DataFrame:
    """Rows with a helpfulness score, all scores as whole numbers."""
    sheet = spark.read.schema(HUMAN_SHEET).options(**CSV_OPTIONS).csv(path)
    scores = [F.col(f"human_{d}").try_cast("int").alias(f"human_{d}") for d in DIMENSIONS]
    scored = sheet.where(F.coalesce(F.col("human_helpfulness"), F.lit("")) != "")
    return scored.select(F.col("index").try_cast("bigint").alias("example_id"), *scores)
