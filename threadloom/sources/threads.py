"""Rebuilt threads as JSON lines of bounded pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.operators.pairs import thread_pages
from threadloom.schemas import THREAD_PAGES, TURNS


def write_threads(turns: DataFrame, path: str) -> None:
    thread_pages(turns, keys=("thread_id", "root_id", "brand")).write.mode("overwrite").json(path)


def read_threads(spark: SparkSession, path: str) -> DataFrame:
    """Turns again, one row each."""
    pages = spark.read.schema(THREAD_PAGES).json(path)
    return pages.select("thread_id", "root_id", "brand", F.inline("turns")).select(*TURNS.fieldNames())
