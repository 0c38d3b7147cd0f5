"""A large table dealt into blocks that are sent to all executors one after the other."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.session import scratch_path


class Rotation:
    """Blocks of about ``block_rows`` rows of a table, and the results kept for each.

    The table is written once, a folder per block, so a turn reads its own rows only. The turn's
    block is on the driver and in a broadcast while it lasts; its result is added to a stored table,
    so a turn cuts the lineage of the ones before. ``block`` may deal the rows in another way than by
    the hash of their id, as numbers below ``turns``.
    """

    def __init__(self, table: DataFrame, block_rows: int, rows: int, block: Column | None = None, turns: int | None = None):
        self.spark = table.sparkSession
        self.turns = turns if turns is not None else max(1, -(-rows // block_rows))
        self.columns = table.columns
        dealt = block if block is not None else F.pmod(F.xxhash64("id"), F.lit(self.turns))
        self.path, self.found = scratch_path(self.spark, "turns"), scratch_path(self.spark, "turn-results")
        placed = table.withColumn("turn", dealt.cast("int")).repartition(F.col("turn"))
        placed.write.partitionBy("turn").parquet(self.path)
        self.stored = self.spark.read.schema(placed.schema).parquet(self.path)

    def __iter__(self) -> Iterator[pa.Table]:
        for turn in range(self.turns):
            block = self.stored.where(F.col("turn") == turn).select(*self.columns).toArrow()
            if block.num_rows:
                yield block

    def keep(self, result: DataFrame) -> None:
        """Add the result of a turn to those of the turns before."""
        result.write.mode("append").parquet(self.found)

    def result(self, schema: str) -> DataFrame:
        """The results of all turns."""
        empty = self.spark.createDataFrame([], schema)
        empty.write.mode("append").parquet(self.found)  # a folder is there without any turn
        return self.spark.read.schema(schema).parquet(self.found)
