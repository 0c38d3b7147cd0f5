"""Session settings and durable scratch space shared by the operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# Runtime SQL settings the operators rely on; everything else stays as the cluster set it.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when a later aggregate then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Limit every "row_number() <= k" inside the map tasks, also for large k.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # JSON objects with a repeated key parse, the last value wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Keyed state of streams on disk; a batch writes what it changes.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "threadloom", master: str | None = None, **settings: str) -> SparkSession:
    """Create a session; ``settings`` use underscores for dots in the key."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    # Checkpoints go when the tables read from them are gone.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return configure(builder.getOrCreate())


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a private one only for local masters."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="threadloom-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so that lost executors cost no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """Checkpoint, and count rows (``rows``) and conditions on the way, without one more job."""
    watch = Observation(f"threadloom-{uuid.uuid4().hex}")
    measures = [F.count_if(condition).alias(name) for name, condition in counts.items()]
    kept = materialize(df.observe(watch, F.count("*").alias("rows"), *measures))
    return kept, watch.get


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table written and read back."""
    return os.path.join(checkpoint_dir(spark), "threadloom", f"{name}-{uuid.uuid4().hex}")
