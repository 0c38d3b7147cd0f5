"""What stored steps leave on disk, and how many tasks a turn over few rows takes."""

import pathlib
import time

import brute as B
import pytest
from pyspark.sql import functions as F

from threadloom.llm import common
from threadloom.llm.components import components


def shuffle_files(spark) -> set[str]:
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name for folder in folders for p in pathlib.Path(folder.getPath()).rglob("shuffle_*")}


@pytest.mark.parametrize("how", ["materialize", "stored", "temporary"])
def test_a_stored_step_leaves_no_shuffle_files(spark, how):
    """Each step left its shuffle files until the driver collected garbage: at most 329 MB of pipeline's disk on check_h."""
    before = shuffle_files(spark)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    want = [(k, 143 if k < 6 else 142) for k in range(7)]
    with common.temporary(spark) as keep:
        kept = {"materialize": common.materialize, "stored": lambda df: common.stored(df, "counts"), "temporary": lambda df: keep(df, "counts")}[how](counts)
        until = time.time() + 20
        while (left := shuffle_files(spark) - before) and time.time() < until:  # they go in the background
            time.sleep(0.2)
        assert not left
        assert sorted(map(tuple, kept.collect())) == want
    assert sorted(map(tuple, counts.collect())) == want  # the plan itself can run again
    assert spark.conf.get(common.CLEANUP, "false") == "false"


def test_components_of_few_rows_take_few_tasks(spark):
    """A turn's scans had a task for each partition of the last checkpoint, however few rows it held."""
    links = [(i, i + 1) for i in range(0, 40) if i % 8] + [(100, k) for k in range(50, 100)] + [(7, 7), (3, 2)]
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    context, turns = spark.sparkContext, []
    edges = spark.createDataFrame(links, "a long, b long")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        context.setJobGroup("components-tasks", "components of few rows")
        got = {r["node"]: r["component"] for r in components(edges).collect()}
        tracker = context.statusTracker()
        for job in tracker.getJobIdsForGroup("components-tasks"):
            turns += [tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(job).stageIds if tracker.getStageInfo(s)]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    nodes = {x for a, b in links for x in (a, b) if a != b}
    want = B.components(sorted(nodes), [x for x in links if x[0] != x[1]])
    assert got == {x: want[x] for x in nodes}
    assert sum(turns) < 6000  # 10,449 before
