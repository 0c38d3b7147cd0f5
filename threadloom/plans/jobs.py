"""The user-facing steps: data, golden set, evaluation, report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom import constants as C
from threadloom.operators import pairs, predictions as P, retrieval, sampling, threads
from threadloom.operators.failures import failure_report, find_failures
from threadloom.operators.raters import human_sheet
from threadloom.plans import evaluation
from threadloom.session import configure
from threadloom.sources.golden import write_golden_csv, write_golden_json
from threadloom.sources.human import write_human_sheet
from threadloom.sources.tables import input_state, read_or_build, table_path, write_metrics


def build_conversations(
    spark: SparkSession, tweets: DataFrame, base: str, brand: str,
    n: int = C.THREAD_SAMPLE, seed: int = C.SEED, **options,
) -> DataFrame:
    """Data step: rebuild the brand's threads, sample, store. A table made with the same arguments
    from the same input files is reused; a changed input makes a new one."""
    configure(spark)

    def build() -> DataFrame:
        return threads.build_threads(tweets, brand, sample=(n, seed), **options)

    key = {"brand": brand.lower(), "n": n, "seed": seed, "input": input_state(tweets), **options}
    return read_or_build(spark, table_path(base, "turns", **key), build)


def build_golden(turns: DataFrame, n: int = C.GOLDEN_SAMPLE, seed: int = C.SEED) -> DataFrame:
    """Golden step: pairs, repeats removed, sampled; threads are told apart by their full root id."""
    found = pairs.first_pairs(turns, "root_id", carry=("thread_id",))
    sample = sampling.golden_sample(found, n, seed, key="root_id")
    return sample.withColumn("example_id", F.xxhash64("root_id"))


def label_golden(golden: DataFrame, responses: DataFrame) -> DataFrame:
    """Put proposed labels into the golden rows; a response that does not parse leaves them empty."""
    answers = responses.where(F.col("stage") == "label").select("example_id", "response")
    labels = P.parse_labels(golden.select("example_id").join(answers, "example_id", "left"))
    blank = ("intent", "escalate", "escalation_reason")
    return golden.drop(*blank).join(labels.drop("response"), "example_id")


def save_golden(golden: DataFrame, turns: DataFrame, csv_path: str, json_path: str) -> None:
    """Flat CSV, and JSON with one row per example and the whole threads in pages."""
    write_golden_csv(golden, csv_path)
    chosen = turns.join(golden.select("root_id"), "root_id", "left_semi")
    write_golden_json(golden, pairs.thread_pages(chosen, ("root_id",)), json_path)


def build_index(turns: DataFrame, vectors: DataFrame) -> DataFrame:
    """Retrieval documents: question, answer, first turns and the unit vector."""
    found = pairs.first_pairs(turns, "root_id", carry=("thread_id",))
    context = pairs.thread_context(turns, C.CONTEXT_TURNS, "root_id").withColumnRenamed("context", "full_thread")
    return retrieval.retrieval_corpus(found, vectors, "root_id").join(context, "root_id")


def evaluate_systems(
    golden: DataFrame, systems: Mapping[str, DataFrame], judge: DataFrame | None = None,
    human: DataFrame | None = None, metrics_path: str | None = None, sheet_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Evaluation step: the long metric table of all systems, and the main system's worst failures."""
    tagged = None
    for name, rows in systems.items():
        rows = rows.select(F.lit(name).alias("system"), "example_id", "intent", "escalate")
        tagged = rows if tagged is None else tagged.unionByName(rows)
    long = evaluation.evaluate(tagged, golden, judge, human)
    main = systems[evaluation.SYSTEMS[0]]
    ratings = None if judge is None else judge.where(F.col("system") == evaluation.SYSTEMS[0])
    if metrics_path:
        write_metrics(long, metrics_path)
        long = long.sparkSession.read.parquet(metrics_path).select(*long.columns)
    if sheet_path:
        write_human_sheet(human_sheet(main, golden), sheet_path)
    return long, find_failures(main, golden, ratings)


def report(long: DataFrame, failures: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Report step: result table, per-class table and explained failures as rows."""
    return evaluation.report_rows(long), evaluation.per_class_report(long), failure_report(failures)

