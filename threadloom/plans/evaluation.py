"""Evaluation of one or more systems against golden rows, as one long metric table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.text import percent, two_decimals
from threadloom.operators import metrics, raters
from threadloom.session import materialize

SYSTEM = ("system",)
SYSTEMS = ("pipeline", "simple_baseline", "trivial_baseline")
MISSING = "N/A"


def _melt(df: DataFrame, family: str, names: Sequence[str], label: Column | None = None) -> DataFrame:
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names]
    label = F.lit("") if label is None else label
    long = df.select("system", F.lit(family).alias("family"), label.alias("class"), F.inline(F.array(*entries)))
    return long.select("system", "family", "metric", "class", "value")


def evaluate(
    predictions: DataFrame, golden: DataFrame, judge: DataFrame | None = None, human: DataFrame | None = None
) -> DataFrame:
    """Long table ``(system, family, metric, class, value)``.

    The rows are read once: every metric follows from one stored table of outcome counts, which has
    at most labels x labels x 4 rows per system and so fits one partition.

    ``predictions`` carries a ``system`` column, so all systems share each aggregate. ``judge`` is
    ``(system, example_id, ratings)``; with a filled ``human`` sheet the agreement is reported too.
    """
    truth = golden.select("example_id", F.col("intent").alias("gold_intent"), F.col("escalate").alias("gold_escalate"))
    aligned = metrics.align(predictions.select("system", "example_id", "intent", "escalate"), truth)
    outcomes = metrics.outcome_counts(
        aligned, ("gold_intent", "intent"), ("gold_escalate", "escalate"), SYSTEM
    )
    outcomes = materialize(outcomes.repartition(1))
    counts = outcomes.groupBy("system", "true_label", "pred_label").agg(F.sum("n").alias("n"))
    classes = metrics.per_class(counts, SYSTEM)
    matrix = metrics.confusion_matrix(counts, SYSTEM)
    spread = metrics.label_distribution(counts, SYSTEM)
    binary = metrics.binary_scores(metrics.binary_counts(outcomes, "t", "p", SYSTEM, F.col("n")), SYSTEM)
    parts = [
        _melt(metrics.intent_summary(classes, SYSTEM), "intent", ("accuracy", "macro_f1", "weighted_f1", "n")),
        _melt(classes, "intent_class", ("precision", "recall", "f1", "support"), F.col("label")),
        _melt(matrix, "confusion", ("n",), F.concat_ws("->", "true_label", "pred_label")),
        _melt(spread, "distribution", ("n",), F.concat_ws(":", "side", "label")),
        _melt(binary, "escalation", [c for c in binary.columns if c != "system"]),
    ]
    if judge is not None:
        quality = raters.judge_aggregate(judge, SYSTEM)
        parts.append(_melt(quality, "reply_quality", ("mean", "std", "n_judged"), F.col("dimension")))
        if human is not None:
            main = judge.where(F.col("system") == SYSTEMS[0])
            agreement = raters.human_agreement(main, human).withColumn("system", F.lit(SYSTEMS[0]))
            names = ("pearson_r", "pearson_p", "spearman_r", "spearman_p", "n_samples")
            parts.append(_melt(agreement, "human_agreement", names, F.col("dimension")))
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    return long


def system_comparison(long: DataFrame, systems: Sequence[str] = SYSTEMS) -> DataFrame:
    """One row per metric, one column per system."""
    return long.groupBy("family", "metric", "class").pivot("system", list(systems)).agg(F.first("value"))


# Report sections: (section, family, metric, class), percentages except for reply quality.
REPORT_LINES = (
    ("Accuracy", "intent", "accuracy", ""),
    ("Macro F1", "intent", "macro_f1", ""),
    ("F1", "escalation", "f1", ""),
    ("Precision", "escalation", "precision", ""),
    ("Recall", "escalation", "recall", ""),
    ("Helpfulness", "reply_quality", "mean", "helpfulness"),
    ("Tone", "reply_quality", "mean", "tone"),
    ("Groundedness", "reply_quality", "mean", "groundedness"),
    ("Overall", "reply_quality", "mean", "overall"),
)


def report_rows(long: DataFrame, systems: Sequence[str] = SYSTEMS) -> DataFrame:
    """The report's result tables as text cells; a system without a value shows N/A."""
    lines = F.inline(F.array(*[
        F.struct(F.lit(i).alias("line"), F.lit(title).alias("title"), F.lit(family).alias("family"),
                 F.lit(metric).alias("metric"), F.lit(label).alias("class"))
        for i, (title, family, metric, label) in enumerate(REPORT_LINES)
    ]))
    wanted = long.sparkSession.range(1).select(lines)
    cells = F.broadcast(wanted).join(system_comparison(long, systems), ["family", "metric", "class"], "left")
    texts = [
        F.when(F.col("family") == "reply_quality", two_decimals(F.col(s))).otherwise(percent(F.col(s))).alias(s)
        for s in systems
    ]
    return cells.select("line", "family", "title", *texts)


def per_class_report(long: DataFrame, system: str = SYSTEMS[0]) -> DataFrame:
    """Per-class table of one system, whole percents and a plain support count."""
    rows = long.where((F.col("system") == system) & (F.col("family") == "intent_class"))
    wide = rows.groupBy("class").pivot("metric", ["precision", "recall", "f1", "support"]).agg(F.first("value"))
    shown = [percent(F.col(m), 0).alias(m) for m in ("precision", "recall", "f1")]
    return wide.select("class", *shown, F.col("support").cast("bigint").alias("support"))
