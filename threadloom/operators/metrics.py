"""Classification metrics. Everything follows from one small table of label pair counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from threadloom import constants as C
from threadloom.functions.text import strip_lower, to_taxonomy, truthy_label

LABELS = tuple(sorted(C.INTENTS))


def align(predictions: DataFrame, golden: DataFrame, key: str = "example_id") -> DataFrame:
    """Predictions next to their golden rows; columns of both need different names. Rows that only
    one side has are left out; :func:`unaligned` counts them."""
    return predictions.join(golden, key)


def unaligned(predictions: DataFrame, golden: DataFrame, key: str = "example_id", by: Sequence[str] = ()) -> DataFrame:
    """What :func:`align` leaves out: ``n_predictions`` without a golden row, for each group of ``by``,
    and ``n_golden`` examples of which the group has no prediction."""
    groups = list(by)
    has = predictions.select(*groups, key).withColumn("_p", F.lit(1))
    asked = golden.select(key).where(F.col(key).isNotNull()).distinct()
    total = asked.count()
    met = has.join(asked.withColumn("_g", F.lit(1)), key, "left")
    counts = met.groupBy(*groups).agg(
        F.count_if(F.col("_g").isNull()).alias("n_predictions"),
        F.count_distinct(F.when(F.col("_g").isNotNull(), F.col(key))).alias("_found"))
    return counts.select(*groups, "n_predictions", (F.lit(total) - F.col("_found")).alias("n_golden"))


def unknown_labels(df: DataFrame, label: str) -> DataFrame:
    """Labels outside the taxonomy with their counts."""
    counts = df.select(strip_lower(F.col(label)).alias("label")).groupBy("label").agg(F.count("*").alias("n"))
    return counts.where(~F.coalesce(F.col("label").isin(*LABELS), F.lit(False)))


def pair_counts(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts per (true, predicted) label: at most labels x labels rows per group."""
    labels = df.select(*by, to_taxonomy(F.col(truth)).alias("true_label"), to_taxonomy(F.col(predicted)).alias("pred_label"))
    counts = labels.groupBy(*by, "true_label", "pred_label").agg(F.count("*").alias("n"))
    # At most labels x labels rows: one partition, so that nothing derived from them shuffles again.
    return counts if by else counts.repartition(1)


def _groups(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    return counts.select(*by).distinct() if by else counts.sparkSession.range(1)


def _label_column(name: str) -> Column:
    return F.explode(F.array(*[F.lit(label) for label in LABELS])).alias(name)


def confusion_matrix(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All label pairs in label order, zero where nothing was counted."""
    cells = _groups(counts, by).select(*by, _label_column("true_label"))
    cells = cells.select(*by, "true_label", _label_column("pred_label"))
    filled = cells.join(counts, [*by, "true_label", "pred_label"], "left")
    return filled.select(*by, "true_label", "pred_label", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def confusion_matrix_wide(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per true label, one column per predicted label."""
    wide = confusion_matrix(counts, by).groupBy(*by, "true_label")
    return wide.pivot("pred_label", list(LABELS)).agg(F.sum("n"))


def label_distribution(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per label, for the true and for the predicted side."""
    sides = F.inline(F.array(
        F.struct(F.lit("true").alias("side"), F.col("true_label").alias("label")),
        F.struct(F.lit("pred").alias("side"), F.col("pred_label").alias("label")),
    ))
    return counts.select(*by, "n", sides).groupBy(*by, "side", "label").agg(F.sum("n").alias("n"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def per_class(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every taxonomy label; empty denominators give 0."""
    hit = F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0)
    parts = F.inline(F.array(
        F.struct(F.col("true_label").alias("label"), F.col("n").alias("true_n"), F.lit(0).cast("bigint").alias("pred_n"),
                 hit.cast("bigint").alias("hits")),
        F.struct(F.col("pred_label").alias("label"), F.lit(0).cast("bigint").alias("true_n"), F.col("n").alias("pred_n"),
                 F.lit(0).cast("bigint").alias("hits")),
    ))
    sums = counts.select(*by, parts).groupBy(*by, "label").agg(
        *[F.sum(c).alias(c) for c in ("true_n", "pred_n", "hits")]
    )
    everything = _groups(counts, by).select(*by, _label_column("label")).join(sums, [*by, "label"], "left")
    everything = everything.na.fill(0, ["true_n", "pred_n", "hits"])
    return everything.select(
        *by,
        "label",
        _ratio(F.col("hits"), F.col("pred_n")).alias("precision"),
        _ratio(F.col("hits"), F.col("true_n")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("true_n") + F.col("pred_n")).alias("f1"),
        F.col("true_n").alias("support"),
        "hits",
    )


def intent_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro F1 over the whole taxonomy, support-weighted F1."""
    return intent_summary(per_class(counts, by), by)


def intent_summary(classes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same from the per-class table."""
    return _summary(classes, by).agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        _ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
        F.sum("support").alias("n"),
    )


def _summary(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by) if by else df.groupBy()


def binary_counts(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """True and false positives and negatives of two yes/no columns, in one pass."""
    weight = F.lit(1) if weight is None else weight
    t, p = F.col(truth), F.col(predicted)

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("bigint").alias(name)

    return _summary(df, by).agg(total(t & p, "tp"), total(~t & p, "fp"), total(t & ~p, "fn"), total(~t & ~p, "tn"))


def binary_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1, accuracy and positive rates from the four counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    return counts.select(
        *by,
        F.try_divide(tp + tn, total).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "tp", "fp", "fn", "tn",
        _ratio(tp + fn, total).alias("true_escalation_rate"),
        _ratio(tp + fp, total).alias("predicted_escalation_rate"),
    )


def binary_metrics(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """All numbers about a yes/no decision given as label texts."""
    flags = df.select(*by, truthy_label(F.col(truth)).alias("t"), truthy_label(F.col(predicted)).alias("p"))
    return binary_scores(binary_counts(flags, "t", "p", by), by)


def outcome_counts(
    df: DataFrame, intents: tuple[str, str], decisions: tuple[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Counts per combination of true and predicted intent and decision: one pass over the rows
    feeds the intent and the escalation metrics, and the result is bounded by the label set."""
    outcomes = df.select(
        *by,
        to_taxonomy(F.col(intents[0])).alias("true_label"), to_taxonomy(F.col(intents[1])).alias("pred_label"),
        truthy_label(F.col(decisions[0])).alias("t"), truthy_label(F.col(decisions[1])).alias("p"),
    )
    return outcomes.groupBy(*by, "true_label", "pred_label", "t", "p").agg(F.count("*").alias("n"))


def cohen_kappa(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Agreement beyond chance of two label columns."""
    same = F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0).cast("bigint")
    none = F.lit(0).cast("bigint")
    sides = F.inline(F.array(
        F.struct(F.col("true_label").alias("label"), F.col("n").alias("a"), none.alias("b"), same.alias("same")),
        F.struct(F.col("pred_label").alias("label"), none.alias("a"), F.col("n").alias("b"), none.alias("same")),
    ))
    margins = counts.select(*by, sides).groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("a", "b", "same")])
    totals = _summary(margins, by).agg(
        F.sum(F.col("a").cast("double") * F.col("b")).alias("ab"), F.sum("a").alias("n"), F.sum("same").alias("same")
    )
    po = F.try_divide(F.col("same"), F.col("n"))
    pe = F.try_divide(F.col("ab"), F.col("n").cast("double") * F.col("n"))
    return totals.select(*by, po.alias("observed"), pe.alias("expected"), F.try_divide(po - pe, 1 - pe).alias("kappa"))


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Floating columns rounded for a report."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name)
        for f in df.schema.fields
    ])
