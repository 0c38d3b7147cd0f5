"""Worst predictions and their explanation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from threadloom import constants as C
from threadloom.functions.text import truthy


def score_failures(predictions: DataFrame, golden: DataFrame, judge: DataFrame | None = None) -> DataFrame:
    """Every prediction with an error, its kinds of error and their weight.

    A wrong intent weighs 2, a wrong escalation 2, a judge mean of 2 or less its distance from 3.
    """
    rows = predictions.select(
        "example_id", "query", F.col("intent").alias("prediction_intent"), F.col("escalate").alias("pred_escalate")
    ).join(
        golden.select("example_id", F.col("intent").alias("golden_intent"), F.col("escalate").alias("gold_escalate")),
        "example_id",
    )
    if judge is None:
        rows = rows.withColumn("overall", F.lit(None).cast("double"))
    else:
        rows = rows.join(judge.select("example_id", "overall"), "example_id", "left")

    intent_wrong = F.lower("prediction_intent") != F.lower("golden_intent")
    pred_yes, gold_yes = truthy(F.col("pred_escalate")), truthy(F.col("gold_escalate"))
    escalation_wrong = pred_yes != gold_yes
    poor = F.coalesce(F.col("overall") <= 2, F.lit(False))
    intent_text = F.concat(
        F.lit("Intent: predicted '"), "prediction_intent", F.lit("' vs actual '"), "golden_intent", F.lit("'")
    )
    direction = F.when(pred_yes, "Escalation: over-escalated").otherwise("Escalation: under-escalated")
    quality = F.concat(F.lit("Reply quality: "), F.col("overall").cast("string"), F.lit("/5"))
    found = F.array(F.when(intent_wrong, intent_text), F.when(escalation_wrong, direction), F.when(poor, quality))
    score = (
        F.when(intent_wrong, 2.0).otherwise(0.0)
        + F.when(escalation_wrong, 2.0).otherwise(0.0)
        + F.when(poor, 3.0 - F.col("overall")).otherwise(0.0)
    )
    scored = rows.select(
        "example_id", "query", score.alias("error_score"), F.array_compact(found).alias("error_types"),
        "prediction_intent", "golden_intent", "overall",
    )
    return scored.where(F.size("error_types") > 0)


def find_failures(
    predictions: DataFrame, golden: DataFrame, judge: DataFrame | None = None, top_n: int = C.TOP_FAILURES
) -> DataFrame:
    """The ``top_n`` heaviest failures, earlier examples first among equals."""
    scored = score_failures(predictions, golden, judge)
    return scored.orderBy(F.desc("error_score"), "example_id").limit(top_n)


def failure_report(
    failures: DataFrame, hypotheses: Mapping[tuple[str, str], str] = C.FAILURE_HYPOTHESES, preview: int = 100
) -> DataFrame:
    """Failures with a query preview and the hypothesis for their (predicted, actual) intents."""
    known = F.create_map(*[F.lit(x) for (p, g), text in hypotheses.items() for x in (f"{p}\n{g}", text)])
    key = F.concat_ws("\n", "prediction_intent", "golden_intent")
    first, middle, last = C.HYPOTHESIS_DEFAULT
    default = F.concat(F.lit(first), "prediction_intent", F.lit(middle), "golden_intent", F.lit(last))
    return failures.select(
        "example_id",
        F.substring("query", 1, preview).alias("query_preview"),
        F.array_join("error_types", ", ").alias("error_types"),
        "error_score",
        "prediction_intent",
        "golden_intent",
        F.coalesce(F.try_element_at(known, key), default).alias("hypothesis"),
    )
