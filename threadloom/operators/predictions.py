"""From prompts to typed predictions. Model answers are a table; any model can fill it."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from threadloom import constants as C
from threadloom.functions import responses as R
from threadloom.functions.text import cap_reply, in_taxonomy, tidy_reply

Predictor = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


# --- prompts --------------------------------------------------------------------------------

def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """A template with ``{name}`` slots as one concatenation; NULL values are left empty."""
    parts: list[Column] = []
    for text, slot, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if slot is not None:
            parts.append(F.coalesce(values[slot].cast("string"), F.lit("")))
    return F.concat(*parts)


def taxonomy_lines(taxonomy: Mapping[str, tuple[str, list[str]]] = C.TAXONOMY) -> str:
    return "\n".join(f"- {name}: {text} (e.g. {', '.join(examples[:2])})" for name, (text, examples) in taxonomy.items())


def render_prompts(examples: DataFrame, templates: Mapping[str, str] = C.PROMPTS, **extra: str) -> DataFrame:
    """One row per example and stage: ``(example_id, stage, prompt)``, in one pass over the examples."""
    values = {c: F.col(c) for c in examples.columns}
    defaults = {"intent_list": taxonomy_lines(), "intent_names": ", ".join(C.INTENTS), "rules": C.ESCALATION_RULES}
    values |= {name: F.lit(text) for name, text in (defaults | extra).items()}
    prompts = [
        F.struct(F.lit(stage).alias("stage"), fill_template(template, values).alias("prompt"))
        for stage, template in templates.items()
    ]
    return examples.select("example_id", F.inline(F.array(*prompts)))


def run_predictor(prompts: DataFrame, predictor: Predictor) -> DataFrame:
    """Attach a model: a ``mapInPandas`` function from ``(example_id, stage, prompt)`` to responses."""
    return prompts.select("example_id", "stage", "prompt").mapInPandas(
        predictor, "example_id bigint, stage string, response string"
    )


# --- reading JSON answers -------------------------------------------------------------------

def parse_json(df: DataFrame, response: str = "response", json: Callable[[Column], Column] = R.json_text) -> DataFrame:
    """Add ``json`` (the JSON text) and ``parsed`` (VARIANT, NULL when it does not parse)."""
    texts = df.withColumn("json", json(F.col(response)))
    frames = texts.withColumn("_frame", R.framed(F.col("json")))
    return frames.withColumn("parsed", R.unframed(F.col("_frame"))).drop("_frame")


def _with_fields(df: DataFrame, *names: str) -> DataFrame:
    parsed = df.withColumn("is_object", R.is_object(F.col("parsed")))
    value = F.when(F.col("is_object"), F.col("parsed"))
    return parsed.select("*", *[R.field(value, name).alias(f"_{name}") for name in names])


def _or_default(name: str, default: str) -> Column:
    """Text of a field; the default only when the field is absent."""
    value = F.col(f"_{name}")
    return F.when(value.isNull(), default).otherwise(R.as_text(value))


def normalize_labels(df: DataFrame, label: str, out: str = "label") -> DataFrame:
    """Label text of a VARIANT column of any shape: text, number, list or object, nested to any depth.

    Every level of an object has a brace of its own in the JSON text, so as many steps as there are
    braces reach the bottom.
    """
    text = F.to_json(F.col(label))
    braces = F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit(""))), F.lit(0))
    bottom = F.aggregate(F.array_repeat(F.lit(0), braces), F.col(label), lambda value, _: R.unwrap(value))
    return df.withColumn("_bottom", bottom).withColumn(out, R.scalar_label(F.col("_bottom"))).drop("_bottom")


def parse_intents(df: DataFrame, response: str = "response") -> DataFrame:
    """``intent`` and ``intent_confidence``. An unknown name is the fallback; a response that does
    not parse, or holds a list or object as intent, is the fallback with low confidence."""
    fields = _with_fields(parse_json(df, response), "intent", "confidence")
    name = F.col("_intent")
    failed = ~F.col("is_object") | R.is_array(name) | R.is_object(name)
    known = R.is_text(name) & in_taxonomy(R.as_text(name))
    return fields.select(
        *df.columns,
        F.when(~failed & known, R.as_text(name)).otherwise(C.FALLBACK_INTENT).alias("intent"),
        F.when(failed, "low").otherwise(_or_default("confidence", "unknown")).alias("intent_confidence"),
        failed.alias("intent_failed"),
    )


def parse_escalations(df: DataFrame, response: str = "response") -> DataFrame:
    """``escalate`` yes/no with its reason. No answer means yes; an answer that is neither means no."""
    fields = _with_fields(parse_json(df, response), "escalate", "reason")
    failed = ~F.col("is_object")
    said = F.lower(F.coalesce(_or_default("escalate", "no"), F.lit("none")))
    return fields.select(
        *df.columns,
        F.when(failed | (said == "yes"), "yes").otherwise("no").alias("escalate"),
        F.when(failed, C.ESCALATION_ERROR_REASON).otherwise(_or_default("reason", "")).alias("escalation_reason"),
        (failed | F.col("_escalate").isNull() | ~said.isin("yes", "no")).alias("defaulted"),
    )


def finish_reply(response: Column) -> Column:
    """Reply text for sending: tidied and capped; the canned reply when there is no answer at all."""
    return F.coalesce(cap_reply(tidy_reply(response)), F.lit(C.REPLY_ON_ERROR))


def parse_labels(df: DataFrame, response: str = "response") -> DataFrame:
    """Labels proposed for golden examples; ``auto_labeled`` tells whether the response parsed."""
    fields = _with_fields(parse_json(df, response, R.object_text), "intent", "escalate", "escalation_reason")
    done = F.col("is_object")
    labels = [
        F.when(done, _or_default(name, "")).otherwise("").alias(name)
        for name in ("intent", "escalate", "escalation_reason")
    ]
    return fields.select(*df.columns, *labels, done.alias("auto_labeled"))


def parse_judge_scores(df: DataFrame, response: str = "response") -> DataFrame:
    """Ratings in 1..5 and their mean. One unreadable rating resets all three."""
    fields = _with_fields(parse_json(df, response), *C.DIMENSIONS, "reasoning")
    rated = fields.select("*", *[R.score(F.col(f"_{d}")).alias(f"s_{d}") for d in C.DIMENSIONS])
    valid = F.col("is_object")
    for d in C.DIMENSIONS:
        valid = valid & F.col(f"s_{d}").isNotNull()
    rated = rated.withColumn("judge_failed", ~valid)
    scores = [F.when(F.col("judge_failed"), 3).otherwise(F.col(f"s_{d}")).alias(d) for d in C.DIMENSIONS]
    reasoning = F.when(F.col("judge_failed"), "Error: unreadable rating").otherwise(R.as_text(F.col("_reasoning")))
    return with_overall(rated.select(*df.columns, *scores, reasoning.alias("reasoning"), "judge_failed"))


def clamp_scores(df: DataFrame) -> DataFrame:
    """Ratings that already are numbers: a missing one is 3, others are cut to whole 1..5."""
    def clamp(d: str) -> Column:
        inside = F.greatest(F.lit(1.0), F.least(F.lit(5.0), F.col(d).cast("double")))
        return F.when(F.col(d).isNull(), 3).otherwise(F.floor(inside)).cast("int")

    return with_overall(df.withColumns({d: clamp(d) for d in C.DIMENSIONS}))


def with_overall(df: DataFrame) -> DataFrame:
    total = sum((F.col(d) for d in C.DIMENSIONS), F.lit(0))
    return df.withColumn("overall", F.round(total / F.lit(float(len(C.DIMENSIONS))), 2))


# --- baselines and assembly -----------------------------------------------------------------

def trivial_columns(intent: str = C.TRIVIAL_INTENT) -> dict[str, Column]:
    return {
        "intent": F.lit(intent),
        "intent_confidence": F.lit("N/A"),
        "reply": F.lit(C.TRIVIAL_REPLY),
        "escalate": F.lit("yes"),
        "escalation_reason": F.lit(C.TRIVIAL_REASON),
    }


def trivial_baseline(examples: DataFrame, intent: str = C.TRIVIAL_INTENT) -> DataFrame:
    """The same answer for everything: one intent, the canned reply, always escalate."""
    return examples.withColumns(trivial_columns(intent))


def majority_intent(labels: DataFrame, label: str = "intent") -> DataFrame:
    """The most frequent label, the first in name order on a tie."""
    counts = labels.groupBy(label).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), label).limit(1)


def single_prompt_baseline(df: DataFrame, response: str = "response") -> DataFrame:
    """All fields from one answer, each with its own default; no answer gives the trivial row."""
    fields = _with_fields(parse_json(df, response), "intent", "reply", "escalate", "escalation_reason")
    labelled = normalize_labels(fields, "_intent", "_label")
    name = F.col("_intent")
    intent = F.when(R.is_text(name), R.as_text(name)).otherwise(F.col("_label"))
    parsed = {
        "intent": intent,
        "intent_confidence": F.lit("N/A"),
        "reply": _or_default("reply", C.SINGLE_PROMPT_REPLY),
        "escalate": F.lower(F.coalesce(_or_default("escalate", "no"), F.lit("none"))),
        "escalation_reason": _or_default("escalation_reason", ""),
    }
    fixed = trivial_columns()
    columns = [F.when(F.col("is_object"), parsed[c]).otherwise(fixed[c]).alias(c) for c in parsed]
    return labelled.select(*df.columns, *columns)


def stage_columns(responses: DataFrame, stages: tuple[str, ...] = ("intent", "reply", "escalation")) -> DataFrame:
    """Responses side by side, one row per example."""
    picked = [F.max(F.when(F.col("stage") == s, F.col("response"))).alias(f"{s}_response") for s in stages]
    return responses.groupBy("example_id").agg(*picked)


def assemble_predictions(examples: DataFrame, responses: DataFrame, nested: DataFrame | None = None) -> DataFrame:
    """Prediction rows from the examples, the model's responses and the neighbours."""
    rows = examples.join(stage_columns(responses), "example_id", "left")
    rows = parse_escalations(parse_intents(rows, "intent_response"), "escalation_response")
    rows = rows.withColumn("reply", finish_reply(F.col("reply_response")))
    if nested is not None:
        rows = rows.join(nested.withColumnRenamed("query_id", "example_id"), "example_id", "left")
    similar = [F.col("similar_threads")] if nested is not None else []
    return rows.select(
        "example_id", F.col("customer_query").alias("query"), "intent", "intent_confidence", "reply", "escalate",
        "escalation_reason", *similar,
    )


def pending(queries: DataFrame, done: DataFrame, key: str | list[str] = "example_id") -> DataFrame:
    """Queries without a stored result."""
    keys = [key] if isinstance(key, str) else key
    return queries.join(done.select(*keys), keys, "left_anti")
