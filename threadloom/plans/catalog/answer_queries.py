"""Prompts, parsed model responses, baselines and assembled predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom import constants as C
from threadloom.operators import metrics, pairs, predictions as P
from threadloom.plans.catalog.base import (
    LABEL_LIST, WS, query, sql_cap, sql_label, sql_quote, sql_strip, sql_tidy, view, with_views,
)
from threadloom.plans.catalog.conversation_queries import PAIRS


def _sql_template(template: str, columns: set[str], fixed: dict[str, str]) -> str:
    import string

    parts = []
    for text, slot, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(sql_quote(text))
        if slot is not None:
            parts.append(f"coalesce(CAST({slot} AS VARCHAR), '')" if slot in columns else sql_quote(fixed[slot]))
    return f"concat({', '.join(parts)})"


_FIXED = {"intent_list": P.taxonomy_lines(), "intent_names": ", ".join(C.INTENTS), "rules": C.ESCALATION_RULES}
_PROMPT_COLUMNS = {"customer_query", "brand_response_actual", "intent", "context", "reply"}


@query("render_prompts", PAIRS + ", examples AS (SELECT thread_id AS example_id, customer_query, "
       "brand_response AS brand_response_actual, 'other' AS intent, '' AS context, brand_response AS reply FROM pairs) "
       + " UNION ALL ".join(
           f"SELECT example_id, '{stage}' AS stage, {_sql_template(text, _PROMPT_COLUMNS, _FIXED)} AS prompt FROM examples"
           for stage, text in C.PROMPTS.items()))
def render_prompts(spark, sf_dir):
    found = pairs.first_pairs(view(spark, sf_dir, "turns"))
    examples = found.select(
        F.col("thread_id").alias("example_id"), "customer_query", F.col("brand_response").alias("brand_response_actual"),
        F.lit("other").alias("intent"), F.lit("").alias("context"), F.col("brand_response").alias("reply"),
    )
    return P.render_prompts(examples)


_UNFENCED = (rf"CASE WHEN starts_with(t1, '```') THEN regexp_replace(regexp_replace(t1, '^```(?:json)?[{WS}]*', ''), "
             rf"'[{WS}]*```\z', '') ELSE t1 END")


def _parsed(view_name: str) -> str:
    thinking = "regexp_replace(t2, '(?s)<think>.*?</think>', '', 'g')"
    return f"""{with_views(view_name)},
    s1 AS (SELECT *, {sql_strip('response')} AS t1 FROM {view_name}),
    s2 AS (SELECT *, {_UNFENCED} AS t2 FROM s1),
    s3 AS (SELECT *, {sql_strip(thinking)} AS t3 FROM s2),
    s4 AS (SELECT *, nullif(regexp_extract(t3, '(?s)[\\[{{].*[\\]}}]', 0), '') AS js FROM s3),
    parsed AS (SELECT *, TRY_CAST(js AS JSON) AS j, coalesce(json_type(TRY_CAST(js AS JSON)) = 'OBJECT', FALSE) AS ok FROM s4)"""


def _or_default(name: str, default: str) -> str:
    """Text of a field; the default only when the key is absent."""
    return f"CASE WHEN json_type(j, '$.{name}') IS NULL THEN {sql_quote(default)} ELSE j->>'$.{name}' END"


_RESPONSES = _parsed("responses")


@query("extract_response_json", f"""
    {_RESPONSES} SELECT example_id, js AS json, j IS NOT NULL AS parses, ok AS is_object FROM parsed""")
def extract_response_json(spark, sf_dir):
    from threadloom.functions.responses import is_object

    parsed = P.parse_json(view(spark, sf_dir, "responses"))
    return parsed.select("example_id", "json", F.col("parsed").isNotNull().alias("parses"),
                         is_object(F.col("parsed")).alias("is_object"))


_INNER = """CASE WHEN json_type(j, '$.intent') = 'OBJECT'
              THEN coalesce(json_extract(j, '$.intent.category'), json_extract(j, '$.intent.intent'), json_extract(j, '$.intent.value'))
              ELSE json_extract(j, '$.intent') END"""
_LABEL = f"""CASE WHEN v IS NULL THEN 'other'
              WHEN json_type(v) = 'ARRAY' THEN CASE WHEN json_array_length(v) = 0 THEN 'other'
                   ELSE lower({sql_strip("coalesce(v->>'$[0]', 'none')")}) END
              ELSE lower({sql_strip("coalesce(v->>'$', 'none')")}) END"""


@query("normalize_labels", f"""
    {_RESPONSES}, picked AS (SELECT *, CASE WHEN ok THEN {_INNER} END AS v FROM parsed),
    labelled AS (SELECT example_id, {_LABEL} AS label FROM picked)
    SELECT example_id, label, {sql_label('label')} AS intent FROM labelled""")
def normalize_labels(spark, sf_dir):
    from threadloom.functions.responses import field, is_object
    from threadloom.functions.text import to_taxonomy

    parsed = P.parse_json(view(spark, sf_dir, "responses"))
    picked = parsed.withColumn("raw", F.when(is_object(F.col("parsed")), field(F.col("parsed"), "intent")))
    labels = P.normalize_labels(picked, "raw")
    return labels.select("example_id", "label", to_taxonomy(F.col("label")).alias("intent"))


_FAILED = "(NOT ok OR coalesce(json_type(j, '$.intent') IN ('ARRAY', 'OBJECT'), FALSE))"
_INTENT = f"""CASE WHEN NOT {_FAILED} AND json_type(j, '$.intent') = 'VARCHAR' AND j->>'$.intent' IN ({LABEL_LIST})
              THEN j->>'$.intent' ELSE 'other' END"""
_CONFIDENCE = f"CASE WHEN {_FAILED} THEN 'low' ELSE {_or_default('confidence', 'unknown')} END"


@query("parse_intent_responses", f"""
    {_RESPONSES} SELECT example_id, {_INTENT} AS intent, {_CONFIDENCE} AS intent_confidence, {_FAILED} AS intent_failed FROM parsed""")
def parse_intent_responses(spark, sf_dir):
    parsed = P.parse_intents(view(spark, sf_dir, "responses"))
    return parsed.select("example_id", "intent", "intent_confidence", "intent_failed")


_SAID = f"lower(coalesce({_or_default('escalate', 'no')}, 'none'))"
_ESCALATE = f"CASE WHEN NOT ok OR {_SAID} = 'yes' THEN 'yes' ELSE 'no' END"
_REASON = f"CASE WHEN NOT ok THEN {sql_quote(C.ESCALATION_ERROR_REASON)} ELSE {_or_default('reason', '')} END"


@query("parse_escalation_responses", f"""
    {_RESPONSES} SELECT example_id, {_ESCALATE} AS escalate, {_REASON} AS escalation_reason,
           (NOT ok OR json_type(j, '$.escalate') IS NULL OR {_SAID} NOT IN ('yes', 'no')) AS defaulted FROM parsed""")
def parse_escalation_responses(spark, sf_dir):
    parsed = P.parse_escalations(view(spark, sf_dir, "responses"))
    return parsed.select("example_id", "escalate", "escalation_reason", "defaulted")


@query("parse_label_responses", f"""
    {with_views('responses')},
    found AS (SELECT example_id, TRY_CAST(nullif(regexp_extract(response, '(?s)\\{{.*\\}}', 0), '') AS JSON) AS j FROM responses)
    SELECT example_id, CASE WHEN j IS NULL THEN '' ELSE {_or_default('intent', '')} END AS intent,
           CASE WHEN j IS NULL THEN '' ELSE {_or_default('escalate', '')} END AS escalate,
           CASE WHEN j IS NULL THEN '' ELSE {_or_default('escalation_reason', '')} END AS escalation_reason,
           j IS NOT NULL AS auto_labeled FROM found""")
def parse_label_responses(spark, sf_dir):
    labels = P.parse_labels(view(spark, sf_dir, "responses"))
    return labels.select("example_id", "intent", "escalate", "escalation_reason", "auto_labeled")


@query("auto_labeled_count", f"""
    {with_views('responses')}
    SELECT count(*) AS n, count(*) FILTER (TRY_CAST(nullif(regexp_extract(response, '(?s)\\{{.*\\}}', 0), '') AS JSON) IS NOT NULL) AS n_labeled
    FROM responses""")
def auto_labeled_count(spark, sf_dir):
    labels = P.parse_labels(view(spark, sf_dir, "responses"))
    return labels.agg(F.count("*").alias("n"), F.count_if("auto_labeled").alias("n_labeled"))


_TRIVIAL = {
    "intent": C.TRIVIAL_INTENT, "intent_confidence": "N/A", "reply": C.TRIVIAL_REPLY, "escalate": "yes",
    "escalation_reason": C.TRIVIAL_REASON,
}


@query("trivial_baseline", f"""
    {with_views('responses')} SELECT example_id, {', '.join(f'{sql_quote(v)} AS {k}' for k, v in _TRIVIAL.items())} FROM responses""")
def trivial_baseline(spark, sf_dir):
    return P.trivial_baseline(view(spark, sf_dir, "responses").select("example_id"))


@query("majority_baseline", f"""
    {with_views('intents')}
    SELECT label, count(*) AS n FROM (SELECT {sql_label('gold_intent')} AS label FROM intents) labels
    GROUP BY label ORDER BY n DESC, label LIMIT 1""")
def majority_baseline(spark, sf_dir):
    from threadloom.functions.text import to_taxonomy

    labels = view(spark, sf_dir, "intents").select(to_taxonomy(F.col("gold_intent")).alias("label"))
    return P.majority_intent(labels, "label")


_SIMPLE = {
    "intent": f"CASE WHEN json_type(j, '$.intent') = 'VARCHAR' THEN j->>'$.intent' ELSE {_LABEL} END",
    "intent_confidence": "'N/A'",
    "reply": _or_default("reply", C.SINGLE_PROMPT_REPLY),
    "escalate": _SAID,
    "escalation_reason": _or_default("escalation_reason", ""),
}


@query("single_prompt_baseline", f"""
    {_RESPONSES}, picked AS (SELECT *, CASE WHEN ok THEN {_INNER} END AS v FROM parsed)
    SELECT example_id, {', '.join(f'CASE WHEN ok THEN {sql} ELSE {sql_quote(_TRIVIAL[c])} END AS {c}' for c, sql in _SIMPLE.items())}
    FROM picked""")
def single_prompt_baseline(spark, sf_dir):
    parsed = P.single_prompt_baseline(view(spark, sf_dir, "responses"))
    return parsed.select("example_id", *_SIMPLE)


@query("assemble_predictions", f"""
    {_RESPONSES}
    SELECT example_id, customer_query AS query, {_INTENT} AS intent, {_CONFIDENCE} AS intent_confidence,
           coalesce({sql_cap(sql_tidy('response'))}, {sql_quote(C.REPLY_ON_ERROR)}) AS reply,
           {_ESCALATE} AS escalate, {_REASON} AS escalation_reason FROM parsed""")
def assemble_predictions(spark, sf_dir):
    rows = view(spark, sf_dir, "responses")
    stages = F.explode(F.array(*[F.lit(s) for s in ("intent", "reply", "escalation")])).alias("stage")
    responses = rows.select("example_id", stages, "response")
    return P.assemble_predictions(rows.select("example_id", "customer_query"), responses)


def _score(name: str) -> str:
    kind, text = f"json_type(j, '$.{name}')", f"j->>'$.{name}'"
    number = f"""CASE WHEN {kind} = 'BOOLEAN' THEN CASE WHEN {text} = 'true' THEN 1.0 ELSE 0.0 END
        WHEN {kind} = 'VARCHAR' THEN CASE WHEN regexp_full_match({text}, '[{WS}]*[+-]?[0-9]+(_[0-9]+)*[{WS}]*')
             THEN TRY_CAST(replace({sql_strip(text)}, '_', '') AS DOUBLE) END
        WHEN {kind} IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN TRY_CAST({text} AS DOUBLE) END"""
    return f"CASE WHEN {kind} IS NULL THEN 3 WHEN ({number}) IS NOT NULL THEN CAST(floor(greatest(1.0, least(5.0, {number}))) AS INTEGER) END"


@query("parse_judge_scores", f"""
    {_parsed('ratings')},
    rated AS (SELECT example_id, ok, j->>'$.reasoning' AS r, {', '.join(f'{_score(d)} AS s_{d}' for d in C.DIMENSIONS)} FROM parsed),
    judged AS (SELECT *, NOT (ok AND s_helpfulness IS NOT NULL AND s_tone IS NOT NULL AND s_groundedness IS NOT NULL) AS judge_failed FROM rated),
    final AS (SELECT example_id, judge_failed, r, {', '.join(f'CASE WHEN judge_failed THEN 3 ELSE s_{d} END AS {d}' for d in C.DIMENSIONS)} FROM judged)
    SELECT example_id, helpfulness, tone, groundedness, round((helpfulness + tone + groundedness) / 3.0, 2) AS overall,
           CASE WHEN judge_failed THEN 'Error: unreadable rating' ELSE r END AS reasoning, judge_failed FROM final""")
def parse_judge_scores(spark, sf_dir):
    scores = P.parse_judge_scores(view(spark, sf_dir, "ratings"))
    return scores.select("example_id", *C.DIMENSIONS, "overall", "reasoning", "judge_failed")


@query("align_predictions", f"""
    {with_views('intents', 'escalations')}
    SELECT i.example_id, i.gold_intent, i.intent, e.gold_escalate, e.escalate
    FROM intents i JOIN escalations e ON e.example_id = i.example_id""")
def align_predictions(spark, sf_dir):
    return metrics.align(view(spark, sf_dir, "intents"), view(spark, sf_dir, "escalations")).select(
        "example_id", "gold_intent", "intent", "gold_escalate", "escalate"
    )


@query("unaligned_rows", f"""
    {with_views('intents', 'escalations')}
    SELECT (SELECT count(*) FROM intents WHERE example_id NOT IN (SELECT example_id FROM escalations)) AS n_predictions,
           (SELECT count(DISTINCT example_id) FROM escalations WHERE example_id NOT IN (SELECT example_id FROM intents)) AS n_golden""")
def unaligned_rows(spark, sf_dir):
    return metrics.unaligned(view(spark, sf_dir, "intents"), view(spark, sf_dir, "escalations"))


@query("resume_pending", f"""
    {with_views('escalations')}
    SELECT doc_id AS example_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT example_id FROM escalations)""")
def resume_pending(spark, sf_dir):
    from threadloom.plans.catalog.base import table

    queries = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("example_id"), "n_chars")
    return P.pending(queries, view(spark, sf_dir, "escalations"))


@query("resumable_scoring", f"""
    SELECT conv_id, turn, {sql_cap(sql_tidy('text'))} AS reply FROM conversations""")
def resumable_scoring(spark, sf_dir):
    """The scoring stream over the conversation files, stopped and started again once."""
    from threadloom.plans.catalog.base import table
    from threadloom.session import scratch_path
    from threadloom.streaming.resumable import start_scoring

    def score(batch):
        return batch.select("conv_id", "turn", P.finish_reply(F.col("text")).alias("reply"))

    schema = table(spark, sf_dir, "conversations").schema
    sink, state = scratch_path(spark, "scores"), scratch_path(spark, "score-state")
    for _ in range(2):
        start_scoring(
            spark, f"{sf_dir}/conversations.parquet", schema, score, sink, state, key=["conv_id", "turn"]
        ).awaitTermination()
    return spark.read.parquet(sink).select("conv_id", "turn", "reply")
