"""Derived input views and the query registry.

Every view is one SQL text that runs unchanged in Spark and in DuckDB, so that a query and its
check start from the same rows. Each query is registered with the SQL that must give its result.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadloom import constants as C
from threadloom.session import configure

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

_CODES = "CASE {0} WHEN 0 THEN 'account_access' WHEN 1 THEN 'billing_purchase' WHEN 2 THEN 'feedback_complaint' " \
    "WHEN 3 THEN 'how_to' WHEN 4 THEN 'other' WHEN 5 THEN 'service_status' WHEN 6 THEN 'technical_issue' " \
    "ELSE concat('junk', CAST({0} AS STRING)) END"


def _name(code: str) -> str:
    return _CODES.format(code)


VIEWS = {
    "turns": """
        SELECT conv_id AS thread_id, turn AS seq,
               CASE WHEN role = 'assistant' THEN 'brand' ELSE 'customer' END AS role, text
        FROM conversations WHERE role <> 'system'""",
    "tweets": """
        SELECT CAST(conv_id * 1000 + turn AS STRING) AS tweet_id,
               CASE WHEN role = 'assistant' THEN concat('Brand', CAST(conv_id % 3 AS STRING))
                    ELSE concat('u', CAST(conv_id AS STRING)) END AS author_id,
               CASE WHEN role = 'assistant' THEN 'False'
                    WHEN turn % 3 = 0 THEN 'True' WHEN turn % 3 = 1 THEN '1' ELSE 'yes' END AS inbound,
               concat('day ', CAST(turn AS STRING)) AS created_at,
               CASE WHEN turn % 5 = 4 THEN concat('@Brand', CAST(conv_id % 3 AS STRING), '  see https://ex.com/',
                                                  CAST(turn AS STRING), ' ', text)
                    ELSE text END AS text,
               CASE WHEN turn = 0 THEN concat(CAST(conv_id * 1000 + 1 AS STRING), ', ', CAST(conv_id * 1000 + 2 AS STRING))
                    ELSE 'nan' END AS response_tweet_id,
               CASE WHEN turn = 0 THEN ''
                    ELSE CAST(conv_id * 1000 + CAST(floor((turn - 1) / 2) AS BIGINT) AS STRING)
               END AS in_response_to_tweet_id
        FROM conversations""",
    "reposts": """
        SELECT tweet_id, text, inbound, 2 * CAST(tweet_id AS BIGINT) AS position FROM tweets
        UNION ALL
        SELECT tweet_id, concat('edited: ', text) AS text, inbound, 2 * CAST(tweet_id AS BIGINT) + 1 AS position
        FROM tweets WHERE CAST(tweet_id AS BIGINT) % 3 = 0""",
    "intents": f"""
        SELECT example_id, {_name('gold_code')} AS gold_intent,
               CASE WHEN example_id % 5 = 0 THEN concat(' ', upper({_name('pred_code')}), ' ') ELSE {_name('pred_code')} END AS intent
        FROM (SELECT vec_id AS example_id, label AS gold_code,
                     CASE WHEN vec_id % 4 = 0 THEN (label + 1) % 10 ELSE label END AS pred_code FROM embeddings) codes""",
    "escalations": """
        SELECT doc_id AS example_id, CASE WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS gold_escalate,
               CASE WHEN quality = 0 THEN ' YES ' WHEN doc_id % 7 = 0 THEN 'true' ELSE 'No' END AS escalate
        FROM labels""",
    "judge_raw": """
        SELECT doc_id AS example_id, n_chars % 8 AS helpfulness, doc_id % 7 AS tone,
               CASE WHEN doc_id % 10 = 0 THEN NULL ELSE (n_chars + doc_id) % 6 END AS groundedness
        FROM documents""",
    "human_scores": """
        SELECT doc_id AS example_id, 1 + n_chars % 5 AS human_helpfulness, 1 + doc_id % 5 AS human_tone,
               1 + (n_chars + doc_id) % 5 AS human_groundedness
        FROM documents WHERE doc_id % 4 = 0""",
    "responses": """
        SELECT conv_id * 1000 + turn AS example_id, text AS customer_query,
               CASE (conv_id + turn) % 12
                 WHEN 0 THEN '{"intent": "how_to", "escalate": "yes", "confidence": "high", "reason": "asks twice"}'
                 WHEN 1 THEN concat('```json', chr(10), '{"intent": "billing_purchase", "escalate": "No"}', chr(10), '```')
                 WHEN 2 THEN '<think>maybe {x}</think> {"intent": "Unknown", "escalate": "maybe", "reply": "Hi"}'
                 WHEN 3 THEN 'I am not sure.'
                 WHEN 4 THEN '{"intent": "how_to", '
                 WHEN 5 THEN 'Sure: {"intent": ["Other ", "how_to"], "escalate": true} done'
                 WHEN 6 THEN '[{"intent": "how_to"}]'
                 WHEN 7 THEN NULL
                 WHEN 8 THEN '{"intent": {"category": " Billing_Purchase "}, "escalate": 1, "reason": null}'
                 WHEN 9 THEN '{"intent": "How_To", "escalate": "YES"} {"intent": "other"}'
                 WHEN 10 THEN ''
                 ELSE '{"escalation_reason": "angry", "reply": "Please restart.", "escalate": null, "confidence": null}'
               END AS response
        FROM conversations""",
    "ratings": """
        SELECT doc_id AS example_id,
               CASE doc_id % 9
                 WHEN 0 THEN concat('{"helpfulness": ', CAST(n_chars % 8 AS STRING), ', "tone": 4.7, "groundedness": "3", "reasoning": "fine"}')
                 WHEN 1 THEN '{"helpfulness": 5, "tone": null, "groundedness": 1}'
                 WHEN 2 THEN '{"helpfulness": "4.5", "tone": 2, "groundedness": 1}'
                 WHEN 3 THEN '{"tone": 9, "groundedness": -2}'
                 WHEN 4 THEN 'no rating'
                 WHEN 5 THEN '{"helpfulness": true, "tone": 1e0, "groundedness": " +5 "}'
                 WHEN 6 THEN '[1, 2, 3]'
                 WHEN 7 THEN NULL
                 ELSE concat('```', chr(10), '{"helpfulness": 2, "tone": ', CAST(1 + n_chars % 5 AS STRING), ', "groundedness": 2}', chr(10), '```')
               END AS response
        FROM documents""",
    "graded": """
        SELECT e.vec_id AS example_id, d.text, d.source, e.label, l.toxic, l.quality
        FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id LEFT JOIN labels l ON l.doc_id = e.vec_id""",
    "golden": f"""
        SELECT example_id, text AS customer_query, concat('Re: ', source) AS brand_response_actual,
               {_name('label')} AS intent, CASE WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS escalate
        FROM graded""",
    "predictions": f"""
        SELECT 'pipeline' AS system, example_id, text AS query, concat('Hello. ', text) AS reply,
               CASE WHEN example_id % 4 = 0 THEN {_name('(label + 1) % 10')} ELSE {_name('label')} END AS intent,
               CASE WHEN quality = 0 THEN 'yes' ELSE 'no' END AS escalate
        FROM graded
        UNION ALL
        SELECT 'simple_baseline', example_id, text, concat('Hi. ', text),
               CASE WHEN example_id % 3 = 0 THEN {_name('(label + 2) % 10')} ELSE {_name('label')} END,
               CASE WHEN example_id % 2 = 0 THEN 'true' ELSE 'false' END
        FROM graded
        UNION ALL
        SELECT 'trivial_baseline', example_id, text, {"'" + C.TRIVIAL_REPLY.replace("'", "''") + "'"},
               '{C.TRIVIAL_INTENT}', 'yes'
        FROM graded""",
    "judged": """
        SELECT 'pipeline' AS system, example_id, helpfulness, tone, groundedness FROM judge_raw
        UNION ALL
        SELECT 'simple_baseline', example_id, tone, groundedness, helpfulness FROM judge_raw""",
}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, listed anew each time."""
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", sql))
    return sorted(words)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a DataFrame."""
    for source in _needs(VIEWS[name]):
        if source in VIEWS:
            view(spark, sf_dir, source).createOrReplaceTempView(source)
        elif source in TABLES:
            table(spark, sf_dir, source).createOrReplaceTempView(source)
    return spark.sql(VIEWS[name])


def with_views(*names: str, recursive: bool = False) -> str:
    """The WITH clause that defines the views for DuckDB; the caller appends more steps."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in ordered:
            for source in _needs(VIEWS[name]):
                add(source)
            ordered.append(name)

    for name in names:
        add(name)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ", ".join(f"{name} AS ({VIEWS[name]})" for name in ordered)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` together with its SQL."""
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


# --- SQL spellings of the column functions --------------------------------------------------

WS = r"\t-\r\x{1c}-\x{20}\x{85}\p{Z}"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[{WS}]+|[{WS}]+\z', '', 'g')"


def sql_mask(x: str) -> str:
    return rf"regexp_replace({x}, 'https?://[^{WS}]+', '[URL]', 'g')"


def sql_mentions(x: str) -> str:
    return rf"regexp_replace({x}, '@[\p{{L}}\p{{N}}_]+', '', 'g')"


def sql_clean(x: str) -> str:
    visible = f"replace(replace(coalesce({x}, ''), chr(8203), ''), chr(8205), '')"
    return rf"trim(regexp_replace({sql_mentions(sql_mask(visible))}, '[{WS}]+', ' ', 'g'))"


def sql_ascii_share(x: str) -> str:
    return rf"(length(regexp_replace({x}, '[^\x00-\x7F]', '', 'g')) / nullif(length({x}), 0))"


def sql_ok(x: str) -> str:
    return f"coalesce({sql_ascii_share(x)} > {C.ASCII_SHARE}, FALSE)"


def sql_missing(x: str) -> str:
    return f"CASE WHEN {x} NOT IN ('', 'nan', 'None', 'NaN') THEN {x} END"


def sql_truthy(x: str) -> str:
    return f"coalesce(lower({x}) IN ('true', '1', 'yes'), FALSE)"


def sql_prefix(x: str) -> str:
    return sql_strip(f"lower(substring({x}, 1, {C.DEDUP_PREFIX}))")


def sql_quote(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


LABEL_LIST = ", ".join(f"'{i}'" for i in sorted(C.INTENTS))


def sql_label(x: str) -> str:
    label = f"lower({sql_strip(x)})"
    return f"CASE WHEN {label} IN ({LABEL_LIST}) THEN {label} ELSE 'other' END"


def sql_tidy(x: str) -> str:
    return f"trim(trim({sql_strip(x)}, '\"'), '''')"


def sql_cap(x: str) -> str:
    head = rf"regexp_replace(substring({x}, 1, {C.REPLY_CUT}), ' [^ ]*\z', '')"
    return f"CASE WHEN length({x}) > {C.REPLY_LIMIT} THEN concat({head}, '...') ELSE {x} END"
