"""The jobs around a model, with a predictor whose answers follow from the prompts alone."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from threadloom import constants as C
from threadloom.operators import pairs, retrieval
from threadloom.plans import prediction
from threadloom.plans.catalog.answer_queries import _FIXED, _sql_template
from threadloom.plans.catalog.base import query, sql_cap, sql_quote, sql_tidy, table, view
from threadloom.plans.catalog.search_queries import _NESTED
from threadloom.session import scratch_path

# The first digit of the md5 of a prompt decides what the model answers; some answers are broken.
INTENT_ANSWERS = (
    '{"intent": "how_to", "confidence": "high"}', '{"intent": "billing_purchase"}', "I think how_to", '{"intent": "unheard"}',
    '```json\n{"intent": "other", "confidence": "medium"}\n```', '{"intent": ["how_to"]}', '{"intent": "technical_issue", "confidence": "low"}',
    '{"intent": "account_access", "confidence": null}',
)
INTENT_READ = (
    ("how_to", "high"), ("billing_purchase", "unknown"), ("other", "low"), ("other", "unknown"), ("other", "medium"), ("other", "low"),
    ("technical_issue", "low"), ("account_access", None),
)
ESCALATION_ANSWERS = ('{"escalate": "yes", "reason": "angry"}', '{"escalate": "NO"}', "nothing", '{"escalate": "maybe", "reason": "unclear"}')
ESCALATION_READ = (("yes", "angry"), ("no", ""), ("yes", C.ESCALATION_ERROR_REASON), ("no", "unclear"))


def answer(stage: str, prompt: str) -> str:
    """A deterministic model: every answer depends on the whole prompt."""
    digest = hashlib.md5(prompt.encode()).hexdigest()
    digit = int(digest[0], 16)
    if stage == "intent":
        return INTENT_ANSWERS[digit % 8]
    if stage == "escalation":
        return ESCALATION_ANSWERS[digit % 4]
    if stage == "judge":
        return f'{{"helpfulness": {1 + digit % 5}, "tone": {1 + int(digest[1], 16) % 5}, "groundedness": {1 + int(digest[2], 16) % 5}, "reasoning": "{digest}"}}'
    if stage == "single_prompt":
        return f'{{"intent": "{C.INTENTS[digit % 7]}", "reply": "Hi {digest}", "escalate": "{"yes" if digit % 2 else "no"}"}}'
    return f' "Reply {digest} {"and more words " * (3 * digit)}" '


def predictor(frames):
    for frame in frames:
        answers = [answer(s, p) for s, p in zip(frame["stage"], frame["prompt"])]
        yield frame[["example_id", "stage"]].assign(response=answers)


def examples_and_corpus(spark, sf_dir):
    """Each first question as an example, with its vector; the corpus is all pairs with vectors."""
    found = pairs.first_pairs(view(spark, sf_dir, "turns"))
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("thread_id"), "embedding")
    examples = found.join(vectors, "thread_id", "left").select(
        F.col("thread_id").alias("example_id"), "customer_query", F.col("brand_response").alias("brand_response_actual"), "embedding")
    return examples, retrieval.retrieval_corpus(found, vectors)


def _digit(prompt: str, n: int, place: int = 1) -> str:
    return f"(strpos('0123456789abcdef', substring(md5({prompt}), {place}, 1)) - 1) % {n}"


def _pick(prompt: str, values: list[str | None]) -> str:
    cases = " ".join(f"WHEN {i} THEN {'NULL' if v is None else sql_quote(v)}" for i, v in enumerate(values))
    return f"CASE {_digit(prompt, len(values))} {cases} END"


def _prompt(stage: str, columns: set[str]) -> str:
    return _sql_template(C.PROMPTS[stage], columns, _FIXED)


_REPLY = f"concat(' \"Reply ', md5(p_reply), ' ', repeat('and more words ', 3 * ({_digit('p_reply', 16)})), '\" ')"
_CHAIN = f"""{_NESTED},
    contexts AS (
      SELECT query_id, string_agg(concat('Example ', rank, ' (similarity: ', printf('%.2f', score), '):', chr(10),
             '  Customer: ', customer_query, chr(10), '  Brand response: ', brand_response), chr(10) || chr(10) ORDER BY rank) AS context,
             count(*) AS n_similar
      FROM texts GROUP BY query_id),
    asked AS (
      SELECT p.thread_id AS example_id, p.customer_query, p.brand_response AS brand_response_actual, coalesce(c.context, '') AS context,
             coalesce(c.n_similar, 0) AS n_similar
      FROM pairs p LEFT JOIN contexts c ON c.query_id = p.thread_id),
    classified AS (SELECT *, {_prompt('intent', {'customer_query'})} AS p_intent FROM asked),
    with_intent AS (
      SELECT *, {_pick('p_intent', [a for a, _ in INTENT_READ])} AS intent, {_pick('p_intent', [b for _, b in INTENT_READ])} AS intent_confidence
      FROM classified),
    prompted AS (
      SELECT *, {_prompt('reply', {'customer_query', 'intent', 'context'})} AS p_reply, {_prompt('escalation', {'customer_query', 'intent'})} AS p_escalation
      FROM with_intent),
    predicted AS (
      SELECT example_id, customer_query AS query, intent, intent_confidence, {sql_cap(sql_tidy(_REPLY))} AS reply,
             {_pick('p_escalation', [a for a, _ in ESCALATION_READ])} AS escalate,
             {_pick('p_escalation', [b for _, b in ESCALATION_READ])} AS escalation_reason, n_similar, brand_response_actual
      FROM prompted)"""


@query("prediction_job", f"{_CHAIN} SELECT * EXCLUDE (brand_response_actual) FROM predicted")
def prediction_job(spark, sf_dir):
    """The job over half of the examples, then over all: the second run asks for the rest only."""
    examples, corpus = examples_and_corpus(spark, sf_dir)
    base = scratch_path(spark, "prediction-job")
    prediction.predict(examples.where("example_id % 2 = 0"), corpus, predictor, base)
    done = prediction.predict(examples, corpus, predictor, base)
    return done.withColumn("n_similar", F.size("similar_threads").cast("bigint")).drop("similar_threads")


@query("single_prompt_job", f"""{_CHAIN}, single AS (SELECT *, {_prompt('single_prompt', {'customer_query'})} AS p FROM asked)
    SELECT example_id, customer_query AS query, {_pick('p', [C.INTENTS[i % 7] for i in range(16)])} AS intent, 'N/A' AS intent_confidence,
           concat('Hi ', md5(p)) AS reply, CASE WHEN {_digit('p', 2)} = 1 THEN 'yes' ELSE 'no' END AS escalate, '' AS escalation_reason FROM single""")
def single_prompt_job(spark, sf_dir):
    examples, _ = examples_and_corpus(spark, sf_dir)
    return prediction.predict_in_one(examples, predictor, scratch_path(spark, "single-prompt-job"))


def _rating(place: int) -> str:
    return f"CAST(1 + {_digit('p', 5, place)} AS INTEGER)"


@query("judge_job", f"""{_CHAIN},
    chosen AS (
      SELECT example_id, query AS customer_query, reply, brand_response_actual FROM predicted
      ORDER BY md5(concat('{C.SEED}:', CAST(example_id AS VARCHAR))), example_id LIMIT {C.JUDGE_SAMPLE}),
    judged AS (SELECT *, {_prompt('judge', {'customer_query', 'reply', 'brand_response_actual'})} AS p FROM chosen),
    rated AS (SELECT example_id, {_rating(1)} AS helpfulness, {_rating(2)} AS tone, {_rating(3)} AS groundedness, md5(p) AS reasoning FROM judged)
    SELECT *, round((helpfulness + tone + groundedness) / 3.0, 2) AS overall, FALSE AS judge_failed FROM rated""")
def judge_job(spark, sf_dir):
    examples, corpus = examples_and_corpus(spark, sf_dir)
    base = scratch_path(spark, "judge-job")
    predictions = prediction.predict(examples, corpus, predictor, base)
    return prediction.judge_replies(predictions, examples, predictor, base)
