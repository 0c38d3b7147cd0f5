"""Jobs around a plug-in model: predictions in stages, the one-prompt baseline and the judge.

Each stage keeps its answers in a table of its own under ``base``, one row per example. A stage that is
run again asks the model for the examples without an answer only, found by their key, so a job goes
on after a crash where it stopped, and later examples are added to it. Answers are appended in slices
of the keys; at most the slice under way is asked for twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

from threadloom import constants as C
from threadloom.operators import predictions as P, raters, retrieval
from threadloom.session import configure
from threadloom.streaming.resumable import run_pending

KEY = "example_id"


def run_stage(rows: DataFrame, score: Callable[[DataFrame], DataFrame], sink: str, slices: int = 1, key: str | list[str] = KEY) -> DataFrame:
    """Score the rows whose key ``sink`` lacks and append them, a slice of the keys at a time; all results of ``rows``."""
    keys = [key] if isinstance(key, str) else key
    place = F.pmod(F.xxhash64(*keys), F.lit(slices))
    for part in range(slices):
        run_pending(rows.where(place == part) if slices > 1 else rows, score, sink, key)
    return rows.sparkSession.read.parquet(sink).join(rows.select(*keys).distinct(), keys, "left_semi")


def ask(rows: DataFrame, stage: str, predictor: P.Predictor, base: str, templates: Mapping[str, str], slices: int = 1,
        key: str | list[str] = KEY) -> DataFrame:
    """The model's answers to one prompt per row: the key and ``response``. The template is filled from the row's columns."""
    def score(todo: DataFrame) -> DataFrame:
        prompts = P.render_prompts(todo, {stage: templates[stage]})
        return P.run_predictor(prompts, predictor).drop("stage")

    return run_stage(rows, score, f"{base}/{stage}", slices, key).select(KEY, "response")


def find_context(queries: DataFrame, corpus: DataFrame, base: str, k: int = C.NEIGHBOUR_COUNT, slices: int = 1, key: str = "thread_id") -> DataFrame:
    """``(example_id, similar_threads, context)`` of every query: its nearest pairs of the corpus, stored by
    key. A query without a vector, like one in an empty corpus, has none."""
    documents = retrieval.vector_side(corpus, key, "embedding", normalize=False)

    def score(todo: DataFrame) -> DataFrame:
        hits = retrieval.knn_topk(retrieval.vector_side(todo, KEY, "embedding"), documents, k)
        nested = retrieval.neighbours_nested(retrieval.with_documents(hits, corpus, key)).withColumnRenamed("query_id", KEY)
        none = F.array().cast(nested.schema["similar_threads"].dataType)
        return todo.select(KEY).join(nested, KEY, "left").withColumn("similar_threads", F.coalesce("similar_threads", none))

    found = run_stage(queries.select(KEY, "embedding"), score, f"{base}/neighbours", slices)
    return retrieval.retrieval_context(found, k)


def predict(
    examples: DataFrame, corpus: DataFrame, predictor: P.Predictor, base: str, *, k: int = C.NEIGHBOUR_COUNT,
    templates: Mapping[str, str] = C.PROMPTS, slices: int = 1, key: str = "thread_id",
) -> DataFrame:
    """Classify, search, reply, escalate: a prediction per example.

    ``examples`` has ``example_id``, ``customer_query`` and the query's ``embedding`` (null: no neighbours);
    ``corpus`` is what ``retrieval_corpus`` gives. The reply is asked for with the intent and the
    neighbours, the escalation with the intent. Answers that do not parse, and missing ones, take each
    field's default.
    """
    configure(examples.sparkSession)
    rows = examples.select(KEY, "customer_query", "embedding")
    answers = ask(rows.drop("embedding"), "intent", predictor, base, templates, slices)
    intents = P.parse_intents(answers).select(KEY, "intent", "intent_confidence")
    similar = find_context(rows, corpus, base, k, slices, key)
    known = rows.drop("embedding").join(intents, KEY)
    replies = ask(known.join(similar.select(KEY, "context"), KEY), "reply", predictor, base, templates, slices)
    decided = P.parse_escalations(ask(known, "escalation", predictor, base, templates, slices))
    return (
        known.join(similar.select(KEY, "similar_threads"), KEY)
        .join(replies.select(KEY, P.finish_reply(F.col("response")).alias("reply")), KEY)
        .join(decided.select(KEY, "escalate", "escalation_reason"), KEY)
        .select(KEY, F.col("customer_query").alias("query"), "intent", "intent_confidence", "reply", "escalate", "escalation_reason", "similar_threads")
    )


def predict_in_one(examples: DataFrame, predictor: P.Predictor, base: str, *, templates: Mapping[str, str] = C.PROMPTS, slices: int = 1) -> DataFrame:
    """The simple baseline: intent, reply and escalation from one answer without examples."""
    configure(examples.sparkSession)
    rows = examples.select(KEY, "customer_query")
    read = P.single_prompt_baseline(ask(rows, "single_prompt", predictor, base, templates, slices)).drop("response")
    return rows.withColumnRenamed("customer_query", "query").join(read, KEY)


def judge_replies(
    predictions: DataFrame, golden: DataFrame, predictor: P.Predictor, base: str, *, n: int = C.JUDGE_SAMPLE, seed: int = C.SEED,
    templates: Mapping[str, str] = C.PROMPTS, slices: int = 1,
) -> DataFrame:
    """Ratings of a sample of replies against the actual ones. The sample depends on the example ids and the
    seed alone, so systems that predict the same examples are judged on the same ones."""
    configure(predictions.sparkSession)
    chosen = raters.judge_subsample(predictions.select(KEY, F.col("query").alias("customer_query"), "reply"), n, seed)
    actual = golden.select(KEY, F.coalesce("brand_response_actual", F.lit("")).alias("brand_response_actual"))
    answers = ask(chosen.join(actual, KEY), "judge", predictor, base, templates, slices)
    return P.parse_judge_scores(answers).drop("response")


def run_evaluation(
    golden: DataFrame, corpus: DataFrame, predictor: P.Predictor, judge: P.Predictor, base: str, *,
    judged: Mapping[str, int] | None = None, human: DataFrame | None = None, slices: int = 1, key: str = "thread_id", **options,
) -> tuple[DataFrame, DataFrame]:
    """Predict with all three systems, judge their replies and evaluate: the long metric table and the worst failures.

    ``golden`` also has the queries' ``embedding``. ``judged`` says how many replies of which system are
    judged. Everything a model answered stays under ``base`` and is not asked for again.
    """
    from threadloom.plans import jobs

    systems = {
        "pipeline": predict(golden, corpus, predictor, f"{base}/pipeline", slices=slices, key=key),
        "simple_baseline": predict_in_one(golden, predictor, f"{base}/simple_baseline", slices=slices),
        "trivial_baseline": P.trivial_baseline(golden.select(KEY, F.col("customer_query").alias("query"))),
    }
    ratings = None
    for name, n in (judged or {"pipeline": C.JUDGE_SAMPLE, "simple_baseline": C.JUDGE_SAMPLE}).items():
        rated = judge_replies(systems[name], golden, judge, f"{base}/{name}", n=n, slices=slices)
        rated = rated.select(F.lit(name).alias("system"), KEY, *C.DIMENSIONS, "overall")
        ratings = rated if ratings is None else ratings.unionByName(rated)
    return jobs.evaluate_systems(golden, systems, ratings, human, **options)
