"""The jobs around a model: stages, defaults, and going on after a crash."""

import pytest
from pyspark.sql import functions as F

from threadloom import constants as C
from threadloom.plans import prediction
from threadloom.plans.catalog import job_queries as J


@pytest.fixture()
def data(spark):
    examples = spark.createDataFrame(
        [(i, f"question {i}", f"actual {i}", [1.0, float(i)] if i != 5 else None, "how_to", "no") for i in range(1, 8)],
        "example_id bigint, customer_query string, brand_response_actual string, embedding array<double>, intent string, escalate string")
    corpus = spark.createDataFrame(
        [(100 + i, f"past {i}", f"answer {i}", [1.0, 0.0] if i else [0.0, 1.0]) for i in range(4)],
        "thread_id bigint, customer_query string, brand_response string, embedding array<double>")
    return examples, corpus


def counting(folder, fail=None):
    """A model that leaves a mark for each prompt, and breaks at one stage."""
    def run(frames):
        for frame in frames:
            for key, stage, prompt in zip(frame["example_id"], frame["stage"], frame["prompt"]):
                if stage == fail:
                    raise RuntimeError("model gone")
                with open(f"{folder}/{stage}-{key}", "a", encoding="utf-8") as mark:
                    mark.write("x")
            yield frame[["example_id", "stage"]].assign(response=[J.answer(s, p) for s, p in zip(frame["stage"], frame["prompt"])])

    return run


def expected(rows):
    """What the chain gives, step by step in plain Python."""
    out = {}
    for r in rows:
        intent, confidence = J.INTENT_READ[J.INTENT_ANSWERS.index(J.answer("intent", prompt("intent", r)))]
        out[r["example_id"]] = (intent, confidence)
    return out


def prompt(stage, row, **more):
    from threadloom.operators.predictions import taxonomy_lines

    values = {"intent_list": taxonomy_lines(), "rules": C.ESCALATION_RULES, "customer_query": row["customer_query"], **more}
    return C.PROMPTS[stage].format(**values)


def test_each_stage_sees_what_the_ones_before_gave(spark, data, tmp_path):
    examples, corpus = data
    done = {r["example_id"]: r for r in prediction.predict(examples, corpus, J.predictor, str(tmp_path), k=2).collect()}
    rows = {r["example_id"]: r for r in examples.collect()}
    assert set(done) == set(rows)
    for key, (intent, confidence) in expected(rows.values()).items():
        got = done[key]
        assert (got["intent"], got["intent_confidence"]) == (intent, confidence)
        similar = got["similar_threads"]
        assert len(similar) == (0 if key == 5 else 2)
        context = "\n\n".join(
            f"Example {i} (similarity: {s['score']:.2f}):\n  Customer: {s['query']}\n  Brand response: {s['response']}" for i, s in enumerate(similar, 1))
        raw = J.answer("reply", prompt("reply", rows[key], intent=intent, context=context)).strip().strip('"')
        assert got["reply"] == (raw if len(raw) <= 300 else raw[:280].rsplit(" ", 1)[0] + "...")
        said = J.answer("escalation", prompt("escalation", rows[key], intent=intent))
        assert (got["escalate"], got["escalation_reason"]) == J.ESCALATION_READ[J.ESCALATION_ANSWERS.index(said)]


@pytest.mark.parametrize("slices", [1, 3])
def test_a_job_goes_on_where_it_stopped(spark, data, tmp_path, slices):
    examples, corpus = data
    base, marks = str(tmp_path / "job"), tmp_path / "marks"
    marks.mkdir()
    with pytest.raises(Exception, match="model gone"):
        prediction.predict(examples, corpus, counting(marks, "reply"), base, slices=slices).collect()
    assert len(list(marks.glob("intent-*"))) == 7 and not list(marks.glob("reply-*"))
    first = sorted(map(str, prediction.predict(examples, corpus, counting(marks), base, slices=slices).collect()))
    more = examples.unionByName(examples.where("example_id = 1").withColumn("example_id", F.lit(50).cast("bigint")))
    again = prediction.predict(more, corpus, counting(marks), base, slices=slices)
    assert again.count() == 8
    assert sorted(map(str, again.where("example_id < 50").collect())) == first
    # Nobody was asked twice.
    asked = {p.name: p.read_text() for p in marks.iterdir()}
    assert len(asked) == 24 and set(asked.values()) == {"x"}
    assert sorted(map(str, prediction.predict(examples, corpus, counting(marks, "intent"), str(tmp_path / "job")).collect())) == first


def test_empty_corpus_and_no_examples(spark, data, tmp_path):
    examples, corpus = data
    alone = prediction.predict(examples, corpus.limit(0), J.predictor, str(tmp_path / "a")).collect()
    assert len(alone) == 7 and all(r["similar_threads"] == [] for r in alone)
    assert prediction.predict(examples.limit(0), corpus, J.predictor, str(tmp_path / "b")).collect() == []


def test_systems_are_judged_on_the_same_sample(spark, data, tmp_path):
    examples, corpus = data
    base = str(tmp_path)
    full = prediction.predict(examples, corpus, J.predictor, f"{base}/p")
    single = prediction.predict_in_one(examples, J.predictor, f"{base}/s")
    rated = [prediction.judge_replies(s, examples, J.predictor, f"{base}/{n}", n=4) for n, s in (("p", full), ("s", single))]
    ids = [sorted(r["example_id"] for r in x.collect()) for x in rated]
    assert ids[0] == ids[1] and len(ids[0]) == 4
    assert all(not r["judge_failed"] for r in rated[0].collect())


def test_evaluation_asks_once(spark, data, tmp_path):
    examples, corpus = data
    marks = tmp_path / "marks"
    marks.mkdir()
    tables = []
    for _ in range(2):
        model = counting(marks)
        long, failures = prediction.run_evaluation(examples, corpus, model, model, str(tmp_path / "run"), judged={"pipeline": 3, "simple_baseline": 3})
        tables.append((sorted(map(str, long.collect())), sorted(map(str, failures.collect()))))
    assert tables[0] == tables[1]
    values = {(r["system"], r["metric"], r["class"]): r["value"] for r in long.collect()}
    assert values["trivial_baseline", "n", ""] == 7 and values["pipeline", "n_judged", "tone"] == 3
    sizes = {len(p.read_text()) for p in marks.iterdir() if not p.name.startswith("judge")}
    assert sizes == {1}
