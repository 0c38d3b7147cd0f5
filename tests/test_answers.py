import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadloom import constants as C
from threadloom.operators import predictions as P

BAD = ["I am not sure.", '{"intent": "how_to", ', "", None, '{"a": 1} and {"b": 2}', '{"a": 1}] then [2]', "{'a': 1}", '{"a":1},{"b":2}']


def answers(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "example_id bigint, response string")


def parsed(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("example_id").collect()]


def test_json_is_found_in_every_wrapping(spark):
    texts = [
        '{"a": 1}', '```json\n{"a": 1}\n```', '```\n{"a": 1}```', '<think>{no}</think>\n {"a": 1}', 'Sure {"a": 1} done', "[1, 2]",
        '{"a": {"b": [1, {"c": "}"}]}}', '{"a": 1, "a": 2}', '  {"a": "x\\"y"}　',
    ]
    got = P.parse_json(answers(spark, texts + BAD)).orderBy("example_id").select(F.col("parsed").cast("string").alias("p")).collect()
    values = [None if r["p"] is None else json.loads(r["p"]) for r in got]
    assert values[: len(texts)] == [{"a": 1}] * 5 + [[1, 2], {"a": {"b": [1, {"c": "}"}]}}, {"a": 2}, {"a": 'x"y'}]
    assert values[len(texts):] == [None] * len(BAD)


def test_intents(spark):
    texts = [
        '{"intent": "how_to", "confidence": "high"}', '{"intent": "how_to"}', '{"intent": "How_To", "confidence": "medium"}',
        '{"confidence": "high"}', '{"intent": null}', '{"intent": 3}', '{"intent": ["how_to"], "confidence": "high"}',
        '{"intent": {"x": 1}}', '[{"intent": "how_to"}]', '{"intent": "other", "confidence": null}', *BAD[:4],
    ]
    got = parsed(P.parse_intents(answers(spark, texts)), "intent", "intent_confidence", "intent_failed")
    assert got == [
        ("how_to", "high", False), ("how_to", "unknown", False), ("other", "medium", False), ("other", "high", False),
        ("other", "unknown", False), ("other", "unknown", False), ("other", "low", True), ("other", "low", True),
        ("other", "low", True), ("other", None, False), *[("other", "low", True)] * 4,
    ]


def test_escalations(spark):
    texts = ['{"escalate": "YES", "reason": "angry"}', '{"escalate": "no"}', '{"escalate": "maybe"}', '{"escalate": true}', "{}",
             '{"escalate": null}', '{"escalate": ["yes"]}', "[1]", None]
    got = parsed(P.parse_escalations(answers(spark, texts)), "escalate", "escalation_reason", "defaulted")
    assert got == [
        ("yes", "angry", False), ("no", "", False), ("no", "", True), ("no", "", True), ("no", "", True), ("no", "", True),
        ("no", "", True), ("yes", C.ESCALATION_ERROR_REASON, True), ("yes", C.ESCALATION_ERROR_REASON, True),
    ]


def test_replies(spark):
    texts = ['  "Hello"  ', "", None, "x " * 160]
    got = parsed(answers(spark, texts).withColumn("reply", P.finish_reply(F.col("response"))), "reply")
    assert [r[0] for r in got] == ["Hello", "", C.REPLY_ON_ERROR, ("x " * 140).rsplit(" ", 1)[0] + "..."]


def test_label_shapes(spark):
    values = ['" How_To "', '["A", "b"]', "[]", '{"category": "X"}', '{"value": {"intent": ["Deep"]}}', '{"other_key": 1}', "3", "true",
              "null", '{"category": null}', '[null]']
    df = answers(spark, values).withColumn("v", F.try_parse_json("response"))
    got = [r[0] for r in parsed(P.normalize_labels(df, "v"), "label")]
    assert got == ["how_to", "a", "other", "x", "deep", "other", "3", "true", "none", "none", "none"]


def test_labels_nested_to_any_depth(spark):
    def nested(depth):
        return '{"intent": ' * depth + '"How_To"' + "}" * depth
    df = answers(spark, [nested(d) for d in (1, 2, 4, 10, 40)] + ['{"intent": {"x": {"intent": "a"}}}']).withColumn("v", F.try_parse_json("response"))
    assert [r[0] for r in parsed(P.normalize_labels(df, "v"), "label")] == ["how_to"] * 5 + ["other"]


def test_golden_labels(spark):
    texts = ['note {"intent": "how_to", "escalate": "no"} end', "```json\n{\"intent\": \"other\"}\n```", "nothing", None, "[]"]
    got = parsed(P.parse_labels(answers(spark, texts)), "intent", "escalate", "escalation_reason", "auto_labeled")
    assert got == [("how_to", "no", "", True), ("other", "", "", True), *[("", "", "", False)] * 3]


def test_judge_scores(spark):
    good = {"helpfulness": 4, "tone": 5, "groundedness": 3}
    cases = [
        (good, (4, 5, 3, 4.0, False)),
        ({**good, "tone": 4.7}, (4, 4, 3, 3.67, False)),
        ({"tone": 9, "groundedness": -2}, (3, 5, 1, 3.0, False)),
        ({**good, "tone": " +2 "}, (4, 2, 3, 3.0, False)),
        ({**good, "tone": "1_0"}, (4, 5, 3, 4.0, False)),
        ({**good, "tone": True}, (4, 1, 3, 2.67, False)),
        ({**good, "tone": "4.7"}, (3, 3, 3, 3.0, True)),
        ({**good, "tone": None}, (3, 3, 3, 3.0, True)),
        ({**good, "tone": [4]}, (3, 3, 3, 3.0, True)),
        ({**good, "tone": ""}, (3, 3, 3, 3.0, True)),
        ([good], (3, 3, 3, 3.0, True)),
    ]
    df = answers(spark, [json.dumps(c) for c, _ in cases] + ["no json", None])
    got = parsed(P.parse_judge_scores(df), *C.DIMENSIONS, "overall", "judge_failed")
    assert got == [e for _, e in cases] + [(3, 3, 3, 3.0, True)] * 2


def test_single_prompt_baseline(spark):
    texts = ['{"intent": "Weird", "reply": "Hi", "escalate": true, "escalation_reason": "r"}', "{}", "broken"]
    got = parsed(P.single_prompt_baseline(answers(spark, texts)), "intent", "reply", "escalate", "escalation_reason")
    assert got == [
        ("Weird", "Hi", "true", "r"), ("other", C.SINGLE_PROMPT_REPLY, "no", ""),
        (C.TRIVIAL_INTENT, C.TRIVIAL_REPLY, "yes", C.TRIVIAL_REASON),
    ]


def test_prompts_model_and_assembly(spark):
    examples = spark.createDataFrame([(1, "help {me}"), (2, None)], "example_id bigint, customer_query string")
    templates = {"intent": "Say {customer_query}! {{json}} {rules}", "reply": "R {customer_query}", "escalation": "E"}
    prompts = P.render_prompts(examples, templates, rules="R1")
    texts = {(r["example_id"], r["stage"]): r["prompt"] for r in prompts.collect()}
    assert texts[1, "intent"] == "Say help {me}! {json} R1" and texts[2, "intent"] == "Say ! {json} R1"

    def model(batches):
        for batch in batches:
            out = {"intent": '{"intent": "how_to", "confidence": "high"}', "reply": " 'ok' ", "escalation": "oops"}
            yield pd.DataFrame({"example_id": batch.example_id, "stage": batch.stage, "response": batch.stage.map(out)})

    responses = P.run_predictor(prompts.where("example_id = 1"), model)
    rows = P.assemble_predictions(examples, responses).orderBy("example_id").collect()
    assert (rows[0]["intent"], rows[0]["reply"], rows[0]["escalate"]) == ("how_to", "ok", "yes")
    assert (rows[1]["intent"], rows[1]["intent_confidence"], rows[1]["reply"]) == ("other", "low", C.REPLY_ON_ERROR)


def test_trivial_and_majority(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "a")], "example_id bigint, intent string")
    assert P.majority_intent(df).first()["intent"] == "a"
    row = P.trivial_baseline(df.select("example_id")).first()
    assert (row["intent"], row["reply"], row["escalate"]) == (C.TRIVIAL_INTENT, C.TRIVIAL_REPLY, "yes")


@pytest.mark.parametrize("done,left", [([], [1, 2, 3]), ([2], [1, 3])])
def test_pending(spark, done, left):
    queries = spark.createDataFrame([(1,), (2,), (3,)], "example_id bigint")
    stored = spark.createDataFrame([(i,) for i in done], "example_id bigint")
    assert sorted(r[0] for r in P.pending(queries, stored).collect()) == left
