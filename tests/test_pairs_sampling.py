import hashlib

import pytest

from pyspark.sql import functions as F

from threadloom.operators import pairs, sampling

TURNS = "thread_id string, seq bigint, role string, text string"


def turns(spark, threads):
    rows = [(t, i, role, text) for t, says in threads.items() for i, (role, text) in enumerate(says)]
    return spark.createDataFrame(rows, TURNS).repartition(3)


def test_first_pairs(spark):
    found = pairs.first_pairs(turns(spark, {
        "usual": [("customer", "q"), ("customer", "q2"), ("brand", "a"), ("brand", "a2")],
        "brand_first": [("brand", "hi"), ("customer", "q"), ("brand", "a")],
        "brand_only_before": [("brand", "hi"), ("customer", "q")],
        "no_brand": [("customer", "q"), ("customer", "q2")],
        "no_customer": [("brand", "a")],
        "blank_question": [("customer", ""), ("customer", "q"), ("brand", "a")],
    }))
    got = {r["thread_id"]: (r["customer_query"], r["brand_response"], r["brand_seq"]) for r in found.collect()}
    assert got == {"usual": ("q", "a", 2), "brand_first": ("q", "a", 2), "blank_question": ("q", "a", 2)}


def test_context_and_pages_keep_order_and_lose_nothing(spark):
    long = [("customer" if i % 2 else "brand", f"m{i}") for i in range(25)]
    df = turns(spark, {"long": long, "short": long[:3]})
    context = {r["thread_id"]: [t["text"] for t in r["context"]] for r in pairs.thread_context(df).collect()}
    assert context == {"long": [f"m{i}" for i in range(6)], "short": ["m0", "m1", "m2"]}
    pages = pairs.thread_pages(df, page_turns=10).where("thread_id = 'long'").orderBy("page").collect()
    assert [len(p["turns"]) for p in pages] == [10, 10, 5]
    assert [t["text"] for p in pages for t in p["turns"]] == [text for _, text in long]


def test_samples_are_the_hash_order_under_any_partitioning(spark):
    ids = [str(i) for i in range(500)]
    want = sorted(ids, key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())[:20]
    for parts in (1, 5):
        df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(parts)
        assert [r["id"] for r in sampling.sample_rows(df, "id", 20).collect()] == want
    assert sampling.sample_rows(df, "id", 1000).count() == 500
    assert sampling.sample_rows(df, "id", 20, seed=7).count() == 20


def test_large_samples_cut_at_a_prefix_give_the_same_rows(spark, monkeypatch):
    df = spark.range(3000)
    want = {n: {r["id"] for r in sampling.sample_rows(df, "id", n).collect()} for n in (1, 777, 2999, 3000, 4000)}
    monkeypatch.setattr(sampling, "ONE_TASK_SAMPLE", 0)
    for n, ids in want.items():
        rows = [r["id"] for r in sampling.sample_rows(df, "id", n).collect()]
        assert len(rows) == min(n, 3000) and set(rows) == ids


def test_sample_threads_keeps_whole_threads(spark):
    df = turns(spark, {f"t{i}": [("customer", "q"), ("brand", "a"), ("customer", "b")] for i in range(30)})
    sizes = sampling.sample_threads(df, 7).groupBy("thread_id").count().collect()
    assert len(sizes) == 7 and {r["count"] for r in sizes} == {3}


def test_prefix_dedup_and_golden_sample(spark):
    same = "x" * 80
    says = {
        "a": [("customer", same + " one"), ("brand", "r1")],
        "b": [("customer", "  " + "y"), ("brand", "r2")],
        "c": [("customer", same.upper() + " two"), ("brand", "r3")],
        "d": [("customer", "Y"), ("brand", "r4")],
    }
    sample = sampling.golden_sample(pairs.first_pairs(turns(spark, says)), 10)
    assert {r["thread_id"]: r["brand_response_actual"] for r in sample.collect()} == {"a": "r1", "b": "r2"}
    row = sampling.shortfall(sample, 10).first()
    assert (row["n_rows"], row["shortfall"]) == (2, 8)


def test_stratified_sample_fills_each_stratum(spark):
    df = spark.range(200).select("id", F.when(F.col("id") < 190, "big").otherwise("small").alias("s"))
    got = {r["s"]: r["count"] for r in sampling.stratified_sample(df, "s", "id", 15).groupBy("s").count().collect()}
    assert got == {"big": 15, "small": 10}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_limit_groups_before_the_shuffle(spark):
    df = turns(spark, {"t": [("customer", "q")]})
    for limited in (pairs.first_turns(df), sampling.keep_first(df, "role", "seq"), sampling.stratified_sample(df, "role", "seq", 5)):
        text = plan(limited)
        assert "Partial" in text and "WindowGroupLimit" in text
    assert "TakeOrderedAndProject" in plan(sampling.sample_rows(df, "seq", 5))


def test_both_ways_of_sampling_treat_null_keys_alike(spark, monkeypatch):
    rows = spark.range(400).selectExpr("CASE WHEN id % 40 = 0 THEN NULL ELSE id % 150 END AS k")
    small = sampling.sample_rows(rows, "k", 60).collect()
    monkeypatch.setattr(sampling, "ONE_TASK_SAMPLE", 2)
    large = sampling.sample_rows(rows, "k", 60).collect()
    assert len(small) == len(large) == 60
    assert sorted(map(str, small)) == sorted(map(str, large))
    assert sum(r["k"] is None for r in small) == 10


@pytest.mark.parametrize("limit", [3, 100_000])
def test_rows_of_one_key_are_sampled_by_their_content(spark, monkeypatch, limit):
    monkeypatch.setattr(sampling, "ONE_TASK_SAMPLE", limit)
    rows = spark.createDataFrame([(i % 3 if i % 7 else None, f"t{i % 40}", {"a": i}) for i in range(120)], "k int, text string, extra map<string,int>")
    found = []
    for parts in (1, 4, 16):
        some = sampling.sample_rows(rows.repartition(parts), "k", 50).select("k", "text").collect()
        found.append(sorted((str(r["k"]), r["text"]) for r in some))
    assert found[0] == found[1] == found[2] and len(found[0]) == 50
