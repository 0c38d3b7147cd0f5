"""User columns with the operators' own working names, and samples of tables with a hot group."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from threadloom.llm import common, decontaminate as D, kernels as K, language, quality, secrets, sharding, url_filters

NAMES = [
    "_language", "_row", "_text", "_base", "_assign", "_access", "_hex", "_rest", "_runs", "_likely", "_hit", "_hit_column",
    "_secrets_column", "_key", "_lang", "_many", "_rank", "_bytes", "_low", "_host", "_path", "_at", "_id", "_part", "_before", "_tie",
    "row", "best", "items", "spans", "n_words", "key", "mark", "size", "part",
]
WORDS = ["".join(random.Random(k).choices("abcdefghij", k=5)) for k in range(200)]


def prose(seed, n):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def crowded(spark, rows, schema, upper=False):
    """The rows with a text column of every working name, in either case."""
    df = spark.createDataFrame(rows, schema)
    return df.select("*", *[F.lit(f"own {n}").alias(n.upper() if upper else n) for n in NAMES])


def untouched(df, upper):
    names = [n.upper() if upper else n for n in NAMES]
    return all(r[n] == f"own {n.lower()}" for r in df.select(*names).collect() for n in names)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("items"))
    spark.createDataFrame([(1, prose(900, 40)), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def documents():
    texts = [prose(i, 60) for i in range(12)]
    rows = [(i, t, "aa") for i, t in enumerate(texts)]
    rows += [(50, texts[3], "aa"), (51, prose(5000, 40) + " " + prose(900, 40), "aa"), (52, prose(5001, 30) + " password=abcdef12", None)]
    rows += [(60, None, "aa"), (61, "", None), (None, prose(5002, 30), "aa"), (None, None, None), (0, texts[0], "aa")]
    return rows


@pytest.mark.parametrize("upper", [False, True])
@pytest.mark.parametrize("stage", [name for name, _ in P.STAGES[:-1]])
def test_stages_leave_the_columns_of_working_names(spark, folder, stage, upper):
    docs = crowded(spark, documents(), "doc_id long, text string, lang string", upper)
    after = dict(P.STAGES)[stage](spark, docs, folder)
    assert after.columns == docs.columns and after.count() > 5 and untouched(after, upper)
    plain = dict(P.STAGES)[stage](spark, spark.createDataFrame(documents(), "doc_id long, text string, lang string"), folder)
    assert sorted(map(repr, after.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
    assert dict(P.STAGES)[stage](spark, docs.limit(0), folder).count() == 0


@pytest.mark.parametrize("upper", [False, True])
def test_operators_leave_the_columns_of_working_names(spark, folder, upper):
    docs = crowded(spark, documents(), "doc_id long, text string, lang string", upper)
    found = secrets.scan(docs, secrets.MarkovModel((0.0,) * len(secrets.ALPHABET) ** 2))
    assert found.columns == docs.columns + ["secrets"] and untouched(found, upper)
    assert {r["doc_id"] for r in found.filter(F.size("secrets") > 0).collect()} == {52}
    sharded = sharding.assign_shards(docs, ["text", "doc_id"], shards=3)
    assert untouched(sharded, upper) and sorted(r["row_number"] for r in sharded.collect()) == list(range(len(documents())))
    back = sharding.locate(sharded.drop("row_number"), len(documents()), shards=3)
    assert untouched(back, upper) and sorted(r["row_number"] for r in back.collect()) == list(range(len(documents())))
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    for limit in (D.BROADCAST_BYTES, 1):  # both ways to compare
        hit = D.decontaminate(docs, items, broadcast_bytes=limit)
        assert hit.columns == docs.columns + ["hit"] and untouched(hit, upper)
        assert {r["doc_id"]: r["hit"]["items"] for r in hit.filter("hit.n_hit > 0").collect()} == {51: ["1"]}
    pages = crowded(spark, [(1, "http://a.example.com/en/x"), (2, None), (3, "http://b.net/q")], "page_id long, url string", upper)
    rules = spark.createDataFrame([("example.com", "/en/", "block")], "host string, path string, verdict string")
    judged = url_filters.judge_urls(pages, rules)
    assert untouched(judged, upper)
    assert {r["page_id"]: r["verdict"] for r in judged.collect()} == {1: "block", 2: "allow", 3: "allow"}


def test_fresh_names():
    assert common.fresh(["_A", "__a", "b"], "_a", "b", "c") == ["___a", "_b", "c"]


@pytest.mark.parametrize("n,rows", [(100_000, 50), (40_000, 1_500), (300, 1_500), (1, 5)])
def test_the_hash_cut_keeps_the_smallest(spark, n, rows):
    order = F.xxhash64("id", F.lit(9))
    keys = spark.range(n)
    cut = keys.filter(common.low_hash(order, rows, n))
    smallest = [r[0] for r in keys.orderBy(order).limit(rows).collect()]
    assert [r[0] for r in cut.orderBy(order).limit(rows).collect()] == smallest
    assert cut.count() <= max(4_000, 3 * rows)


def test_language_sample_with_a_hot_language_a_hot_key_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(language, "FIT_ROWS", 20)
    spelled = ["".join(chr(97 + int(d)) for d in str(i)) + "x" for i in range(4_000)]
    rows = [(i, f"{w} {w}", "aa") for i, w in enumerate(spelled)] + [(i, f"{spelled[i]} {spelled[i]}", "aa") for i in (7, 8)] * 500
    rows += [(i, f"cold{i} cold{i}", "bb") for i in range(10)] + [(None, "nokey nokey", "aa"), (None, "only only", "cc")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    chosen = {r[0] for r in spark.range(4_000).orderBy(F.xxhash64("id", F.lit(9)), "id").limit(20).collect()}
    model = language.fit(table)
    raw, at = K.text_buffer(pa.array([*spelled, "nokey", "only"]))
    known = model.words.find(K.span_hashes(raw, at[:-1], at[1:])) >= 0
    assert set(np.flatnonzero(known).tolist()) == chosen and model.languages == ["aa", "bb"]
    again = language.fit(table.repartition(7))
    assert (again.word_logs == model.word_logs).all() and (again.gram_logs == model.gram_logs).all()


def test_quality_sample_is_the_smallest_hashes_of_each_label(spark, monkeypatch):
    monkeypatch.setattr(quality, "FIT_ROWS", 30)
    taken = []
    monkeypatch.setattr(quality, "_fit", lambda bad, good: taken.append((bad, good)))
    ids = spark.range(9_000).select(F.col("id").alias("doc_id"))
    docs = ids.select("doc_id", F.concat(F.lit("text "), "doc_id").alias("text")).unionByName(
        spark.createDataFrame([(5, "text 5"), (None, "none")], "doc_id long, text string"))
    labels = ids.select("doc_id", (F.col("doc_id") % 10 > 0).cast("int").alias("quality"))
    quality.fit(docs, labels)
    for label, texts in enumerate(taken[0]):
        own = labels.filter(F.col("quality") == label).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(30)
        assert texts == [f"text {r['doc_id']}".encode() for r in own.collect()]
