import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.operators import retrieval
from threadloom.functions.vectors import l2_normalize


def vectors(n, d=8, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for i in range(copies):
        v[n - 1 - i] = v[0]
    return v


def side(spark, v, start=0, parts=3):
    rows = [(start + i, [float(x) for x in row]) for i, row in enumerate(v)]
    return spark.createDataFrame(rows, "id bigint, vector array<double>").repartition(parts)


def brute(q, d, k, exclude=False, q0=0, d0=0):
    out = set()
    scores = np.round(q @ d.T, 9)
    for i in range(len(q)):
        order = sorted((-scores[i, j], d0 + j) for j in range(len(d)) if not (exclude and q0 + i == d0 + j))
        out |= {(q0 + i, r + 1, doc, round(float(-s), 6)) for r, (s, doc) in enumerate(order[:k])}
    return out


def rows(df):
    return {(r["query_id"], r["rank"], r["doc_id"], round(r["score"], 6)) for r in df.collect()}


@pytest.mark.parametrize("options", [
    {}, {"way": "turns", "turn_rows": 7}, {"way": "turns"},
])
@pytest.mark.parametrize("exclude", [False, True])
def test_all_ways_equal_brute_force(spark, options, exclude):
    d = vectors(60, copies=6)
    got = retrieval.knn_topk(side(spark, d[:25]), side(spark, d), 3, exclude_self=exclude, **options)
    assert rows(got) == brute(d[:25], d, 3, exclude)


def test_large_query_side_takes_the_small_documents_along(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "BROADCAST_VALUES", 8 * 20)
    q, d = vectors(50, seed=1), vectors(15, seed=2)
    assert rows(retrieval.knn_topk(side(spark, q), side(spark, d), 4)) == brute(q, d, 4)
    with pytest.raises(ValueError):
        retrieval.knn_topk(side(spark, q), side(spark, q), 4, way="broadcast")
    assert rows(retrieval.knn_topk(side(spark, q), side(spark, q), 2)) == brute(q, q, 2)


def test_equal_vectors_keep_the_smallest_ids(spark):
    d = np.tile(vectors(1), (40, 1))
    for way in ("auto", "turns"):
        got = retrieval.knn_topk(side(spark, d[:2]), side(spark, d), 5, way=way)
        assert {(r["query_id"], r["doc_id"]) for r in got.collect()} == {(q, i) for q in (0, 1) for i in range(5)}


@pytest.mark.parametrize("exclude", [False, True])
def test_blocks_inside_a_task(monkeypatch, exclude):
    monkeypatch.setattr(retrieval, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(retrieval, "BLOCK_DOCUMENTS", 11)
    d = vectors(90, copies=9)
    top = retrieval._QueryBlocks(np.arange(30), d[:30], 4, exclude)
    for at in range(0, 90, 25):
        top.add(np.arange(at, min(90, at + 25)), d[at:at + 25])
    got = {}
    for batch in top.batches():
        for q, doc, score in zip(*[c.to_pylist() for c in batch.columns]):
            got.setdefault(q, []).append((doc, round(score, 6)))
    want = {}
    for q, rank, doc, score in sorted(brute(d[:30], d, 4, exclude)):
        want.setdefault(q, []).append((doc, score))
    assert got == want


def test_fewer_documents_than_k_and_no_documents(spark):
    d = vectors(2)
    assert retrieval.knn_topk(side(spark, d), side(spark, d), 5).count() == 4
    empty = side(spark, d).where("id < 0")
    assert retrieval.knn_topk(side(spark, d), empty, 5).count() == 0
    assert retrieval.knn_topk(empty, side(spark, d), 5).count() == 0
    assert retrieval.knn_topk(side(spark, d), empty, 5, way="turns").count() == 0


def test_normalize_leaves_zero_alone(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r[0] for r in df.select(l2_normalize(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_nested_and_context(spark):
    hits = spark.createDataFrame([(1, 2, 11, 0.5), (1, 1, 10, 0.987)], "query_id bigint, rank int, doc_id bigint, score double")
    corpus = spark.createDataFrame([(10, "q10", "a10"), (11, "q11", "a11")], "thread_id bigint, customer_query string, brand_response string")
    nested = retrieval.neighbours_nested(retrieval.with_documents(hits, corpus))
    assert [tuple(x) for x in nested.first()["similar_threads"]] == [("q10", "a10", 0.987), ("q11", "a11", 0.5)]
    assert retrieval.retrieval_context(nested).first()["context"] == (
        "Example 1 (similarity: 0.99):\n  Customer: q10\n  Brand response: a10\n\n"
        "Example 2 (similarity: 0.50):\n  Customer: q11\n  Brand response: a11"
    )


def test_leak_rate(spark):
    hits = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "query_id bigint, doc_id bigint")
    assert tuple(retrieval.leak_rate(hits).first()) == (2, 1, 0.5)


def test_text_vectors_rank_the_same_words_first(spark):
    texts = ["battery drains fast", "cannot log in to account", "battery empty very fast", "log in fails", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    encoded = retrieval.text_vectors(df, "id")
    lengths = [sum(x * x for x in r["embedding"]) for r in encoded.orderBy("id").collect()]
    assert np.allclose(lengths, [1, 1, 1, 1, 0])
    documents = encoded.select("id", F.col("embedding").alias("vector"))
    best = retrieval.knn_topk(documents.where("id < 2"), documents, 1, exclude_self=True)
    assert {r["query_id"]: r["doc_id"] for r in best.collect()} == {0: 2, 1: 3}


def test_documents_are_not_shuffled_when_queries_are_few(spark):
    d = side(spark, vectors(30), parts=2)
    text = retrieval.knn_topk(d.limit(3), d)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in text and "Join" not in text


@pytest.mark.parametrize("way", ["auto", "turns"])
@pytest.mark.parametrize("bad", [[1.0], [0.6, None], [0.6, float("nan")], [1.0, 0.0, 0.0]])
def test_vectors_of_another_width_or_with_gaps_stop_the_search(spark, way, bad):
    schema = "id bigint, vector array<double>"
    queries = spark.createDataFrame([(1, [1.0, 0.0])], schema)
    documents = spark.createDataFrame([(1, bad), (2, [0.0, 1.0])], schema).coalesce(1)
    for left, right in ((queries, documents), (documents, queries)):
        with pytest.raises(Exception, match="missing numbers or of another width"):
            retrieval.knn_topk(left, right, way=way).collect()


def test_few_documents_reach_the_floors_of_a_turn(monkeypatch):
    """each turn took all 4,096 documents of its first block as hits of every query, before one was compared."""
    q, d = vectors(200, seed=1), vectors(4096, seed=2)
    taken, merge = [], retrieval._TopHits.merge

    def watched(self, row, docs, scores):
        taken.append(len(row))
        merge(self, row, docs, scores)

    largest, nonzero, flat = [], np.nonzero, np.flatnonzero
    monkeypatch.setattr(retrieval._TopHits, "merge", watched)
    monkeypatch.setattr(np, "nonzero", lambda x: largest.append(np.count_nonzero(x)) or nonzero(x))
    monkeypatch.setattr(np, "flatnonzero", lambda x: largest.append(np.count_nonzero(x)) or flat(x))
    top = retrieval._QueryBlocks(np.arange(200), q, 3, False)
    top.add(np.arange(4096), d)
    assert max(largest) <= 64 * 200 and sum(taken) < 0.02 * len(q) * len(d)
    [batch] = top.batches()
    assert set(zip(batch["query_id"].to_pylist(), batch["doc_id"].to_pylist())) == {(i, doc) for i, _, doc, _ in brute(q, d, 3)}
