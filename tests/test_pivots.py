"""Search in turns and search with pivot bounds against brute force, and the plans of both."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom.operators import pivots, retrieval, rotation
from test_retrieval import brute, rows, side, vectors


def clustered(n, centres=12, d=16, noise=0.05, seed=3):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(centres, d))[rng.integers(0, centres, n)] + noise * rng.normal(size=(n, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


@pytest.mark.parametrize("exclude", [False, True])
@pytest.mark.parametrize("turn_rows", [None, 9])
def test_pruned_search_equals_brute_force(spark, exclude, turn_rows):
    d = vectors(90, copies=6)
    index = pivots.build_pivot_index(side(spark, d), pivots=5)
    assert rows(pivots.knn_pruned(side(spark, d[:40]), index, 4, exclude_self=exclude, turn_rows=turn_rows)) == brute(d[:40], d, 4, exclude)


def test_clusters_leave_out_most_pairs(spark, tmp_path):
    d = clustered(3000)
    pivots.build_pivot_index(side(spark, d, parts=4), str(tmp_path / "index"), pivots=12)
    index = pivots.open_pivot_index(spark, str(tmp_path / "index"))
    q = clustered(400, seed=3)
    found, compared = pivots.knn_pruned_counted(side(spark, q, start=10_000), index, 3, turn_rows=150)
    assert rows(found) == brute(q, d, 3, q0=10_000)
    assert compared < 0.25 * len(q) * len(d)


def test_zero_and_long_vectors_are_found(spark):
    rng = np.random.default_rng(5)
    d = rng.normal(size=(80, 4)) * rng.uniform(0, 3, size=(80, 1))
    d[7] = d[8] = 0
    index = pivots.build_pivot_index(side(spark, d), pivots=6)
    q = np.vstack([d[:20], -d[20:30]])
    assert rows(pivots.knn_pruned(side(spark, q), index, 5)) == brute(q, d, 5)


def test_few_and_no_rows(spark):
    d = vectors(2)
    some, empty = side(spark, d), side(spark, d).where("id < 0")
    assert pivots.knn_pruned(some, pivots.build_pivot_index(some), 5).count() == 4
    assert pivots.knn_pruned(some, pivots.build_pivot_index(empty), 5).count() == 0
    assert pivots.knn_pruned(empty, pivots.build_pivot_index(some), 5).count() == 0
    same = side(spark, np.tile(vectors(1), (30, 1)))
    got = pivots.knn_pruned(same, pivots.build_pivot_index(same), 2)
    assert {r["doc_id"] for r in got.collect()} == {0, 1}


def test_gaps_stop_the_index(spark):
    bad = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "id bigint, vector array<double>").coalesce(1)
    with pytest.raises(Exception, match="of another width"):
        pivots.build_pivot_index(bad)


def test_row_groups_are_skipped_by_the_pivot_columns(spark):
    index = pivots.build_pivot_index(side(spark, clustered(200)), pivots=3)
    plan = index.documents.where(F.col("p1").between(0.1, 0.2) & F.col("home").isin([0, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(p1,0.1)" in plan and "In(home, [0,2])" in plan


def test_a_turn_moves_no_documents_and_copies_no_rows(spark, monkeypatch):
    plans = []
    keep = rotation.Rotation.keep

    def watched(self, result):
        plans.append(result._jdf.queryExecution().optimizedPlan().toString())
        keep(self, result)

    monkeypatch.setattr(rotation.Rotation, "keep", watched)
    d = vectors(60)
    found = retrieval.knn_topk(side(spark, d), side(spark, d), 3, way="turns", turn_rows=20)
    assert rows(found) == brute(d, d, 3)
    assert len(plans) == 3
    for plan in plans:
        below = plan[plan.index("MapInArrow"):]
        assert "Generate" not in plan and "Join" not in plan and "Repartition" not in below and "Sort" not in below


def test_a_turn_reads_its_own_rows_only(spark):
    blocks = rotation.Rotation(side(spark, vectors(50)), 10, 50)
    sizes = [block.num_rows for block in blocks]
    assert sum(sizes) == 50 and len(sizes) == blocks.turns == 5
    plan = blocks.stored.where("turn = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(turn" in plan


@pytest.mark.parametrize("own_home", [True, False])
def test_many_queries_of_a_turn_meet_documents_a_few_at_a_time(own_home):
    """all queries of a turn and a batch of documents made one matrix, of 82 MB here, and its places another 160."""
    q, d = vectors(20_000), vectors(512, seed=1)
    pivot_vectors = q[:3]
    far, none = pivots._distances(q, pivot_vectors), np.full(len(q), np.inf)
    homes = np.zeros(len(q), np.int32)
    shared = SimpleNamespace(value=[np.arange(len(q)), q, homes, far, none, -none, 3, False])
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(d))), pa.array(d.tolist()), pa.array(np.full(len(d), 0 if own_home else 1, np.int32)),
         *(pa.array(x) for x in pivots._distances(d, pivot_vectors).T)], ["id", "vector", "home", "p0", "p1", "p2"])
    tracemalloc.start()
    try:
        found = list(pivots._search(shared, own_home, 3)(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 60e6
    hits = {r["query_id"]: r["score"] for b in found for r in b.to_pylist() if r["query_id"] is not None}
    assert len(hits) == len(q) and sum(b["compared"][-1].as_py() for b in found) == len(q) * len(d)
    best = {(i, doc) for b in found for i, doc in zip(b["query_id"].to_pylist(), b["doc_id"].to_pylist()) if i is not None and i < 50}
    assert best == {(i, doc) for i, _, doc, _ in brute(q[:50], d, 3)}
