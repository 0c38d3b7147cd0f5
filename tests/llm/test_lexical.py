"""Ranked search against a plain scoring of all documents."""

import collections
import math
import random
import re

import duckdb
import numpy as np
import pytest

from threadloom.llm import lexical, queries
from threadloom.llm.common import temporary

TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k):
    """A multiset of (item, rank, key, score)."""
    own = [(key, collections.Counter(terms(text))) for key, text in docs]
    own = [x for x in own if x[1]]
    n_docs, n_terms = len(own), sum(sum(x.values()) for _, x in own)
    df = collections.Counter(t for _, x in own for t in x)
    out = collections.Counter()
    for item, text in items:
        asked, found = collections.Counter(terms(text)), []
        for key, x in own:
            m = 75 + 25 * sum(x.values()) * n_docs // n_terms
            score = sum(
                n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * x[t] // (1000 * x[t] + 12 * m))
                for t, n in asked.items() if x[t])
            if score > 0:
                found.append((-score, key is None, key))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out.update((item, place + 1, key, -score) for place, (score, _, key) in enumerate(found[:k]))
    return out


def prose(n, seed):
    picked = random.Random(seed)
    return " ".join(f"w{min(int(picked.paretovariate(0.6)), 900)}" for _ in range(n))


def rows():
    out = [(i, prose(random.Random(i).randint(1, 120), i), "x", 1) for i in range(300)]
    out += [(1000 + i, "The same TEXT of w1, w2 and ñandú-日本", "x", 1) for i in range(40)]
    out += [(2000, None, "x", 1), (2001, "", "x", 1), (2002, " --- ", "x", 1), (2003, prose(20000, 5), "x", 1), (2003, "w3 again", "x", 1),
            (None, "w1 w2 w3 no key", "x", 1), (None, None, None, None)]
    return out


ITEMS = [(0, "w1 w2"), (1, "the same text"), (2, None), (3, ""), (4, "unknown words only"), (5, prose(60, 9)), (5, prose(60, 9)), (6, "ÑANDÚ ñandú 日本 W7"),
         (None, "w5 w5 w5 w900"), (7, prose(3000, 11)), (8, "w2"), (9, "again key")]


@pytest.mark.parametrize("block_bytes, batch, turn", [(16_000_000, 512, 500_000), (3000, 4, 40)])
def test_search(spark, monkeypatch, block_bytes, batch, turn):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(lexical, "SLICE_BYTES", 1500)
    monkeypatch.setattr(lexical, "BATCH", batch)
    monkeypatch.setattr(lexical, "TURN_TERMS", turn if turn > 1000 else 2000)
    docs = spark.createDataFrame(rows(), "doc_id long, text string, score string, rank int").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id int, text string").repartition(2)
    with temporary(spark) as keep:
        index = lexical.build_index(docs, keep)
        found = lexical.search(index, items, keep, k=7)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        got = collections.Counter(map(tuple, found.collect()))
        none = lexical.search(index, items.limit(0), keep).collect()
    assert got == plain_search([r[:2] for r in rows()], ITEMS, 7)
    assert none == []


def test_empty_documents(spark):
    docs = spark.createDataFrame([(1, None), (2, "--")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    with temporary(spark) as keep:
        assert lexical.search(lexical.build_index(docs, keep), items, keep).collect() == []
        assert lexical.search(lexical.build_index(docs.limit(0), keep), items, keep).collect() == []


def test_treap_holds_every_cell():
    picked = np.random.default_rng(4)
    for rows_, columns_ in ((1, 1), (1, 50), (70, 1), (300, 90)):
        cells = np.unique(picked.integers(0, rows_ * columns_, rows_ * columns_ // 3 + 1))
        row, column = np.divmod(cells, columns_)
        tf = picked.integers(1, 100_000, len(cells))
        norms = picked.integers(75, 3000, columns_)
        height = max(1, (max(rows_, columns_) - 1).bit_length())
        treap = lexical.Treap(*lexical.build_treap(row, column, tf, norms, height), norms, height)
        for r in range(rows_):
            found, scores = treap.search(np.array([r]), np.array([3]), 10**6, 1)
            want = {c: 3 * v for c, v in zip(column[row == r].tolist(), lexical.impact(tf, norms[column])[row == r].tolist())}
            assert dict(zip(found.tolist(), scores.tolist())) == want
        some = np.unique(picked.integers(0, rows_, 8))
        weights = picked.integers(0, 50, len(some))
        scores = np.zeros(columns_, np.int64)
        for r, w in zip(some, weights):
            np.add.at(scores, column[row == r], w * lexical.impact(tf, norms[column])[row == r])
        found, own = treap.search(some, weights, 3, 1)
        least = max(1, np.sort(scores)[-min(3, columns_)])
        assert dict(zip(found.tolist(), own.tolist())) == {c: s for c, s in enumerate(scores.tolist()) if s >= least}


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    got = queries.QUERIES["op11_lexical_search"](spark, sf_dir)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    have = collections.Counter(map(tuple, got.collect()))
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert have == plain_search(docs, items, 20)
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    assert have == collections.Counter(db.sql(queries.ORACLES["op11_lexical_search"]).fetchall())
