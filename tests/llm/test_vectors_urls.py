"""Vector near-duplicates and URL filters against plain versions."""

import collections
import math

import brute as B
import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import vectors
from threadloom.llm.queries import URL_RULES
from threadloom.llm.url_filters import judge_urls


def vector_rows():
    rng = np.random.default_rng(4)
    out = []
    for family in range(12):
        centre = rng.normal(size=16)
        for member in range(25):
            spread = rng.choice([0.02, 0.15, 0.3, 0.6])
            out.append((100 * family + member, (centre + spread * rng.normal(size=16)).tolist(), family % 3))
    same = out[0][1]
    out += [(5000 + i, same, 0) for i in range(30)] + [(5100, [2 * x for x in same], 0), (5101, same, 1), (5102, same, None)]
    out += [(6000, None, 0), (6001, [], 0), (6002, [0.0] * 16, 0), (6003, [None] + same[1:], 0), (6004, [math.nan] + same[1:], 0),
            (6005, [math.inf] + same[1:], 0), (6006, same[:8], 0), (6007, [1.0], 0), (6008, [3.0], 0), (None, same, 0)]
    return out


@pytest.mark.parametrize("cell_rows,block", [(256, 1024), (4, 1024), (8, 16)])
def test_near_vectors(spark, monkeypatch, cell_rows, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = vector_rows()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("visits", F.lit(1))
    got = vectors.near_vectors(table, cell_rows=cell_rows).collect()
    assert len(got) == len(rows)
    named = [r for r in rows if r[0] is not None]
    links = B.cosine_links(named)
    want = B.components([r[0] for r in named], links)
    counts = collections.Counter(x for pair in links for x in pair)
    by_key = {r["vec_id"]: r for r in got}
    assert (by_key[None]["n_links"], by_key[None]["component_id"], by_key[None]["kept"]) == (0, None, False)
    found = sum(by_key[i]["n_links"] for i, *_ in named)
    assert found <= 2 * len(links) and found >= 0.99 * 2 * len(links)
    for i, *_ in named:
        r = by_key[i]
        assert r["n_links"] <= counts[i] and r["kept"] == (r["component_id"] == i)
        assert want[r["component_id"]] == want[i]
    if cell_rows == 256:
        assert all(by_key[i]["n_links"] == counts[i] and by_key[i]["component_id"] == want[i] for i, *_ in named)
        assert vectors.near_vectors(table.limit(0)).collect() == []


def test_multi_sequence_order_is_by_the_sum_of_distances():
    rng = np.random.default_rng(1)
    index = vectors.MultiIndex(rng.normal(size=(5, 3)), rng.normal(size=(4, 3)), 20)
    unit = rng.normal(size=(30, 6))
    total = vectors._distances(unit[:, :3], index.left)[:, :, None] + vectors._distances(unit[:, 3:], index.right)[:, None, :]
    for visits in (1, 3, 20):
        got = index.order(unit, visits)
        want = np.sort(total.reshape(30, -1), axis=1)[:, :visits]
        assert np.allclose(np.take_along_axis(total.reshape(30, -1), got, 1), want)


URLS = [
    "http://com/", "https://a.COM/x", "http://example.com/en/1", "http://www.example.com/en/1", "http://m.www.example.com/en/",
    "http://badexample.com/en/1", "http://example.com/EN/1", "http://example.com", "http://x.net/es/a?b/fr/", "http://x.net?/es/",
    "http://net/fr/#x", "HTTP://X.NET/fr/a/b/c", "nothing", "", None, "a://b://c.net/es/", "http:///en/", "http://x.net/es", "x\n://q.com/a\nb",
    "http://example.com/en/" + "/".join("d" * 3 for _ in range(3000)), "http://example.com/en/1",
]


@pytest.mark.parametrize("rules", [URL_RULES, (("com", "", "allow"), ("com", "/e", "block"), ("com", "/e", "allow"), (None, "/", "block"), ("b.com", "/x/y", "block"))])
def test_urls(spark, rules):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    pages = pages.unionByName(pages)
    urls = URLS + ["http://a.b.com/x/y", "http://a.b.com/x/z", "http://c.com/eee"]
    pages = pages.unionByName(spark.createDataFrame([(len(URLS) + i, u, "x") for i, u in enumerate(urls[len(URLS):])], pages.schema))
    got = judge_urls(pages, spark.createDataFrame(list(rules), "host string, path string, verdict string")).collect()
    assert len(got) == 2 * len(URLS) + 3
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == B.judge(urls[r["page_id"]], [x for x in rules if None not in x])
    assert judge_urls(pages.limit(0), spark.createDataFrame([], "host string, path string, verdict string")).collect() == []
