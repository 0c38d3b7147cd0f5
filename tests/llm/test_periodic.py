"""Periodic runs against a plain search over all starts and periods."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import periodic, queries

WORDS = "[^\x20\x09-\x0d]+"


def plain_runs(words, least=12):
    """(start, length, period) of the maximal runs, tried for every period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            # Words i to end + q - 1 have period q and go on neither way.
            if end + q - i >= 2 * q:
                found.setdefault((i, end + q - i), q)  # smaller periods come first
            i = end
    return sorted((a, length, q) for (a, length), q in found.items() if length >= max(least, 2 * q))


def collapsed(words, runs):
    dropped = {i for a, length, q in runs for i in range(a + q, a + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def as_hashes(words):
    return np.array([zlib.crc32(w.encode()) + 1 for w in words], np.uint64)


def check(many, least=12):
    counts = np.array([len(x) for x in many], np.int64)
    flat = np.concatenate([np.empty(0, np.uint64), *map(as_hashes, many)]).astype(np.uint64)
    got = collections.defaultdict(list)
    for row, *run in zip(*(x.tolist() for x in periodic.runs_of(flat, counts, least))):
        got[row].append(tuple(run))
    for i, words in enumerate(many):
        assert got[i] == plain_runs(words, least), (i, words)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_the_plain_search(least):
    picked = random.Random(least)
    many = [[], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 100, list("ab") * 30, fibonacci(200), list("abc" * 4), list("abcabcabcabca"), ["x", *"ab" * 6, "y"]]
    for _ in range(300):
        letters = "abcdefghij"[: picked.randint(1, 5)]
        words = picked.choices(letters, k=picked.randint(0, 60))
        for _ in range(picked.randint(0, 3)):
            at = picked.randint(0, len(words))
            part = words[at : at + picked.randint(1, 9)]
            words[at:at] = part * picked.randint(1, 6)
        many.append(words)
    many += [[w for w in "ab"[i % 2] + "aab"[: i % 4]] * 20 for i in range(12)]
    check(many, least)


def test_long_runs():
    picked = random.Random(1)
    tail = [str(picked.randint(0, 10**6)) for _ in range(800)]
    check([["a"] * 3000, tail * 3 + tail[:7], fibonacci(1500)])


def rows():
    block = "one two three four five six seven "
    texts = {
        0: None, 1: "", 2: " \n\t", 3: "word", 4: "la " * 40, 5: "Intro " + block * 5 + "outro", 6: "Intro " + block * 5 + "outro",
        7: "ñ 日本 ñ 日本 ñ 日本\tñ 日本 ñ\r日本 ñ 日本 ñ", 8: ("x y " * 9 + "z ") * 4, 9: " ".join(random.Random(2).choices(["p", "q", "r"], k=3000)),
        10: "a " * 11, 11: "a " * 12, 12: "A a " * 8,
    }
    return [*((i, t, "u", 1) for i, t in texts.items()), (5, "again " * 13, "u", 1), (None, "la " * 14, "u", 1), (None, None, None, None)]


def test_operator(spark, monkeypatch):
    monkeypatch.setattr(periodic, "SLICE_BYTES", 300)
    schema = "doc_id long, text string, runs string, Periodic int"
    docs = spark.createDataFrame(rows(), schema).repartition(3)
    found = periodic.find_runs(docs)
    assert found.columns == ["doc_id", "text", "runs", "periodic"]
    got = collections.Counter()
    for r in found.collect():
        p = r["periodic"]
        got[r["doc_id"], r["text"], p["n_words"], tuple(map(tuple, p["runs"])), p["collapsed"]] += 1
    want = collections.Counter()
    for i, text, *_ in rows():
        words = re.findall(WORDS, text or "")
        runs = plain_runs(words)
        want[i, text, len(words), tuple(runs), collapsed(words, runs)] += 1
    assert got == want
    assert periodic.find_runs(spark.createDataFrame([], schema)).collect() == []


def test_strongest(spark):
    df = spark.createDataFrame([([(3, 20, 5), (1, 20, 5), (1, 20, 4), (0, 12, 1)],), ([],), (None,)], "runs array<struct<start:long,length:long,period:long>>")
    assert [r[0] and tuple(r[0]) for r in df.select(periodic.strongest(F.col("runs"))).collect()] == [(1, 20, 4), None, None]


def planted(doc_id, text):
    words = re.findall(WORDS, text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = queries.QUERIES["op13_periodic_runs"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    have = {r[0]: tuple(r)[1:] for r in got.collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(have) == len(docs)
    changed = 0
    for doc_id, text in docs:
        words = planted(doc_id, text)
        changed += words != re.findall(WORDS, text or "")
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        own = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        spelled = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        assert have[doc_id] == (len(runs), *own, sha(spelled), sha(collapsed(words, runs))), doc_id
    assert changed
