"""Word BPE against the tokenizers library."""

import collections
import hashlib
import random
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadloom.llm import kernels as K, queries, word_bpe
from threadloom.llm.common import temporary

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "B", "'s", "'t", "'", "''", "'LL", "'ve", "re", "'RE", "'d", " ", "  ", "\n", "\t", " ", "\u0085", "1", "12", "é", "É", "×", "Þ",
         "ß", "!", "...", "<|startoftext|>", "<|endoftext|>", "<|end", "日本", "…", "\r\n", "²", "½", "ª", "µ", "ɀ", "İ", "Σ", "ΑΣ", "é", "J̌",
         "́", "ͅ", "K", "ﬁ", "\x00", "\x1c", "\U0001f600", "한", "하", "ǅ", "hello", "WORLD"]


@cache
def library():
    own = Tokenizer.from_file(PATH)
    own.no_truncation()
    own.no_padding()
    return own


def expected(text):
    ids = library().encode(text or "", add_special_tokens=False).ids
    return len(ids), np.array(ids, "<u4").tobytes(), library().decode(ids, skip_special_tokens=False)


def texts(n, seed, parts=PARTS):
    picked = random.Random(seed)
    return ["".join(picked.choices(parts, k=picked.randint(0, 14))) for _ in range(n)]


def test_words_equal_the_library():
    own = word_bpe.splitter(PATH)
    assert own.fast
    plain = [x for x in PARTS if max(map(ord, x)) < 0x100 and "|" not in x]
    for some in (texts(3000, 1), texts(3000, 2, plain), ["", "x"]):
        for first, end, raw, at in K.slices(pa.array(some)):
            raw, starts, ends, counts = own.split(raw, at)
            data, place = raw.tobytes(), 0
            assert len(counts) == end - first and counts.sum() == len(starts)
            for text, n in zip(some[first:end], counts.tolist()):
                words = [data[a:b] for a, b in zip(starts[place : place + n].tolist(), ends[place : place + n].tolist())]
                assert words == own.words(text), text
                assert [i for w in words for i in own.ids(w)] == library().encode(text, add_special_tokens=False).ids, text
                place += n


def table(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts(400, 3))]
    rows += [(900, None, "x", 1), (901, "", "x", 1), (902, " \n", "x", 1), (903, "Don't STOP 42 " * 9000, "x", 1), (903, "again", "x", 1),
             (None, "no key", "x", 1), (None, None, None, None), (904, "same text", "x", 1), (905, "same text", "x", 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, block string, Decoded int").repartition(3)


def test_encode_and_decode(spark, monkeypatch):
    # Small blocks and groups, so that words meet over many of both.
    monkeypatch.setattr(word_bpe, "BLOCK_BYTES", 500)
    monkeypatch.setattr(word_bpe, "GROUP_WORDS", 100)
    monkeypatch.setattr(word_bpe, "SLICE_BYTES", 200)
    monkeypatch.setattr(word_bpe, "DECODE_IDS", 50)
    rows, docs = table(spark)
    with temporary(spark) as keep:
        encoded = word_bpe.encode_words(docs, PATH, keep)
        assert encoded.columns == ["doc_id", "n_tokens", "ids"]
        got = word_bpe.decode_words(encoded.withColumn("DECODED", F.lit(1)), PATH).collect()
    assert list(got[0].asDict()) == ["doc_id", "n_tokens", "ids", "decoded"]
    have = collections.Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in got)
    assert have == collections.Counter((i, *expected(t)) for i, t, *_ in rows)


def test_decode_edge_cases(spark):
    rows = [(1, np.array([3306, 60_000, 49407], "<u4").tobytes(), 5), (2, None, 5), (3, b"", 5)]
    got = word_bpe.decode_words(spark.createDataFrame(rows, "k int, ids binary, text int"), PATH, into="out").collect()
    want = library().decode([3306, 60_000, 49407], skip_special_tokens=False)
    assert sorted((r["k"], r["text"], r["out"]) for r in got) == [(1, 5, want), (2, 5, ""), (3, 5, "")]
    empty = spark.createDataFrame([], "doc_id string, text string")
    with temporary(spark) as keep:
        assert word_bpe.decode_words(word_bpe.encode_words(empty, PATH, keep), PATH).collect() == []


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    want = collections.Counter()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        n, ids, text = expected(r["text"])
        want[r["doc_id"], n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    got = queries.QUERIES["op12_word_bpe"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == want
