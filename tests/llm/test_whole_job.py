"""Cases that were once left out: each test failed before the operator did the whole job."""

import collections
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from threadloom.llm import language, packing, quality, token_files
from threadloom.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_added_tokens_have_the_ids_of_the_library(spark):
    library = Tokenizer.from_file(PATH)  # as it comes, no setting changed
    texts = ["a <|endoftext|> b", "<|endoftext|>" * 3, "<|endoftext|", "|>", "it's<|endoftext|>\n \u65e5", "", None, "plain", "<|endoftext|><|endof"]
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert want[0] == [64, 220, 50256, 275]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    packed = packing.pack(docs, PATH, end_id=2, capacity=64).collect()
    assert {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in packed} == {i: x + [2] for i, x in want.items()}
    path = scratch_path(spark, "added-tokens")
    token_files.write_tokens(docs, PATH, path, end_id=0)
    read = token_files.read_tokens(spark, path).collect()
    assert {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in read} == {i: x + [0] for i, x in want.items()}


def test_languages_without_spaces_are_learned(spark):
    picked = random.Random(5)
    def make(first, n):
        return "".join(chr(first + picked.randrange(300)) for _ in range(n))
    rows = [(i, make(0x4E00, 130 + i), "zh") for i in range(20)] + [(100 + i, make(0xAC00, 30), "ko") for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(table.filter("doc_id % 4 <> 0"))
    assert model.languages == ["ko", "zh"]
    got = language.identify(table.filter("doc_id % 4 = 0"), model).collect()
    assert all(r["language"]["lang"] == r["lang"] for r in got)


def test_ngrams_of_long_words_count_once_each(spark, monkeypatch):
    monkeypatch.setattr(language, "LEAST_COUNT", 1)
    seen = {}
    monkeypatch.setattr(language, "_table", lambda rows, languages: seen.update({len(seen): rows}) or (None, None))
    picked = random.Random(6)
    for n in (1, 4, 99, 100, 101, 104, 105, 200, 204, 333):
        seen.clear()
        word = "".join(picked.choices("abcd", k=n))
        language.fit(spark.createDataFrame([(1, word, "aa")], "doc_id long, text string, lang string"))
        want = collections.Counter(word[i : i + k] for k in range(1, 6) for i in range(n - k + 1))
        assert {r["name"]: r["n"] for r in seen[1]} == want


def test_one_long_text_does_not_empty_the_quality_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "FIT_BYTES", 24_000)
    monkeypatch.setattr(quality, "ROW_CHARS", 500, raising=False)
    picked = random.Random(7)
    def prose(n, tail):
        return " ".join("".join(random.Random(picked.randrange(200)).choices("abcdefgh", k=6)) + tail for _ in range(n))
    # Every text of label 0 alone passes the bound.
    rows = [(i, prose(40, ""), 1) for i in range(40)] + [(100 + i, prose(4000, "!!"), 0) for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(table.filter("doc_id % 4 <> 0").select("doc_id", "text"), table.select("doc_id", "quality"))
    got = quality.score_quality(table.filter("doc_id % 4 = 0"), model).collect()
    assert all((r["score"] >= 0.5) == (r["quality"] == 1) for r in got)


def test_samples_take_one_row_of_a_key(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(language, "_table", lambda rows, languages: seen.update({len(seen): rows}) or (None, None))
    repeated = [(1, "b b b", "aa")] * 50 + [(1, "a a a", "aa"), (2, "c c c", "aa")]
    language.fit(spark.createDataFrame(repeated, "doc_id long, text string, lang string"))
    assert {r["name"]: r["n"] for r in seen[0]} == {"a": 3, "c": 3}
    monkeypatch.setattr(quality, "_fit", lambda bad, good: (bad, good))
    docs = spark.createDataFrame([(1, "b")] * 50 + [(1, "a"), (2, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    assert quality.fit(docs, labels) == ([b"a"], [b"c"])


def test_language_samples_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(language, "FIT_BYTES", 100, raising=False)
    monkeypatch.setattr(language, "ROW_CHARS", 40, raising=False)
    seen = {}
    monkeypatch.setattr(language, "_table", lambda rows, languages: seen.update({len(seen): rows}) or (None, None))
    language.fit(spark.createDataFrame([(i, "a " * 5000, "aa") for i in range(9)], "doc_id long, text string, lang string"))
    assert {r["name"]: r["n"] for r in seen[0]} == {"a": 40}


def test_documents_stay_where_no_language_is_learned(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 !", None), (3, None, None), (None, "\u65e5", None)], "doc_id long, text string, lang string")
    assert {r["text"] for r in P.keep_known_languages(spark, docs, "").collect()} == {"some words", "\u65e5"}


def test_rounds_go_on_while_they_join_bins(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 40)
    # Bins of 39 join nothing, those of 30 only each other; a round joins less than 5 % of all.
    sizes = [39] * 1000 + [30] * 100
    moved = packing.merge_bins(spark.createDataFrame(list(enumerate(sizes)), "bin long, fill long"), 64).collect()
    assert len(moved) >= 90
