"""The pipeline stage by stage and as a whole, against a plain version."""

import collections
import os
import random

import brute as B
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline as P
from threadloom.llm.queries import ORACLES, QUERIES

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, hit string, secrets string"


def words(seed, n, tail=""):
    own = random.Random(seed)
    pool = ["".join(random.Random(k).choices("abcdefghij", k=5)) + tail for k in range(200)]
    return " ".join(own.choices(pool, k=n))


def rows():
    item = words(900, 40)
    texts = [words(i, 60) for i in range(30)] + [words(100 + i, 60, "ü") for i in range(30)]
    langs = ["aa"] * 30 + ["bb"] * 30
    out = [(i, t, l) for i, (t, l) in enumerate(zip(texts, langs))]
    edited = texts[3].split()
    edited[30] = "changed"
    out += [
        (200, None, None), (201, "", "aa"), (202, "1234 !!", "aa"), (203, texts[3], "aa"), (204, " ".join(edited), None),
        (205, words(5000, 40) + " " + item, "aa"), (206, words(5001, 800) + " " + " ".join(item.split()[:13]), "aa"),
        (207, words(5002, 50) + ' password=abcdef12 "x" ' + "0af1" * 8, "aa"), (208, words(5003, 3000), "aa"),
    ]
    return [(i, t, l, "s", len(t or ""), "h", "c") for i, t, l in out], [(1, item), (2, None)]


def plain(table, items):
    """Rows kept by the first four stages: {doc_id: text}."""
    kept = {i: t for i, t, *_ in table if t and any(c.isalpha() for c in t)}
    links = B.jaccard_links(list(kept.items()))
    group = B.components(list(kept), links)
    kept = {i: t for i, t in kept.items() if group[i] == i}
    for (i, t), (n, hit, _) in zip(list(kept.items()), B.decontaminate(list(kept.values()), items)):
        if hit and 20 * hit >= n:
            del kept[i]
    out = {}
    for i, t in kept.items():
        masked, at = "", 0
        for _, a, z in B.base_spans(t):
            if a >= at:
                masked += t[at:a] + "[SECRET]"
            at = max(at, z)
        out[i] = masked + t[at:]
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    table, items = rows()
    spark.createDataFrame(table, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_run_equals_the_plain_version(spark, tables):
    want = plain(*rows())
    pieces = collections.defaultdict(list)
    for r in P.run(spark, tables).collect():
        pieces[r["doc_id"]].append((r["piece"], bytes(r["ids"])))
    got = {i: b"".join(x for _, x in sorted(p)) for i, p in pieces.items()}
    library = B.tokenizer()
    assert got == {i: np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes() for i, t in want.items()}
    assert 206 in got and 205 not in got and 203 not in got and 202 not in got


def test_stages_keep_the_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, docs, tables)
        assert after.columns == docs.columns and after.count() > 0, name


def test_masking_counts_characters_anew(spark, tables):
    got = P.mask_secrets(spark, spark.read.parquet(f"{tables}/documents.parquet"), tables).filter("text is not null").collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_repeated_and_null_keys(spark, tables):
    text = words(1, 60)
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (None, words(2, 60)), (2, None), (2, None), (1, words(3, 60))], "doc_id long, text string")
    left = P.keep_one_of_similar(spark, docs.coalesce(1), tables).collect()
    assert collections.Counter(r["text"] for r in left) == {text: 1, words(2, 60): 1, None: 2, words(3, 60): 1}


def test_empty_documents(spark, tables, tmp_path):
    folder = str(tmp_path)
    spark.read.parquet(f"{tables}/documents.parquet").limit(0).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{tables}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    assert P.run(spark, folder).collect() == []


def test_registered():
    assert set(QUERIES) <= set(driver.queries()) and "pipeline" in driver.queries()
    assert len(QUERIES) == 13 and set(ORACLES) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_models_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = QUERIES["op9_language_id"](spark, folder).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert known.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = QUERIES["op8_quality_classifier"](spark, folder).filter("held_out").join(labels, "doc_id")
    assert judged.select(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.9
