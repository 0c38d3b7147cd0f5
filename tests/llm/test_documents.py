"""Document operators against plain versions on a small awkward table."""

import collections
import random
import zlib

import brute as B
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from threadloom.llm import jaccard, language, packing, quality, secrets, sharding, token_files
from threadloom.llm.decontaminate import decontaminate
from threadloom.llm.queries import contaminated
from threadloom.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANDOM = random.Random(5)
VOCABULARY = ["".join(RANDOM.choices("abcdefghijklmnop", k=RANDOM.randint(2, 9))) for _ in range(400)]


def prose(n, seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=n))


def rows():
    """Null, empty, blank, tiny, very long and equal texts, null and repeated keys."""
    base = prose(80, 1)
    edited = base.split()
    edited[40] = "changed"
    texts = {
        0: None, 1: "", 2: " \n\t", 3: "word", 4: "Ünï — 日本語 \U0001f600 it's DON'T", 5: base, 6: base,
        7: " ".join(edited), 8: base.upper(), 9: prose(9000, 2), 10: "one two three four", 11: "One  two\tthree four",
        12: "password = 'abc12' token:abcdef123 AKIA" + "Z9" * 8 + " " + "0a" * 15, 13: "<|endoftext|>" * 3,
        14: prose(40, 3) + " " + base, 15: "secret=token=abcdefgh ñ\U0001f600 api-key: x AKIA1 apikey:\"zzzzzz",
    }
    out = [(i, t, f"src{i % 3}", "x", len(t or "")) for i, t in texts.items()]
    return [*out, (5, base, "src9", "x", 1), (None, base, "src9", "x", 1), (None, None, None, None, None)]


SCHEMA = "doc_id long, text string, source string, secrets string, n_words int"


@pytest.fixture(scope="module")
def docs(spark):
    # Columns whose names the operators use as well.
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def encoded(text, end):
    return B.tokenizer().encode(text or "", add_special_tokens=False).ids + [end]


def test_encoder_equals_the_library(spark):
    import pyarrow as pa

    from threadloom.llm.tokens import encode_column

    parts = ["a", "b", "'s", "'t", "'", "''", "'ll", "'ve", "re", " ", "  ", "\n", "\t", "\u00a0", "\u0085", "1", "é", "ß", "!",
             "<|endoftext|>", "日", "…", "\r\n", "'S", "²", "ª", "ɀ", "\x00", "\x1c", "\U0001f600"]
    picked = random.Random(3)
    texts = ["".join(picked.choices(parts, k=picked.randint(0, 14))) for _ in range(4000)] + [None, ""]
    at = 0
    for first, end, ids, counts in encode_column(pa.array(texts), PATH, 2):
        assert first == at
        at, place = end, 0
        for text, n in zip(texts[first:end], counts.tolist()):
            assert ids[place : place + n].tolist() == encoded(text, 2), text
            place += n
    assert at == len(texts)


def test_packing(docs, empty):
    result = packing.pack(docs, PATH, end_id=2, capacity=64).collect()
    want = collections.Counter((i, zlib.crc32(np.array(encoded(t, 2), "<u4").tobytes())) for i, t, *_ in rows())
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in result:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"] and r["piece"] == 0 or r["length"] == 64
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 64
    for (i, crc), n in want.items():
        if i not in (5, None):
            own = sorted(pieces[i], key=lambda r: r["piece"])
            assert [r["piece"] for r in own] == list(range(len(own)))
            assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist()
            assert zlib.crc32(b"".join(bytes(r["ids"]) for r in own)) == crc
    total = sum(len(encoded(t, 2)) for _, t, *_ in rows())
    assert sum(r["length"] for r in result) == total
    assert len(sequences) <= -(-total // 64) + 3
    assert packing.pack(empty, PATH).collect() == []


def test_bins_are_merged_up_the_tree(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 40)
    sizes = random.Random(4).choices(range(1, 60), k=300)
    bins = spark.createDataFrame(list(enumerate(sizes)), "bin long, fill long")
    moved = packing.merge_bins(bins, 64).collect()
    place = {r["bin"]: (r["sequence_id"], r["base"]) for r in moved}
    assert len(place) == len(moved)
    sequences = collections.defaultdict(list)
    for i, size in enumerate(sizes):
        name, base = place.get(i, (i, 0))
        sequences[name].append((base, size))
    for members in sequences.values():
        at = 0
        for base, size in sorted(members):
            assert base == at
            at += size
        assert at <= 64
    assert len(sequences) < 1.15 * sum(sizes) / 64


def test_token_files(spark, docs, empty):
    path = scratch_path(spark, "test-files")
    token_files.write_tokens(docs, PATH, path, end_id=0)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    names = [r["doc_id"] for r in got]
    assert names == sorted(names, key=lambda x: (x is not None, x or 0))
    at = 0
    for r in got:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    def have(pairs):
        return collections.Counter(pairs)
    assert have((r["doc_id"], bytes(r["ids"])) for r in got) == have(
        (i, np.array(encoded(t, 0), "<u4").tobytes()) for i, t, *_ in rows())
    path = scratch_path(spark, "test-files")
    token_files.write_tokens(empty, PATH, path)
    assert token_files.read_tokens(spark, path).collect() == []


def test_rank_coding_round_trip():
    numbers = np.array([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1, 7, 1], np.uint32)
    for n in range(len(numbers) + 1):
        control, data = token_files.pack_ranks(numbers[:n])
        assert token_files.unpack_ranks(control, data, n).tolist() == numbers[:n].tolist()
        assert len(control) == -(-n // 4)


def test_secret_spans_and_redaction(spark, docs, empty):
    model = secrets.train(secrets.labelled_samples(docs))
    got = secrets.scan(docs, model).withColumn("masked", secrets.redact(F.col("text"), F.col("secrets"))).collect()
    assert len(got) == len(rows())
    for r in got:
        base = [(s["kind"], s["start"], s["end"]) for s in r["secrets"] if s["kind"] != "markov"]
        assert base == B.base_spans(r["text"])
        keep, at = "", 0
        for s in r["secrets"]:
            if s["start"] >= at:
                keep += r["text"][at : s["start"]] + "[SECRET]"
            at = max(at, s["end"])
        assert r["masked"] == (None if r["text"] is None else keep + r["text"][at:])
    assert any(r["secrets"] for r in got)
    assert secrets.scan(empty, secrets.train(secrets.labelled_samples(empty))).collect() == []


def test_markov_models_tell_random_strings_from_words(spark):
    picked = random.Random(8)
    signs = secrets.ALPHABET[:62]
    samples = [("".join(picked.choices(signs, k=24)), True) for _ in range(300)]
    samples += [("_".join(picked.choices(VOCABULARY, k=3)), False) for _ in range(300)]
    model = secrets.train(spark.createDataFrame(samples, "value string, random boolean"))
    fresh = ["".join(picked.choices(signs, k=32)) for _ in range(40)]
    plain = ["_".join(picked.choices(VOCABULARY, k=5)) for _ in range(40)]
    table = spark.createDataFrame([(x, True) for x in fresh] + [(x, False) for x in plain], "text string, random boolean")
    found = secrets.scan(table, model).select("random", F.exists("secrets", lambda s: s["kind"] == "markov").alias("hit"))
    hits = collections.Counter((r["random"], r["hit"]) for r in found.collect())
    assert hits[True, True] >= 39 and hits[False, True] == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 30, 97, 1000])
def test_permutation_is_one_and_goes_back(spark, n):
    there = sharding.permute(spark.range(n), "id", "at", n, seed=3)
    back = sharding.permute(there, "at", "back", n, seed=3, inverse=True).collect()
    assert sorted(r["at"] for r in back) == list(range(n))
    assert all(r["back"] == r["id"] for r in back)
    if n == 1000:
        assert sum(abs(r["at"] - r["id"]) < 20 for r in back) < 120


def test_sharding(spark, docs, empty):
    got = sharding.assign_shards(docs.withColumn("slot", F.lit("x")), ["doc_id", "text"], shards=4).collect()
    assert len(got) == len(rows())
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.assign_shards(docs.repartition(5), ["doc_id", "text"], shards=4).collect()
    def place(table):
        return {r["doc_id"]: (r["shard"], r["slot"]) for r in table if r["doc_id"] not in (5, None)}
    assert place(got) == place(again)
    found = sharding.locate(spark.createDataFrame([(r["shard"], r["slot"], r["row_number"]) for r in got], "shard int, slot long, want long"), len(got), 4)
    assert all(r["row_number"] == r["want"] for r in found.collect())
    assert sharding.assign_shards(empty, ["doc_id"]).collect() == []


ITEMS = [
    (1, prose(30, 1)), (2, prose(30, 1)), (2, "alpha beta gamma"), (3, None), (4, ""), (5, "?!"), (None, prose(20, 7)),
    (6, prose(13, 9)), (7, prose(12, 10)), (8, "word"), (10, prose(50, 11)),
]


def passages():
    shared = prose(50, 11).split()
    return rows() + [
        (20, prose(10, 21) + " " + " ".join(shared[5:18]) + " " + prose(10, 22), "s", "x", 1),
        (21, prose(10, 23) + " " + " ".join(shared[5:17]) + " " + prose(10, 24), "s", "x", 1),
        (22, "x " + prose(12, 10).upper() + ", Alpha-beta...GAMMA word", "s", "x", 1),
        (23, " ".join(shared[:20] * 3), "s", "x", 1), (24, prose(500, 25) + " word", "s", "x", 1),
        (25, prose(20, 7), "s", "x", 1),
    ]


@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_decontamination(spark, empty, limit):
    table = spark.createDataFrame(passages(), SCHEMA).withColumn("hit", F.lit(1))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate(table, items, broadcast_bytes=limit).withColumn("bad", contaminated(F.col("hit"))).collect()
    assert len(got) == len(passages())
    want = dict(zip([p[1] for p in passages()], B.decontaminate([p[1] for p in passages()], ITEMS)))
    for r in got:
        n, hit, found = want[r["text"]]
        assert (r["hit"]["n_words"], r["hit"]["n_hit"], r["hit"]["items"]) == (n, hit, sorted(map(str, found))), r["doc_id"]
        assert sum(s["end"] - s["start"] for s in r["hit"]["spans"]) == hit
        assert r["bad"] == (hit > 0 and 20 * hit >= n)
    assert decontaminate(empty, items, broadcast_bytes=limit).collect() == []
    nothing = decontaminate(table, items.limit(0), broadcast_bytes=limit).collect()
    assert all(r["hit"]["n_hit"] == 0 and r["hit"]["items"] == [] for r in nothing)


def near_copies():
    """Chains and families of edits around the threshold, and a common passage."""
    picked = random.Random(6)
    out, common = rows(), prose(30, 77)
    for family in range(6):
        words = prose(120, 100 + family).split()
        for member in range(14):
            own = list(words)
            for _ in range(picked.randint(0, 4)):
                own[picked.randrange(len(own))] = f"e{family}x{member}"
            out.append((100 + 20 * family + member, " ".join(own), "s", "x", 1))
            words = own if family % 2 else words  # odd families drift
    out += [(400 + k, common + " " + prose(picked.choice([8, 12, 40]), 500 + k), "s", "x", 1) for k in range(12)]
    return out


@pytest.mark.parametrize("block", [256, 4])
def test_jaccard_groups(spark, empty, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    table = near_copies()
    got = jaccard.similar_groups(spark.createDataFrame(table, SCHEMA).repartition(3)).collect()
    named = [(i, t) for i, t, *_ in table if i is not None]
    want = B.components([i for i, _ in named], B.jaccard_links(named))
    assert len(got) == len(table)
    sizes = {i: len(B.shingles(t)) for i, t in named}
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == (sizes[r["doc_id"]], want[r["doc_id"]])
    if block == 256:
        assert jaccard.similar_groups(empty).collect() == []


def test_t_occurrence_equals_counting():
    picked = random.Random(9)
    sets = [np.unique(np.array(picked.choices(range(60), k=picked.randint(1, 40)), np.uint64)) for _ in range(80)]
    for query, found in zip(sets, jaccard.t_occurrence(sets, sets, 50)):
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(query, s)) >= 50 * len(np.union1d(query, s))]
        assert found.tolist() == want


def test_quality(spark, empty):
    good = [(i, prose(60, i), 1) for i in range(120)]
    bad = [(i, " ".join(w.upper() + "!!" for w in prose(60, i).split()), 0) for i in range(200, 320)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    train, test = table.filter("doc_id % 4 <> 0"), table.filter("doc_id % 4 = 0")
    model = quality.fit(train.select("doc_id", "text"), train.select("doc_id", "quality"))
    got = quality.score_quality(test, model).collect()
    assert all((r["score"] >= 0.5) == (r["quality"] == 1) for r in got)
    odd = quality.score_quality(spark.createDataFrame(rows(), SCHEMA).withColumn("score", F.lit("x")), model).collect()
    assert len(odd) == len(rows()) and all(0 <= r["score"] <= 1 for r in odd)
    assert quality.score_quality(empty, model).collect() == []
    nothing = quality.fit(empty, train.select("doc_id", "quality").limit(0))
    assert {r["score"] for r in quality.score_quality(test, nothing).collect()} == {0.5}


def test_language(spark, empty):
    words = {"aa": VOCABULARY[:150], "bb": [w[::-1] + "ü" for w in VOCABULARY[150:300]]}
    picked = random.Random(2)
    def make(lang, ids):
        return [(i, " ".join(picked.choices(words[lang], k=30)), lang) for i in ids]
    table = spark.createDataFrame(make("aa", range(60)) + make("bb", range(100, 160)) + [(200, "zzz", None)], "doc_id long, text string, lang string")
    model = language.fit(table.filter("doc_id % 3 <> 0"))
    got = language.identify(table.filter("doc_id % 3 = 0 and lang is not null"), model).collect()
    assert all(r["language"]["lang"] == r["lang"] for r in got)
    # Words that were never seen are told by their n-grams.
    unseen = spark.createDataFrame([(" ".join(w + "qx" for w in words["bb"][:20]),)], "text string")
    assert language.identify(unseen, model).first()["language"]["lang"] == "bb"
    odd = {r["doc_id"]: r["language"] for r in language.identify(spark.createDataFrame(rows(), SCHEMA), model).collect()}
    assert all(odd[i]["lang"] == "und" and odd[i]["score"] == 0 for i in (0, 1, 2)) and odd[3]["lang"] != "und"
    assert language.identify(empty, model).collect() == []
    assert language.identify(table, language.fit(table.limit(0))).first()["language"]["lang"] == "und"


def test_sketches_never_miss_a_link():
    import pyarrow as pa

    from threadloom.llm import kernels as K

    picked = np.random.default_rng(8)
    sets = []
    for n in (1, 2, 5, 9, 40, 95, 100, 110, 120, 400, 3000):
        base = picked.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)
        sets.append(base)
        for share in (0.02, 0.1, 0.2, 0.5):
            edit = base.copy()
            edit[: int(n * share)] = picked.integers(0, 2**63, int(n * share), dtype=np.int64).astype(np.uint64)
            sets += [edit, np.concatenate([edit, picked.integers(0, 2**63, int(n * share / 2), dtype=np.int64).astype(np.uint64)])]
    sets += [picked.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64) for n in (700, 710, 720)]  # alone
    # Hashes that all fall in one bucket.
    sets += [np.arange(1000, dtype=np.uint64), np.arange(100, 1080, dtype=np.uint64)]
    sets = [np.unique(K.mix(x) if x.max() > 10**6 else x) for x in sets]
    counts = np.array([len(x) for x in sets])
    sketches, sizes, beyond = jaccard._sketches(np.concatenate(sets), counts)
    links, lone = [], set(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            shared = len(np.intersect1d(sets[a], sets[b]))
            if 100 * shared >= 80 * (counts[a] + counts[b] - shared):
                links.append((b, a))
    table = pa.table({
        "cls": range(len(sets)), "n": counts, "beyond": beyond, "query": [True] * len(sets), "component": [str(i) for i in range(len(sets))],
        "sketch": K.binary_column(sketches, sizes)})
    near = [(a, b) for a, _, b, _ in jaccard._candidates(table, 80)]
    family = B.components(range(len(sets)), near)
    assert links and all(family[a] == family[b] for a, b in links)
    lone -= {x for pair in near for x in pair}
    assert len(lone) >= 3 and len(near) < len(sets)
    assert not jaccard._candidates(table.set_column(4, "component", [["one"] * len(sets)]), 80)
    # A link between two components is found beside a near pair of the same two.
    some = pa.table({
        "cls": range(4), "n": counts[:4], "beyond": beyond[:4], "query": [True] * 4, "component": ["x", "x", "y", "y"],
        "sketch": K.binary_column(np.tile(sketches[: sizes[0]], 4), np.repeat(sizes[0], 4))})
    assert {x for a, _, b, _ in jaccard._candidates(some, 80) for x in (a, b)} == {0, 1, 2, 3}


def test_a_secret_joined_to_a_base_span_is_found(spark):
    rng = random.Random(5)
    signs = secrets.ALPHABET[:62]
    samples = [("".join(rng.choices(signs, k=30)), True) for _ in range(400)]
    samples += [("_".join(rng.choices(["read", "file", "index", "table", "value", "count"], k=5)), False) for _ in range(400)]
    model = secrets.train(spark.createDataFrame(samples, "value string, random boolean"))
    access, key = "AKIA" + "Q7" * 8, "".join(rng.choices(signs, k=40))
    texts = [f"\U0001f600 {access}{sign}{key}." for sign in "/=_+"] + [f"{key}/{access}", access, "", None]
    found = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), model)
    for r in found.withColumn("masked", secrets.redact(F.col("text"), F.col("secrets"))).collect():
        text = r["text"] or ""
        spans = {(s["kind"], text[s["start"]:s["end"]].strip("/")) for s in r["secrets"]}
        want = {("access", access)} if access in text else set()
        assert spans == (want | {("markov", key)} if key in text else want)
        assert key not in (r["masked"] or "") and access not in (r["masked"] or "")


@pytest.mark.parametrize("share", [0, 1e-5, 0.04, 0.6, 1])
def test_counters_come_back_from_their_gaps(share):
    """op7: a task's counters of 64 MB lie in a third to a half of the bytes that they took before."""
    rng = np.random.default_rng(4)
    counters = np.where(rng.random(jaccard.CHUNK) < share, np.minimum(rng.geometric(0.9, jaccard.CHUNK), 255), 0).astype(np.uint8)
    counters[[254, 255, 256, 767, -1]] = [1, 0, 255, 2, 1]
    packed = jaccard._pack_counters(counters)
    assert (jaccard._unpack_counters(packed, jaccard.CHUNK) == counters).all()
    if share == 0.04:
        assert len(packed) < 0.6 * len(jaccard.zstandard.compress(counters.tobytes(), 3))


def test_only_postings_of_one_row_are_left_out(spark):
    """op7: shingles that one class alone has posted went through two shuffles before."""
    rows = [(s, c, 9) for s in range(-400, 400) for c in range(1 + (s % 5 == 0) + 3 * (s % 50 == 0))]
    table = spark.createDataFrame(rows, "shingle long, cls long, n long").repartition(3)
    kept = [tuple(r) for r in jaccard._posted_again(table).collect()]
    assert sorted(kept) == [r for r in rows if r[0] % 5 == 0]
