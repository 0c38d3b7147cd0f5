"""Benchmark decontamination by winnowing.

The minimum k-gram hash of every sliding window of w k-grams is kept, for documents and items alike.
Two texts that share t = w + k - 1 consecutive words share a whole window and so its minimum, hence
every span of t words has a common fingerprint. Each common fingerprint fixes a diagonal of document
and item; the words along it are compared, so hits are extended to their full length and checked.
Items of fewer than t words are one window of their own length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from threadloom.llm import kernels as K
from threadloom.llm.common import fresh, prepare, stored, temporary

GRAM = 5
# Benchmarks up to this many bytes are sent to the tasks whole; larger ones are joined by fingerprint.
BROADCAST_BYTES = 8_000_000

# Words are digits, a-z after lower-casing A-Z, and everything beyond ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.IntegerType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])


def words_of(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words, and the words of each row. ``raw`` is lower-cased."""
    starts, ends = K.runs(raw, at, WORD)
    return starts, ends, K.span_hashes(raw, starts, ends), K.row_counts(K.rows_of(starts, at), len(at) - 1)


def winnow(hashes: np.ndarray, first: np.ndarray, rows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept fingerprints: hash and place of the leftmost minimum of every window inside a row."""
    n = len(hashes) - window + 1
    if n <= 0:
        return hashes[:0], first[:0]
    begin = np.flatnonzero(rows[:n] == rows[window - 1 :])
    best, place = hashes[begin], begin.copy()
    for i in range(1, window):
        other = hashes[begin + i]
        less = other < best
        best = np.where(less, other, best)
        place[less] = begin[less] + i
    place = np.unique(place)
    return hashes[place], first[place]


@dataclass
class Benchmark:
    """Items ready to be looked for: words, and fingerprints sorted by hash."""

    hashes: np.ndarray
    spelled: list[bytes]
    begin: np.ndarray
    item_of: np.ndarray
    marks: np.ndarray
    places: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]
    span: int

    @classmethod
    def build(cls, texts: list[str | None], span: int) -> Benchmark:
        raw, at = K.text_buffer(pa.array(texts, pa.string()))
        raw = K.LOWER[raw]
        starts, ends, hashes, counts = words_of(raw, at)
        data = raw.tobytes()
        spelled = [data[a:z] for a, z in zip(starts.tolist(), ends.tolist())]
        begin = np.concatenate([[0], np.cumsum(counts)])
        item_of = np.repeat(np.arange(len(texts)), counts)
        values, first = K.grams(hashes, counts, GRAM)
        long_item = counts[item_of[first]] >= span
        marks, places = winnow(values[long_item], first[long_item], item_of[first[long_item]], span - GRAM + 1)
        order = np.argsort(marks, kind="stable")
        short = {}
        for size in np.unique(counts[(counts > 0) & (counts < span)]).tolist():
            values, first = K.grams(hashes, counts, size)
            own = counts[item_of[first]] == size
            ranked = np.argsort(values[own], kind="stable")
            short[size] = values[own][ranked], item_of[first[own]][ranked]
        return cls(hashes, spelled, begin, item_of, marks[order], places[order], short, span)

    def fingerprints(self, counts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(counts)), counts)
        values, first = K.grams(hashes, counts, GRAM)
        return winnow(values, first, rows[first], self.span - GRAM + 1)

    def look(self, raw: np.ndarray, at: np.ndarray) -> list[tuple[int, int, list[int], list[tuple[int, int]]]]:
        """Per text: words, hit words, items found, merged hit spans (word numbers)."""
        raw = K.LOWER[raw]
        starts, ends, hashes, counts = words_of(raw, at)
        offset = np.concatenate([[0], np.cumsum(counts)])
        row_of = np.repeat(np.arange(len(counts)), counts)
        hits: dict[int, list[tuple[int, int]]] = {}
        found: dict[int, set[int]] = {}

        def note(item: int, first: int, size: int, at_item: int) -> None:
            # The hashes agree; the words themselves must as well.
            data = [raw[a:z].tobytes() for a, z in zip(starts[first : first + size], ends[first : first + size])]
            if data == self.spelled[at_item : at_item + size]:
                row = int(row_of[first])
                hits.setdefault(row, []).append((first - int(offset[row]), first - int(offset[row]) + size))
                found.setdefault(row, set()).add(item)

        if len(self.marks):
            values, places = self.fingerprints(counts, hashes)
            low, high = np.searchsorted(self.marks, values), np.searchsorted(self.marks, values, side="right")
            some = high > low
            at_doc = np.repeat(places[some], (high - low)[some])
            at_item = self.places[K.spread(low[some], (high - low)[some])]
            diagonals = np.unique(np.stack([row_of[at_doc], self.item_of[at_item], at_doc - at_item]), axis=1) if len(at_doc) else np.empty((3, 0), int)
            for row, item, shift in diagonals.T.tolist():
                first = max(int(offset[row]), int(self.begin[item]) + shift)
                end = min(int(offset[row + 1]), int(self.begin[item + 1]) + shift)
                same = np.zeros(end - first + 2, bool)
                same[1:-1] = hashes[first:end] == self.hashes[first - shift : end - shift]
                edges = np.flatnonzero(same[1:] != same[:-1])
                for a, z in edges.reshape(-1, 2).tolist():
                    if z - a >= self.span:
                        note(item, first + a, z - a, first + a - shift)
        for size, (marks, items) in self.short.items():
            values, first = K.grams(hashes, counts, size)
            low, high = np.searchsorted(marks, values), np.searchsorted(marks, values, side="right")
            for i in np.flatnonzero(high > low).tolist():
                for item in items[low[i] : high[i]].tolist():
                    note(item, int(first[i]), size, int(self.begin[item]))
        out = []
        for row, n in enumerate(counts.tolist()):
            merged: list[list[int]] = []
            for a, z in sorted(hits.get(row, ())):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], z)
                else:
                    merged.append([a, z])
            out.append((n, sum(z - a for a, z in merged), sorted(found.get(row, ())), [tuple(x) for x in merged]))
        return out


def _looker(benchmark_of):
    """An Arrow function from texts to RESULT; the benchmark is built once per Python worker."""
    kept: list[Benchmark] = []

    def run(texts: pa.Array) -> pa.Array:
        if not kept:
            kept.append(benchmark_of())
        rows = []
        for _, _, raw, at in K.slices(texts):
            rows += [
                {"n_words": n, "n_hit": hit, "items": items, "spans": [{"start": a, "end": z} for a, z in spans]}
                for n, hit, items, spans in kept[0].look(raw, at)
            ]
        from pyspark.sql.pandas.types import to_arrow_type

        return pa.array(rows, to_arrow_type(RESULT))

    return F.arrow_udf(run, RESULT)


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    span: int = 13, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``hit`` to every document: n_words, n_hit, items (ids as sorted texts) and word spans.

    A document word is hit inside any occurrence of ``span`` consecutive item words, or of a whole
    item that is shorter. Null and empty texts have no words and no hits; items without words are in
    nothing; an item without an id marks words but is not named. Equal items and rows all count. A
    column of ``docs`` already called ``hit`` is replaced.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.drop("hit")
    items = items.select(F.col(item_key).cast("string").alias("item"), F.col(item_text).alias("text")).filter("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    if size > broadcast_bytes:
        return _by_fingerprint(docs, items, text, span)
    listed = items.orderBy("item", "text").collect()  # no more than broadcast_bytes
    shared = spark.sparkContext.broadcast([r["text"] for r in listed])
    ids = spark.sparkContext.broadcast([r["item"] for r in listed])
    look = _looker(lambda: Benchmark.build(shared.value, span))
    named = F.arrow_udf(lambda hits: pa.array(
        [sorted({ids.value[i] for i in x} - {None}) for x in hits.to_pylist()], pa.list_(pa.string())), "array<string>")
    [raw] = fresh([*docs.columns, "hit"], "_hit")
    found = docs.withColumn(raw, look(F.col(text)))
    return found.withColumn("hit", F.struct(
        F.col(raw)["n_words"].alias("n_words"), F.col(raw)["n_hit"].alias("n_hit"),
        named(F.col(raw)["items"]).alias("items"), F.col(raw)["spans"].alias("spans"))).drop(raw)


def _marks(span: int, sizes: list[int]):
    """Fingerprints of texts: (key, size of the window, hash)."""
    empty = Benchmark.build([], span)

    def run(batches):
        for batch in batches:
            for first, end, raw, at in K.slices(batch.column(1)):
                _, _, hashes, counts = words_of(K.LOWER[raw], at)
                row_of = np.repeat(np.arange(len(counts)), counts)
                keys = batch.column(0).slice(first, end - first)
                for size in [span, *sizes]:
                    values, places = empty.fingerprints(counts, hashes) if size == span else K.grams(hashes, counts, size)
                    pairs = np.unique(np.stack([row_of[places], values.view(np.int64)]), axis=1) if len(places) else np.empty((2, 0), np.int64)
                    yield pa.record_batch({
                        "key": keys.take(pa.array(pairs[0])), "size": pa.array(np.full(pairs.shape[1], size, np.int64)),
                        "mark": pa.array(pairs[1]),
                    })

    return run


def _by_fingerprint(docs: DataFrame, items: DataFrame, text: str, span: int) -> DataFrame:
    """The way for large benchmarks: fingerprints of both sides meet in a shuffle join, and only
    documents and items with a common one are compared. Texts are known by their digest."""
    spark = docs.sparkSession
    schema = "key string, size long, mark long"
    with temporary(spark) as keep:
        items = keep(items.withColumn("item_key", F.sha2(F.concat_ws("\n", F.coalesce("item", F.lit("")), "text"), 256)), "items")
        counted = items.withColumn("n", _count_words(F.col("text")))
        sizes = [r["n"] for r in counted.filter((F.col("n") > 0) & (F.col("n") < span)).select("n").distinct().collect()]  # below span
        texts = docs.select(F.sha2(text, 256).alias("key"), F.col(text).alias("text")).filter("text is not null")
        long_items = counted.filter(F.col("n") >= span).select("item_key", "text").mapInArrow(_marks(span, []), schema)
        marked = long_items
        for size in sizes:
            own = counted.filter(F.col("n") == size).select("item_key", "text").mapInArrow(_marks(span, [size]), schema)
            marked = marked.unionByName(own.filter(F.col("size") == size))
        marked = marked.withColumnRenamed("key", "item_key")
        common = keep(
            texts.mapInArrow(_marks(span, sizes), schema).join(marked, ["size", "mark"]).select("key", "item_key").distinct(), "common")
        wanted = common.select("key").distinct()
        unique = texts.join(wanted, "key", "left_semi").dropDuplicates(["key"])
        pairs = common.join(unique, "key").join(items.select("item_key", "item", F.col("text").alias("item_text")), "item_key")

        def compare(own: pa.Array, other: pa.Array) -> pa.Array:
            from pyspark.sql.pandas.types import to_arrow_type

            rows = []
            for a, b in zip(own.to_pylist(), other.to_pylist()):
                raw, at = K.text_buffer(pa.array([a], pa.string()))
                n, hit, found, spans = Benchmark.build([b], span).look(raw, at)[0]
                rows.append({"n_words": n, "n_hit": hit, "items": found, "spans": [{"start": x, "end": z} for x, z in spans]})
            return pa.array(rows, to_arrow_type(RESULT))

        judged = pairs.select("key", "item", F.arrow_udf(compare, RESULT)(F.col("text"), F.col("item_text")).alias("r")).filter("r.n_hit > 0")
        hits = stored(judged.groupBy("key").agg(
            F.array_sort(F.collect_set("item")).alias("items"), F.array_sort(F.flatten(F.collect_list("r.spans"))).alias("spans"),
        ), "hits")

    def merge(state: Column, s: Column) -> Column:
        last = F.element_at(state, -1)
        joins = (F.size(state) > 0) & (s["start"] <= last["end"])
        grown = F.concat(F.slice(state, F.lit(1), F.size(state) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when(joins, grown).otherwise(F.concat(state, F.array(s)))

    kind = "array<struct<start:bigint,end:bigint>>"
    merged = hits.withColumn("spans", F.aggregate("spans", F.array().cast(kind), merge))
    # The row's own columns go in one, so that none of them can clash with a name of the join.
    own = docs.select(F.struct(*docs.columns).alias("row"), F.sha2(text, 256).alias("key"))
    joined = own.join(merged, "key", "left")
    spans = F.coalesce("spans", F.array().cast(kind))
    return joined.withColumn("hit", F.struct(
        _count_words(F.col("row")[text]).alias("n_words"),
        F.aggregate(spans, F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"]).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), spans.alias("spans"),
    )).select("row.*", "hit")


def _count_words(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))), F.lit(0)).cast("bigint")
