"""Similarity join of documents on word shingles by T-occurrence search.

Documents whose Jaccard similarity reaches the threshold share at least T of their n shingles, so of
the n - T + 1 rarest one at least, and of the n - T + k rarest k. Equal sets are one class from the
start. Three steps follow:

1. Every class lists its rarest shingles, as far as other documents have listed them too; classes of
   which fewer than k of the n - T + k are left go. Of each inverted list only the smallest and the largest
   member are taken as pivots, and every class is compared with its pivots and with the others of
   its pivot: rows grow with the lists, not with their squares, and copies come together here.
2. Lists whose members are not all connected by then are compared in full, in blocks: all members
   outside the pivot's component against all members. This makes the result exact. Classes for which
   a link is possible form families, in whatever lists they met, and each family is compared once.
3. Links become components.

Both comparisons look at sketches first, small counts of the shingles by hash: the sum of the smaller
counts is never below the overlap. Only classes that have a partner for which it reaches the threshold
bring their sets; before sets are shuffled, a filter of fixed size drops the others where they lie.

Within a block the T-occurrence search is DivideSkip: the longest inverted lists are set aside, the
short ones are merged by counting, and what reaches T minus the number of long lists is looked up in
the long ones by binary search. A block sends on a spanning forest of its links.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from threadloom.llm import kernels as K
from threadloom.llm.common import BATCH_ROWS, materialize, prepare, temporary
from threadloom.llm.components import components

# Counters for the order of shingles by frequency. Any counters give right results; these tell shingles that very
# many documents hold, which come last, from all the others. A shingle whose counter says 1 is in no other document
# and needs no list.
COUNTER_BITS = 20
CHUNK = 1 << 18
FULL = 255
# Sums of counters are exact up to here; beyond, FULL stands for 2^20 times as much.
EXACT = 16
# Of the T shingles that a set shares at least, one in SPARE has to be among those that it lists.
SPARE = 8
# Postings that are compared at once, in memory; more make more parts, up to 2^15.
PART = 1 << 19
# Postings and documents of a task that are dealt to the parts at once.
DEALT, DEALT_DOCS = 1 << 21, 1 << 15
# Texts of so many bytes are worked on at once: what a task holds beside its counters is some 40 times as much.
SLICE_BYTES = 500_000
# Bits of the table that says which posted shingles are posted again; about 16 for each posting within these bounds.
LEAST_AGAIN_BITS, MOST_AGAIN_BITS = 18, 26
# Pivots that a class is compared with in the first step; the second step is for all the others.
PIVOTS = 2
# Classes in one side of a block.
BLOCK = 256
# Rows of a small block: many of these are looked at together, all pairs of each; and bytes of sketches compared at once.
SMALL, COMPARED = 128, 1 << 23
# Bits of the filter for classes whose sets are needed; false hits only cost their rows.
FILTER_BITS = 23
# The weight of a binary search against a merge step, in the choice of long lists.
SKIP_WEIGHT = 0.01
# Members looked up in long lists at once.
SEARCHED = 1 << 18

WORD = np.ones(256, bool)
WORD[[32, 9, 10, 11, 12, 13]] = False


def shingle_sets(raw: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted by row and hash, and the number per row.

    Shingles are ``size`` words; a row of fewer words, but not none, has its whole sequence as one.
    """
    raw = K.LOWER[raw]
    starts, ends = K.runs(raw, at, WORD)
    words = K.span_hashes(raw, starts, ends)
    begin = np.searchsorted(starts, at)
    counts = np.diff(begin)
    per = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    stop = np.cumsum(per)
    values, _ = K.grams(words, counts, size)
    if len(values) < (stop[-1] if len(stop) else 0):
        long_ = values
        values = np.empty(stop[-1], np.uint64)
        values[np.repeat(counts >= size, per)] = long_
        for fewer in range(1, size):
            rows = np.flatnonzero(counts == fewer)
            values[stop[rows] - 1] = K.grams(words[K.spread(begin[rows], counts[rows])], counts[rows], fewer)[0]
    _sort_rows(values, per)
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    fresh[(stop - per)[per > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return values[fresh], kept[stop] - kept[stop - per]


def _sort_rows(values: np.ndarray, counts: np.ndarray) -> None:
    """Sort each row of values, which lie end to end, in place."""
    ends = np.cumsum(counts)
    some = counts > 1
    for a, z in zip((ends - counts)[some].tolist(), ends[some].tolist()):
        values[a:z].sort()


def _classes(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each row's set; together with the size it names the class of equal sets."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(K.mix(values ^ np.uint64(0x5D588B656C078965)))])
    ends = np.cumsum(counts)
    return K.mix(total[ends] - total[ends - counts]).view(np.int64)


def _pack_counters(counters: np.ndarray) -> bytes:
    """Counters that are mostly 0: the number of the others, the gaps before them (a byte for each and one more
    for every 255 that a gap is longer), and what they count."""
    place = np.flatnonzero(counters)
    gaps = np.diff(place, prepend=-1) - 1
    ends = np.cumsum(gaps // 255 + 1)
    coded = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
    coded[ends - 1] = gaps % 255
    return zstandard.compress(np.int64(len(place)).tobytes() + coded.tobytes() + counters[place].tobytes(), 3)


def _unpack_counters(data: bytes, size: int) -> np.ndarray:
    data = zstandard.decompress(data)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    coded = np.frombuffer(data, np.uint8, len(data) - 8 - n, 8)
    ends = coded < FULL
    counters = np.zeros(size, np.uint8)
    counters[(np.cumsum(coded.astype(np.int64) + ends) - 1)[ends]] = np.frombuffer(data, np.uint8, n, len(data) - n)
    return counters


def _count(counters: np.ndarray, place: np.ndarray) -> None:
    place, seen = np.unique(place, return_counts=True)
    counters[place] = np.minimum(counters[place] + seen, FULL)


def _chunks(counters: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The chunks of a task's counters that are not all 0, with their numbers."""
    for number in range(len(counters) // CHUNK):
        part = counters[number * CHUNK : (number + 1) * CHUNK]
        if part.any():
            yield number, _pack_counters(part)


def _counter(values: np.ndarray, bits: int) -> np.ndarray:
    """The counter of each shingle; by other bits than those that deal postings to parts."""
    return (values & np.uint64((1 << bits) - 1)).astype(np.int64)


def _level(sums: np.ndarray) -> np.ndarray:
    """Sums as bytes: exact up to EXACT, then their logarithm."""
    beyond = EXACT + (FULL - EXACT) / 20 * np.log2(np.maximum(sums, EXACT) / EXACT)
    return np.where(sums <= EXACT, sums, np.minimum(beyond, FULL)).astype(np.uint8)


def _describe(size: int, bits: int):
    """One row per document, and the shingle counters of the task that are not 0, in chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, kind = np.zeros(1 << bits, np.uint8), None
        for batch in batches:
            kind = batch.column(0).type
            for first, end, raw, at in K.slices(batch.column(1), SLICE_BYTES):
                values, counts = shingle_sets(raw, at, size)
                _count(counters, _counter(values, bits))
                n = end - first
                yield pa.record_batch({
                    "doc_id": batch.column(0).slice(first, n), "n": pa.array(counts), "cls": pa.array(_classes(values, counts)),
                    "chunk": pa.nulls(n, pa.int32()), "counters": pa.nulls(n, pa.binary()),
                })
        for number, data in _chunks(counters) if kind is not None else ():
            none = pa.nulls(1, pa.int64())
            yield pa.record_batch({
                "doc_id": pa.nulls(1, kind), "n": none, "cls": none, "chunk": pa.array([number], pa.int32()),
                "counters": pa.array([data], pa.binary()),
            })

    return run


def _add_counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the chunks that a task holds, each of fixed size."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[number] = sums.get(number, 0) + _unpack_counters(data, CHUNK).astype(np.int64)
    for number, total in sums.items():
        yield pa.record_batch({"chunk": pa.array([number], pa.int32()), "counters": pa.array([_level(total).tobytes()], pa.binary())})


def _summed(chunks: DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """All tasks' counters together as levels, chunk by chunk: (first place, levels). Dealt by chunk, each task sums whole ones."""
    with temporary(chunks.sparkSession) as keep:
        summed = keep(chunks.repartition("chunk").mapInArrow(_add_counters, "chunk int, counters binary"), "summed")
        for r in summed.toLocalIterator():  # fixed size: the counters
            yield r["chunk"] * CHUNK, np.frombuffer(r["counters"], np.uint8)


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """T: shingles that a set of n shares at least with any set it links to."""
    return -(-n * percent // 100)


def listed(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of its rarest shingles a set of n lists, and how many of these it shares at least with any set it links to.

    With c shingles in common, both sets list the first c - g(n) of them if both list n - g(n), for any g
    that never falls, and n of the larger. c is T of the larger set at least; g is 7/8 of T, rounded down,
    so an eighth of T, rounded up, is left over for the larger set and thus for the smaller.
    """
    return n - n * percent * (SPARE - 1) // (100 * SPARE), -(-n * percent // (100 * SPARE))


class _Dealer:
    """Deals the postings of classes to parts: a row per part and block of classes with the shingles and the classes'
    numbers in the block, twice as high and 1 more where the shingle is among the n - T + 1 rarest. Then a row per block
    with the names and sizes of its classes, on a part below 0."""

    def __init__(self):
        self.task, self.blocks, self.held = TaskContext.get().partitionId(), 0, []
        self.docs = self.postings = 0

    def add(self, names: np.ndarray, n: np.ndarray, per: np.ndarray, shingles: np.ndarray, early: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Classes with ``per`` shingles each, end to end; the part of a shingle is in its bits from 32 on."""
        ends = np.concatenate([[0], np.cumsum(per)])
        for a in range(0, len(n), DEALT_DOCS):
            z = min(a + DEALT_DOCS, len(n))
            if self.docs + z - a > DEALT_DOCS or self.postings > DEALT:
                yield from self.deal()
            self.held.append((names[a:z], n[a:z], per[a:z], shingles[ends[a] : ends[z]], early[ends[a] : ends[z]]))
            self.docs, self.postings = self.docs + z - a, self.postings + int(ends[z] - ends[a])

    def deal(self) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        names, n, per, shingles, early = (np.concatenate(x) for x in zip(*self.held))
        number = np.repeat(np.arange(len(names), dtype=np.uint16), per) << 1 | early
        part = (shingles >> 32).astype(np.uint16)
        order = np.argsort(part, kind="stable")
        counts = np.bincount(part)
        some = np.flatnonzero(counts)
        meta = pa.array([names.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())
        yield pa.record_batch({
            "part": pa.array([*some.tolist(), -1 - self.task], pa.int32()),
            "block": pa.array(np.full(len(some) + 1, self.task << 32 | self.blocks)),
            "keys": pa.concat_arrays([K.binary_column(shingles[order].astype(np.uint32), counts[some]), meta[0]]),
            "docs": pa.concat_arrays([K.binary_column(number[order], counts[some]), meta[1]]),
        })
        self.blocks, self.docs, self.postings = self.blocks + 1, 0, 0
        self.held.clear()


def _postings(size: int, percent: int, bits: int, part_bits: int, shared):
    """The rarest shingles of each class, once per class and task, dealt to 2^part_bits parts by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer, known = _Dealer(), set()
        for batch in batches:
            for _, _, raw, at in K.slices(batch.column(0), SLICE_BYTES):
                values, n = shingle_sets(raw, at, size)
                names = _classes(values, n)
                fresh = np.zeros(len(n), bool)
                for i, pair in enumerate(zip(names.tolist(), n.tolist())):
                    if pair[1] and pair not in known:
                        known.add(pair)
                        fresh[i] = True
                if len(known) > 500_000:
                    known.clear()
                often = shared.value[_counter(values, bits)].astype(np.uint64)
                keys = often << np.uint64(56) | values >> np.uint64(8)
                _sort_rows(keys, n)
                rows = np.repeat(np.arange(len(n)), n)
                rank = np.arange(len(keys)) - (np.cumsum(n) - n)[rows]
                most, least = listed(n, percent)
                chosen = (rank < most[rows]) & (keys >> np.uint64(56) > 1)  # others hold it too, or may
                fresh &= np.bincount(rows[chosen], minlength=len(n)) >= least
                chosen &= fresh[rows]
                early = (rank <= (n - least_overlap(n, percent))[rows])[chosen].astype(np.uint16)
                keys, rows = keys[chosen].view(np.int64), rows[chosen]
                part = (keys >> (48 - part_bits)) & ((1 << part_bits) - 1)
                own = np.flatnonzero(fresh)
                per = np.bincount(rows, minlength=len(n))[own]
                yield from dealer.add(names[own], n[own], per, part << 32 | keys & 0xFFFFFFFF, early)
        yield from dealer.deal()

    return run


def _runs_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows that come sorted by a column, one value of it after the other."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return ((value, list(some)) for value, some in itertools.groupby(rows, lambda row: row[column]))


def _listed_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The postings of each part whose shingle is there twice; rows of blocks pass."""
    for part, some in _runs_of(batches, "part"):
        if part >= 0:
            keys = [np.frombuffer(row["keys"], np.uint32) for row in some]
            every = np.concatenate(keys)
            order = np.argsort(every)
            same = every[order[1:]] == every[order[:-1]]
            again = np.zeros(len(every), bool)
            again[order[1:][same]] = again[order[:-1][same]] = True
            for row, own, keep in zip(some, keys, np.split(again, np.cumsum([len(x) for x in keys])[:-1])):
                row["keys"], row["docs"] = own[keep].tobytes(), np.frombuffer(row["docs"], np.uint16)[keep].tobytes()
        if some := [row for row in some if row["keys"]]:
            yield pa.RecordBatch.from_pylist(some, _DEALT)


def _likely_classes(percent: int):
    """The classes of each block that share as many listed shingles as a link asks for, with those of the n - T + 1 rarest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some in _runs_of(batches, "block"):
            [meta] = [row for row in some if row["part"] < 0]
            names, n = (np.frombuffer(meta[x], np.int64) for x in ("keys", "docs"))
            parts = [row for row in some if row["part"] >= 0]
            if not parts:
                continue
            shingles = np.concatenate([np.frombuffer(row["keys"], np.uint32).astype(np.int64) | row["part"] << 32 for row in parts])
            docs = np.concatenate([np.frombuffer(row["docs"], np.uint16) for row in parts])
            owner = docs >> 1
            likely = np.bincount(owner, minlength=len(n)) >= listed(n, percent)[1]
            keep = np.flatnonzero(likely[owner] & (docs & 1 == 1))
            keep = keep[np.argsort(owner[keep], kind="stable")]
            shingles, counts = shingles[keep], np.bincount(owner[keep], minlength=len(n))
            own = np.flatnonzero(counts)
            ends = np.concatenate([[0], np.cumsum(counts[own])])
            for a in range(0, len(own), BATCH_ROWS):
                z = min(a + BATCH_ROWS, len(own))
                yield pa.record_batch({
                    "cls": pa.array(names[own[a:z]]), "n": pa.array(n[own[a:z]]), "shingles": pa.ListArray.from_arrays(
                        pa.array(ends[a : z + 1] - ends[a], pa.int32()), pa.array(shingles[ends[a] : ends[z]]))})

    return run


_DEALT = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("docs", pa.binary())])


def _likely_postings(texts: DataFrame, size: int, percent: int, bits: int, shared, shingles: int) -> DataFrame:
    """(shingle, class, size) for the rarest shingles of each class that may link. All listed shingles are compared, in
    parts of bounded size; only what is listed twice goes back to its class."""
    part_bits = min(15, (shingles // PART).bit_length())
    schema = "part int, block long, keys binary, docs binary"
    dealt = texts.mapInArrow(_postings(size, percent, bits, part_bits, shared), schema)
    again = dealt.repartition("part").sortWithinPartitions("part").mapInArrow(_listed_again, schema)
    likely = again.repartition("block").sortWithinPartitions("block").mapInArrow(
        _likely_classes(percent), "cls long, n long, shingles array<long>")
    return likely.dropDuplicates(["cls", "n"]).select(F.explode("shingles").alias("shingle"), "cls", "n")


def _count_postings(bits: int):
    """The counters of a task's posted shingles; by other bits of a shingle than those that have chosen it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            _count(counters, batch.column(0).to_numpy() & ((1 << bits) - 1))
        for number, data in _chunks(counters):
            yield pa.record_batch({"chunk": pa.array([number], pa.int32()), "counters": pa.array([data], pa.binary())})

    return run


def _posted_again(postings: DataFrame) -> DataFrame:
    """The postings without most of the shingles that only one row has: those lists have one member. What is left
    goes through shuffles."""
    bits = min(MOST_AGAIN_BITS, max(LEAST_AGAIN_BITS, (16 * postings.count()).bit_length()))
    chunks = postings.select("shingle").mapInArrow(_count_postings(bits), "chunk int, counters binary")
    again = np.zeros((1 << bits) // 8, np.uint8)
    for at, counters in _summed(chunks):
        again[at // 8 : (at + len(counters)) // 8] = np.packbits(counters > 1, bitorder="little")
    shared = postings.sparkSession.sparkContext.broadcast(again)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(0).to_numpy() & ((1 << bits) - 1)
            yield batch.filter(pa.array((shared.value[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)))

    return postings.mapInArrow(run, postings.schema)


def sketch_bits(n: np.ndarray) -> np.ndarray:
    """Bits of the buckets that the shingles of a set of n are counted in: about three to a bucket."""
    return np.clip(np.frexp(np.maximum(n, 1) // 3)[1], 5, 16)


def _sketches(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles per bucket as bytes, the sketches of all rows end to end, their sizes, and what a byte could not count."""
    bits = sketch_bits(counts)
    sizes = 1 << bits
    begin = np.cumsum(sizes) - sizes
    rows = np.repeat(np.arange(len(counts)), counts)
    place = begin[rows] + (values >> (64 - bits[rows]).astype(np.uint64)).astype(np.int64)
    full = np.bincount(place, minlength=int(sizes.sum()))
    beyond = np.add.reduceat(np.maximum(full - FULL, 0), begin) if len(begin) else begin
    return np.minimum(full, FULL).astype(np.uint8), sizes, beyond


def _needed_sets(size: int, shared):
    """(class, size, set, sketch) of the documents in the filter; the first column is the hash of their key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            wanted = batch.filter(_in_filter(batch.column(0), bits))
            for _, _, raw, at in K.slices(wanted.column(1), SLICE_BYTES):
                values, counts = shingle_sets(raw, at, size)
                sketches, sizes, beyond = _sketches(values, counts)
                yield pa.record_batch({
                    "cls": pa.array(_classes(values, counts)), "n": pa.array(counts), "grams": K.binary_column(values, counts),
                    "sketch": K.binary_column(sketches, sizes), "beyond": pa.array(beyond)})

    return run


def t_occurrence(queries: Iterable[np.ndarray], index: list[np.ndarray], percent: int) -> Iterator[np.ndarray]:
    """For each query the places in ``index`` whose similarity reaches ``percent`` (DivideSkip).

    Sets are sorted arrays of distinct hashes.
    """
    sizes = np.array([len(x) for x in index], np.int64)
    grams = np.concatenate(index)
    owners = np.repeat(np.arange(len(index)), sizes)
    order = np.lexsort((owners, grams))
    grams, owners = grams[order], owners[order]
    keys, begin = np.unique(grams, return_index=True)
    lengths = np.diff(np.concatenate([begin, [len(grams)]]))
    longest = int(lengths.max()) if len(lengths) else 1
    # All lists end to end, by number of the list and member: one search looks up many members in many lists.
    entries = np.repeat(np.arange(len(keys)) * len(index), lengths) + owners
    for query in queries:
        n = len(query)
        least = int(least_overlap(np.array(n), percent))
        at = np.searchsorted(keys, query)
        at = at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == query)]
        if len(at) < least or not n:
            yield np.empty(0, np.int64)
            continue
        at = at[np.argsort(lengths[at], kind="stable")]
        aside = min(least - 1, int(least / (SKIP_WEIGHT * math.log2(longest + 1) + 1)))
        short, long_ = at[: len(at) - aside], at[len(at) - aside :]
        counts = np.bincount(owners[K.spread(begin[short], lengths[short])], minlength=len(index))
        fits = (100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes)) & (counts >= max(1, least - aside))
        some = np.flatnonzero(fits)
        if len(some):
            shared = counts[some]
            step = max(1, SEARCHED // len(some))
            for a in range(0, len(long_), step):
                asked = long_[a : a + step, None] * len(index) + some
                where = np.searchsorted(entries, asked)
                shared = shared + (entries[np.minimum(where, len(entries) - 1)] == asked).sum(axis=0)
            some = some[100 * shared >= percent * (n + sizes[some] - shared)]
        yield some


_EDGES = "cls_a long, n_a long, cls_b long, n_b long"


def _link_block(table: pa.Table, percent: int) -> list[tuple[int, int, int, int]]:
    """Compare the query rows of a block with all its rows; rows of one component need no look."""
    names, n = table["cls"].to_numpy(), table["n"].to_numpy()
    # A class may come from several tasks; one row of it is enough, a query row if there is one.
    key = K.mix(names.view(np.uint64) + n.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, where = np.unique(key, return_index=True, return_inverse=True)
    if len(first) < 2:
        return []
    asked = np.zeros(len(first), bool)
    asked[where[table["query"].to_numpy(zero_copy_only=False)]] = True
    queries = np.flatnonzero(asked)
    grams = table["grams"].combine_chunks().cast(pa.large_binary())
    _, offsets, data = grams.buffers()
    at = np.frombuffer(offsets, np.int64)[grams.offset : grams.offset + len(grams) + 1]
    sets = [np.frombuffer(data, np.uint64, (at[i + 1] - at[i]) // 8, at[i]) for i in first.tolist()]
    parts = table["component"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    label = parts[first].astype(np.int64)
    edges, asked_now = [], []

    def still_apart() -> Iterator[np.ndarray]:
        for q in queries.tolist():
            if (label != label[q]).any():  # as the links found so far leave it
                asked_now.append(q)
                yield sets[q]

    for linked in t_occurrence(still_apart(), sets, percent):
        q = asked_now[-1]
        while len(apart := linked[label[linked] != label[q]]):
            a, b = first[q], first[apart[0]]
            edges.append((int(names[a]), int(n[a]), int(names[b]), int(n[b])))
            label[label == label[apart[0]]] = label[q]
    return edges


def _candidates(table: pa.Table, percent: int) -> list[tuple[int, int, int, int]]:
    """A spanning forest of the pairs of a block that may link, by sizes and sketches, though not yet in one component."""
    names, n, beyond = (table[x].to_numpy() for x in ("cls", "n", "beyond"))
    asked = table["query"].to_numpy(zero_copy_only=False)
    label = table["component"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    bits = sketch_bits(n)
    data = table["sketch"].combine_chunks().cast(pa.large_binary())
    _, offsets, raw = data.buffers()
    at = np.frombuffer(offsets, np.int64)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(raw, np.uint8)
    edges, family = [], np.arange(len(n))
    for level in np.unique(bits).tolist():
        # Sketches of this size, and those of the next size with neighbouring buckets added up: a pair
        # meets at the smaller of its two sizes.
        same, above = np.flatnonzero(bits == level), np.flatnonzero(bits == level + 1)
        parts = [raw[K.spread(at[same], at[same + 1] - at[same])].reshape(len(same), -1).astype(np.uint16)]
        if len(above):
            wide = raw[K.spread(at[above], at[above + 1] - at[above])].reshape(len(above), -1, 2)
            parts.append(wide.sum(axis=2, dtype=np.uint16))
        members, counts = np.concatenate([same, above]), np.concatenate(parts)
        for i, q in enumerate(same.tolist()):
            near = (label[members] != label[q]) & (family[members] != family[q]) & (asked[members] | asked[q])
            near &= 100 * np.minimum(n[members], n[q]) >= percent * np.maximum(n[members], n[q])
            some = np.flatnonzero(near)
            if not len(some):
                continue
            most = np.minimum(counts[some], counts[i]).sum(axis=1, dtype=np.int64) + np.minimum(beyond[members[some]], beyond[q])
            good = members[some[100 * most >= percent * (n[members[some]] + n[q] - most)]]
            while len(apart := good[family[good] != family[q]]):
                other = apart[0]
                edges.append((int(names[q]), int(n[q]), int(names[other]), int(n[other])))
                family[family == family[other]] = family[q]
    return edges


def _near_rows(table: pa.Table, begin: np.ndarray, percent: int) -> np.ndarray:
    """``_candidates`` of many small blocks at once, over all pairs of each. ``begin`` has the first row of each block,
    and the number of rows."""
    names, n, beyond = (table[x].to_numpy() for x in ("cls", "n", "beyond"))
    asked = table["query"].to_numpy(zero_copy_only=False)
    label = table["component"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    bits = sketch_bits(n)
    data = table["sketch"].combine_chunks().cast(pa.large_binary())
    _, offsets, raw = data.buffers()
    at = np.frombuffer(offsets, np.int64)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(raw, np.uint8)
    after = np.repeat(begin[1:], np.diff(begin)) - np.arange(len(n)) - 1
    a, b = np.repeat(np.arange(len(n)), after), K.spread(np.arange(len(n)) + 1, after)
    near = (label[a] != label[b]) & (asked[a] | asked[b])
    near &= 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
    a, b = a[near], b[near]
    a, b = np.where(bits[a] <= bits[b], a, b), np.where(bits[a] <= bits[b], b, a)
    found = []
    for level in np.unique(bits[a]).tolist():
        for wider in (0, 1):
            some = np.flatnonzero((bits[a] == level) & (bits[b] == level + wider))
            for some in np.array_split(some, (len(some) << level) // COMPARED + 1):
                x = raw[K.spread(at[a[some]], at[a[some] + 1] - at[a[some]])].reshape(len(some), 1 << level)
                y = raw[K.spread(at[b[some]], at[b[some] + 1] - at[b[some]])]
                y = y.reshape(len(some), 1 << level, 1 << wider).sum(axis=2, dtype=np.uint16)
                most = np.minimum(x, y).sum(axis=1, dtype=np.int64) + np.minimum(beyond[a[some]], beyond[b[some]])
                found.append(some[100 * most >= percent * (n[a[some]] + n[b[some]] - most)])
    some = np.concatenate(found) if found else np.empty(0, np.int64)
    family, forest = list(range(len(n))), []
    for i, x, y in zip(some.tolist(), a[some].tolist(), b[some].tolist()):
        while family[x] != x:
            family[x] = x = family[family[x]]
        while family[y] != y:
            family[y] = y = family[family[y]]
        if x != y:
            family[x] = y
            forest.append(i)
    some = np.array(forest, np.int64)
    return np.unique(np.stack([names[a[some]], n[a[some]], names[b[some]], n[b[some]]], axis=1), axis=0)


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Runs of whole blocks, with the first row of each and the number of rows: rows come sorted by block. A block that
    lies in several batches comes alone."""
    held: list[pa.Table] = []
    current = None

    def alone() -> tuple[pa.Table, np.ndarray]:
        table = pa.concat_tables(held)
        held.clear()
        return table, np.array([0, len(table)])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(x).to_numpy() for x in ("list", "i", "j")])
        change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        table = pa.Table.from_batches([batch])
        if held and tuple(keys[:, 0].tolist()) != current:
            yield alone()
        begin = np.concatenate([[0], change])
        if held and len(begin) > 1:
            held.append(table.slice(0, begin[1]))
            yield alone()
            begin = begin[1:]
        if len(begin) > 1:
            yield table.slice(begin[0], begin[-1] - begin[0]), begin - begin[0]
        held.append(table.slice(begin[-1]))
        current = tuple(keys[:, -1].tolist())
    if held:
        yield alone()


def _pairs_of_blocks(pairs, percent: int, small=None):
    """The pairs that ``pairs`` finds in each block, or ``small`` in all the small ones of a run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple[int, int, int, int]] = []

        def out(found) -> pa.RecordBatch:
            columns = np.array(found, np.int64).reshape(-1, 4).T
            return pa.record_batch(dict(zip(("cls_a", "n_a", "cls_b", "n_b"), map(pa.array, columns))))

        for table, begin in _whole_blocks(batches):
            sizes = np.diff(begin)
            few = (sizes <= SMALL) & (small is not None)
            if few.any():
                rows = K.spread(begin[:-1][few], sizes[few])
                some = table if few.all() else table.take(rows)
                yield out(small(some, np.concatenate([[0], np.cumsum(sizes[few])]), percent))
            for a, m in zip(begin[:-1][~few].tolist(), sizes[~few].tolist()):
                edges += pairs(table.slice(a, m), percent)
            if len(edges) > 1000:
                yield out(edges)
                edges.clear()
        yield out(edges)

    return run


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """A row per document: the key, n_shingles and component_id.

    Texts are lower-cased (A-Z), words are what lies between spaces and the ASCII controls 9 to 13, a set has the
    distinct shingles of ``size`` words (the whole sequence, if shorter). Two documents link when
    100 * shared >= ``percent`` * union; component_id is the smallest key that links reach. Null, empty
    and blank texts have no shingles and link with nothing, nor do rows without a key (their
    component is null). Rows that repeat a key are kept, each with the component of its own text.
    An empty table gives no rows; other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType
    described_schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("n", T.LongType()), T.StructField("cls", T.LongType()),
        T.StructField("chunk", T.IntegerType()), T.StructField("counters", T.BinaryType()),
    ])
    texts = source.filter("doc_id is not null").select("text")
    with temporary(spark) as keep:
        bits = COUNTER_BITS
        described = keep(source.mapInArrow(_describe(size, bits), described_schema), "described")
        rows = described.filter("chunk is null").select("doc_id", "n", "cls")
        chunks = described.filter("chunk is not null").select("chunk", "counters")
        counters = np.zeros(1 << bits, np.uint8)
        for at, part in _summed(chunks):
            counters[at : at + len(part)] = part
        shared = spark.sparkContext.broadcast(counters)
        shingles = rows.agg(F.sum("n")).first()[0] or 0
        lists, _ = listed(np.array(shingles), percent)
        postings = keep(_likely_postings(texts, size, percent, bits, shared, int(lists)), "postings")
        shared.destroy()
        del counters, shared
        postings = _posted_again(postings)
        lists = postings.groupBy("shingle").agg(
            F.min("cls").alias("low"), F.max("cls").alias("high"), F.min_by("n", "cls").alias("n_low"), F.max_by("n", "cls").alias("n_high"),
        ).filter("low <> high")
        members = keep(postings.join(lists, "shingle"), "members")
        keep.drop("postings")
        classes = rows.filter("n > 0 and doc_id is not null").groupBy("cls", "n").agg(F.min("doc_id").alias("node"))
        classes = materialize(classes)
        sets = keep(_sets_of(source, members, classes, size), "sets")
        stars = keep(_star_blocks(members, percent, keep), "stars")
        keep.drop("met")
        likely = keep(_compare(stars, sets, percent, _candidates, ("sketch", "beyond")), "likely")
        first = keep(_compare(stars.join(_ends(likely), ["cls", "n"], "left_semi"), sets, percent), "first")
        keep.drop("stars", "likely")
        groups = components(_as_nodes(first, classes))
        labelled = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
        labelled = keep(labelled.select("cls", "n", "node", "component"), "labelled")
        opened = _open_blocks(members, labelled, percent, keep)
        near = keep(_compare(opened, sets, percent, _candidates, ("sketch", "beyond")), "near")
        keep.drop("members", "placed")
        families = keep(_family_blocks(near, labelled), "families")
        second = keep(_compare(families, sets, percent), "second")
        labelled = labelled.select("cls", "n", "component")
        if second.take(1):
            joined = components(_as_nodes(second, labelled.withColumnRenamed("component", "node")))
            joined = joined.select(F.col("node").alias("component"), F.col("component").alias("root"))
            labelled = labelled.join(joined, "component", "left").select("cls", "n", F.coalesce("root", "component").alias("component"))
        own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
        result = rows.join(labelled, ["cls", "n"], "left").select(
            F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))
        return materialize(result)


def _hash_filter(hashes: DataFrame):
    """A broadcast bit table of the hashes ``h``; its size is fixed, whatever their number."""
    place = F.shiftrightunsigned("h", 64 - FILTER_BITS).cast("int")
    words = hashes.select((place / 64).cast("int").alias("word"), (place % 64).alias("bit"))
    words = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    view = bits.view("<i8")
    with temporary(hashes.sparkSession) as keep:
        for r in keep(words, "words").toLocalIterator():  # fixed size: the filter
            view[r["word"]] = r["bits"]
    return hashes.sparkSession.sparkContext.broadcast(bits)


def _in_filter(hashes: pa.Array, bits: np.ndarray) -> pa.Array:
    place = (hashes.to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return pa.array((bits[place >> 3] >> (place & 7) & 1).astype(bool))


def _passing(shared):
    """The rows whose first column is in the filter, without that column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(_in_filter(batch.column(0), shared.value)).drop_columns(batch.schema.names[0])

    return run


def _ends(pairs: DataFrame) -> DataFrame:
    """The classes of pairs."""
    sides = [pairs.select(F.col(f"cls_{x}").alias("cls"), F.col(f"n_{x}").alias("n")) for x in ("a", "b")]
    return sides[0].unionByName(sides[1]).distinct()


def _sets_of(source: DataFrame, members: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """The shingle sets of the classes in ``members``, by one more reading of their first documents."""
    wanted = members.select("cls", "n").distinct().join(classes, ["cls", "n"]).select(F.xxhash64("node").alias("h"))
    shared = _hash_filter(wanted)
    named = source.filter("doc_id is not null").select(F.xxhash64("doc_id").alias("h"), "text")
    return named.mapInArrow(_needed_sets(size, shared), "cls long, n long, grams binary, sketch binary, beyond long").filter("n > 0")


def _star_blocks(members: DataFrame, percent: int, keep) -> DataFrame:
    """Blocks of a pivot with the classes that meet it in the most lists."""
    ends = F.array(
        F.struct(F.col("low").alias("pivot"), F.col("n_low").alias("m")), F.struct(F.col("high").alias("pivot"), F.col("n_high").alias("m")))
    met = members.select("cls", "n", F.explode(ends).alias("end")).select("cls", "n", "end.pivot", "end.m")
    met = met.filter((F.col("cls") != F.col("pivot")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m")))
    met = met.groupBy("cls", "n", "pivot", "m").agg(F.count("*").alias("lists"))
    best = Window.partitionBy("cls", "n").orderBy(F.desc("lists"), "pivot")
    met = met.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= PIVOTS)
    met = keep(met.select("cls", "n", "pivot", "m"), "met")
    sizes = met.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    met = met.select("cls", "n", "pivot").unionByName(met.select(F.col("pivot").alias("cls"), F.col("m").alias("n"), "pivot")).distinct()
    placed = met.join(sizes, "pivot")
    is_pivot = F.col("cls") == F.col("pivot")
    own = F.pmod(F.xxhash64("cls", "n"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    blocks = F.when(is_pivot, every).otherwise(F.array(own))
    return placed.select(
        F.col("pivot").alias("list"), F.explode(blocks).alias("i"), F.lit(0).alias("j"), "cls", "n",
        F.lit(True).alias("query"), F.xxhash64("cls", "n").cast("string").alias("component"))


def _open_blocks(members: DataFrame, labelled: DataFrame, percent: int, keep) -> DataFrame:
    """Blocks of the lists whose members are in several components."""
    labelled = labelled.select("cls", "n", F.col("component").cast("string").alias("component"))
    placed = members.select("shingle", "cls", "n").join(labelled, ["cls", "n"])
    placed = keep(placed.withColumn("mark", F.xxhash64("component")), "placed")
    lists = placed.groupBy("shingle").agg(
        F.count("*").alias("m"), F.sum(F.xxhash64("cls", "n").cast("decimal(20,0)")).alias("members"),
        F.min("mark").alias("low"), F.max("mark").alias("high"), F.min_by("mark", "cls").alias("pivot"),
        F.min("n").alias("least"), F.max("n").alias("most"),
    ).filter("low <> high")
    # Two members whose sizes are too far apart cannot link.
    lists = lists.filter((F.col("m") > 2) | (100 * F.col("least") >= percent * F.col("most")))
    # Lists of the same members are looked at once.
    lists = lists.groupBy("m", "members").agg(F.min_by(F.struct("shingle", "pivot"), "shingle").alias("chosen"))
    lists = lists.select(F.col("chosen.shingle").alias("shingle"), F.col("chosen.pivot").alias("pivot"), "m")
    opened = placed.join(lists, "shingle").withColumn("outside", F.col("mark") != F.col("pivot"))
    outside = opened.groupBy("shingle").agg(F.count_if("outside").alias("k"))
    opened = opened.join(outside, "shingle").withColumns({
        "all_blocks": F.ceil(F.col("m") / BLOCK).cast("int"), "out_blocks": F.ceil(F.col("k") / BLOCK).cast("int")})
    i = F.pmod(F.xxhash64("cls", "n"), F.col("out_blocks")).cast("int")
    j = F.pmod(F.xxhash64("n", "cls"), F.col("all_blocks")).cast("int")
    as_query = F.when(F.col("outside"), F.transform(
        F.sequence(F.lit(0), F.col("all_blocks") - 1), lambda x: F.struct(i.alias("i"), x.alias("j"), F.lit(True).alias("query"))))
    as_index = F.transform(
        F.sequence(F.lit(0), F.col("out_blocks") - 1), lambda x: F.struct(x.alias("i"), j.alias("j"), F.lit(False).alias("query")))
    places = F.explode(F.concat(F.coalesce(as_query, F.array().cast("array<struct<i:int,j:int,query:boolean>>")), as_index))
    return opened.select("shingle", "cls", "n", "component", places.alias("place")).select(
        F.col("shingle").alias("list"), "place.i", "place.j", "cls", "n", "place.query", "component")


def _family_blocks(near: DataFrame, labelled: DataFrame) -> DataFrame:
    """Blocks of the classes that candidate pairs connect: every two of a family meet."""
    families = components(_as_nodes(near, labelled)).select("node", F.col("component").alias("family"))
    labelled = families.join(labelled, "node").select("family", "cls", "n", F.col("component").cast("string").alias("component"))
    lanes = labelled.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("lanes"))
    lane = F.pmod(F.xxhash64("cls", "n"), F.col("lanes")).cast("int")
    met = F.transform(F.sequence(F.lit(0), F.col("lanes") - 1), lambda x: F.struct(F.least(lane, x).alias("i"), F.greatest(lane, x).alias("j")))
    placed = labelled.join(lanes, "family").select(F.xxhash64("family").alias("list"), F.explode(met).alias("at"), "cls", "n", "component")
    return placed.select("list", "at.i", "at.j", "cls", "n", F.lit(True).alias("query"), "component")


def _compare(blocks: DataFrame, sets: DataFrame, percent: int, pairs=_link_block, columns: tuple[str, ...] = ("grams",)) -> DataFrame:
    source = sets.select("cls", "n", *columns)
    if "grams" in columns:
        shared = _hash_filter(blocks.select(F.xxhash64("cls", "n").alias("h")))
        source = source.select(F.xxhash64("cls", "n").alias("h"), *source.columns).mapInArrow(_passing(shared), source.schema)
    filled = blocks.join(source, ["cls", "n"])
    dealt = filled.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j")
    return dealt.mapInArrow(_pairs_of_blocks(pairs, percent, _near_rows if pairs is _candidates else None), _EDGES).distinct()


def _as_nodes(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between classes as links between their smallest documents."""
    for side in ("a", "b"):
        edges = edges.join(classes.select(
            F.col("cls").alias(f"cls_{side}"), F.col("n").alias(f"n_{side}"), F.col("node").alias(side)), [f"cls_{side}", f"n_{side}"])
    return edges.select("a", "b")
