"""Periodic runs of words inside documents, by uniting suffix classes in the order of their common prefixes.

Two positions of a text belong to one class at level L if at least L words from there on agree. The
classes are intervals of the sorted suffixes, so going down the levels is Kruskal's algorithm on
neighbouring suffixes, the longest common prefix (LCP) first. Each class keeps its positions in
order. When two positions become neighbours in a class at a distance p of at most the level, the
words from the first on repeat with period p for p plus the LCP words: they seed a run. A run with
smallest period q has its own first position among its seeds: a position between it and the one q
words later would, by Fine and Wilf, make a smaller period. For the same reason p is always the smallest
period. Seeds of one run agree in period and end, and the smallest gives the start.

Work is done for a slice of texts at once; suffixes are sorted by doubling, and only texts with a
repeated stretch of words take part.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from threadloom.llm import kernels as K
from threadloom.llm.common import prepare

# Bytes of text that are worked on at once, unless a text is longer.
SLICE_BYTES = 500_000

WORD = np.ones(256, bool)
WORD[[32, 9, 10, 11, 12, 13]] = False

RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])


def _sort_suffixes(first: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The order of all suffixes, and (words, ranks) of each step of the doubling.

    ``first`` numbers the words; a text ends in a number of its own, so no two suffixes are equal.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    key = first[order]
    fresh = np.ones(n, bool)
    fresh[1:] = key[1:] != key[:-1]
    words, steps = 1, []
    while True:
        # A suffix is named by the place where its group begins.
        begin = np.flatnonzero(fresh)
        sizes = np.diff(np.append(begin, n))
        name = np.repeat(begin, sizes)
        rank = np.empty(n, np.int32)
        rank[order] = name
        steps.append((words, rank))
        tied = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if not len(tied):
            return order, steps
        # Closing numbers are met once, so a tied suffix goes on after these words.
        suffixes = order[tied]
        key = name[tied] << 32 | rank[suffixes + words]
        again = np.argsort(key, kind="stable")
        order[tied], key = suffixes[again], key[again]
        fresh[tied[1:]] |= key[1:] != key[:-1]
        words *= 2


def _common_prefix(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Words that the suffixes at a and b share from their start."""
    total, last = np.zeros(len(a), np.int64), len(steps[0][1]) - 1
    for words, rank in reversed(steps):
        same = rank[np.minimum(a + total, last)] == rank[np.minimum(b + total, last)]
        total += words * same
    return total


def _seeds(a: np.ndarray, b: np.ndarray, common: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """(position, distance, level) of the neighbours that come up while classes unite.

    ``a`` and ``b`` are neighbouring suffixes with ``common`` words in common.
    """
    order = np.argsort(-common, kind="stable")
    # Positions are kept negative and ascending: a run adds its positions from the back, to the end of the list.
    owner: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    found: tuple[list[int], list[int], list[int]] = ([], [], [])

    def root(x: int) -> int:
        while (up := owner.get(x, x)) != x:
            owner[x] = x = owner.get(up, up)
        return x

    def seed(low: int, high: int, level: int) -> None:
        if high - low <= level:
            found[0].append(-high)
            found[1].append(high - low)
            found[2].append(level)

    for x, y, level in zip(a[order].tolist(), b[order].tolist(), common[order].tolist()):
        x, y = root(x), root(y)
        large, small = members.pop(x, None) or [-x], members.pop(y, None) or [-y]
        if len(large) < len(small):
            large, small, x, y = small, large, y, x
        for value in small:
            insort(large, value)
        # Neighbours that were both in the small class came up before, at a higher level.
        old = set(small)
        for value in small:
            at = bisect_left(large, value)
            if at and large[at - 1] not in old:
                seed(large[at - 1], value, level)
            if at + 1 < len(large) and large[at + 1] not in old:
                seed(value, large[at + 1], level)
        owner[y] = x
        members[x] = large
    return found


def runs_of(words: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of the runs of all rows, sorted by row, start and period.

    ``words`` are word hashes of all rows end to end, ``counts`` the words per row. A run has at
    least ``least`` words and at least two periods.
    """
    none = (np.empty(0, np.int64),) * 4
    # At a run's start, the LCP with the place one period on is at least half of the shortest run.
    short = max(1, (least + 1) // 2)
    rows = np.repeat(np.arange(len(counts)), counts)
    values, first = K.grams(words, counts, short)
    values = K.mix(values + K.mix(rows[first].astype(np.uint64)))
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    chosen = np.unique(rows[first[order[1:][same]]])
    if not len(chosen):
        return none
    # The chosen rows end to end, each with a closing word that no other row or place has.
    sizes = counts[chosen]
    begin = np.cumsum(sizes + 1) - sizes - 1
    flat = K.mix(np.repeat(chosen, sizes + 1).astype(np.uint64))
    inner = K.spread(begin, sizes)
    flat[inner] = K.mix(flat[inner] ^ words[K.spread((np.cumsum(counts) - counts)[chosen], sizes)])
    _, numbers = np.unique(flat, return_inverse=True)
    order, steps = _sort_suffixes(numbers)
    a, b = order[:-1], order[1:]
    # Only neighbours that share a step of at most ``short`` words can share ``short``.
    near = max((x for x in steps if x[0] <= short), key=lambda x: x[0])[1]
    close = near[a] == near[b]
    a, b = a[close], b[close]
    common = _common_prefix(a, b, steps)
    keep = common >= short
    start, period, level = (np.array(x, np.int64) for x in _seeds(a[keep], b[keep], common[keep]))
    if not len(start):
        return none
    end = start + period + level
    order = np.lexsort((start, end, period))
    start, period, end = start[order], period[order], end[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (period[1:] != period[:-1]) | (end[1:] != end[:-1])
    start, period, length = start[fresh], period[fresh], (end - start)[fresh]
    long_ = length >= np.maximum(least, 2 * period)
    start, period, length = start[long_], period[long_], length[long_]
    row = np.searchsorted(begin, start, side="right") - 1
    start = start - begin[row]
    order = np.lexsort((period, start, row))
    return chosen[row[order]], start[order], length[order], period[order]


def _collapse(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray, runs) -> pa.Array:
    """The words that no run holds after its first period, joined by one space."""
    row, start, length, period = runs
    before = np.cumsum(counts) - counts
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, before[row] + start + period, 1)
    np.add.at(cover, before[row] + start + length, -1)
    kept = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
    rows = np.repeat(np.arange(len(counts)), counts)[kept]
    lengths = ends[kept] - starts[kept] + 1
    out = raw[np.minimum(K.spread(starts[kept], lengths), max(len(raw) - 1, 0))] if len(kept) else np.empty(0, np.uint8)
    closing = np.cumsum(lengths) - 1
    out[closing] = 32
    last = np.ones(len(kept), bool)
    last[:-1] = rows[1:] != rows[:-1]
    stay = np.ones(len(out), bool)
    stay[closing[last]] = False
    sizes = np.bincount(rows, lengths, minlength=len(counts)).astype(np.int64) - np.bincount(rows[last], minlength=len(counts))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.Array.from_buffers(pa.large_string(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(out[stay])]).cast(pa.string())


def _find(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            for first, end, raw, at in K.slices(text, SLICE_BYTES):
                starts, ends = K.runs(raw, at, WORD)
                counts = K.row_counts(K.rows_of(starts, at), end - first)
                row, start, length, period = runs = runs_of(K.span_hashes(raw, starts, ends), counts, least)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=end - first))]).astype(np.int32)
                items = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"])
                found = pa.StructArray.from_arrays(
                    [pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), items), _collapse(raw, starts, ends, counts, runs)],
                    ["n_words", "runs", "collapsed"])
                rest = [x.slice(first, end - first) for x in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*rest, found], batch.schema.names)

    return run


def find_runs(docs: DataFrame, text: str = "text", into: str = "periodic", least: int = 12) -> DataFrame:
    """The rows of ``docs`` with a column ``into``: n_words, the runs (start, length, period) and the collapsed text.

    Words are what lies between spaces and the ASCII controls 9 to 13. A run is a stretch of words
    with smallest period q, of at least ``least`` words and two periods, that no neighbouring word extends; runs
    are sorted by start, then period. The collapsed text has the words outside all runs and those of
    each run's first period that lie in no other run after its own, joined by one space.

    A null, empty or blank text has no words, no runs and an empty collapsed text. Equal texts and
    repeated rows each get theirs. A very long text is worked on alone, in memory that grows with its words times
    the logarithm of its longest repeat. An empty table gives no rows. All columns stay; one that is
    already called ``into`` (in any case) is replaced.
    """
    prepare(docs.sparkSession)
    kept = [x for x in docs.schema.fields if x.name.lower() != into.lower()]
    rows = docs.select(*(docs[f"`{x.name}`"] for x in kept), docs[f"`{text}`"].alias(into))
    found = T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(_find(least), T.StructType([*kept, T.StructField(into, found)]))


def strongest(runs: Column) -> Column:
    """The longest run; of equals that with the smallest start, then period. Null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))
