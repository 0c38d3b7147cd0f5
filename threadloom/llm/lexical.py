"""Ranked search of words over a K2-treap of the term-document grid.

Spark cuts the documents into blocks of a bounded number of bytes. A block numbers its terms (rows) and
documents (columns) and stores the grid of their cells as a quadtree: a node has four bits for its
quadrants and the greatest impact below it, as the difference to its parent's; a leaf has the
number of occurrences. Impact is what a cell adds to a score for each unit of its term's weight.

A search goes down the paths of all rows of an item at once. A range of columns, with the node of
each row at that height, has a bound: the weighted sum of the greatest impacts. Ranges are opened
best first, a batch at a time, until none can reach the item's k-th best score so far, which a task
keeps over all its blocks. Bounds are never below the scores, so the result is exact.

Terms are ordered by the number of documents that hold them, so that rare rows share empty squares.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from threadloom.llm import kernels as K
from threadloom.llm.common import prepare

# Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 16_000_000
SLICE_BYTES = 500_000
# Inner nodes keep impacts in units of this, rounded up: an impact stays below a million.
UNIT_BITS = 4
# Ranges that are opened at once.
BATCH = 512
# Terms of the items that are sent to the blocks at a time, on average; the items go in several turns.
TURN_TERMS = 500_000
# Parts that the best rows of an item are ranked in before they meet.
SALT = 32

TERM = np.zeros(256, bool)
TERM[48:58] = TERM[65:91] = TERM[97:123] = TERM[128:] = True

_POPULATION = np.array([[bin(mask & ((1 << quadrant) - 1)).count("1") for quadrant in range(5)] for mask in range(16)], np.int32)


def term_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all rows end to end, and their number per row."""
    raw = K.LOWER[raw]
    starts, ends = K.runs(raw, at, TERM)
    return K.span_hashes(raw, starts, ends), K.row_counts(K.rows_of(starts, at), len(at) - 1)


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * norm)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _apart(values: np.ndarray) -> np.ndarray:
    """The bits of numbers below 2**32 at every second place."""
    x = values.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


def build_treap(rows: np.ndarray, columns: np.ndarray, tf: np.ndarray, norms: np.ndarray, height: int) -> tuple[bytes, bytes, bytes]:
    """Child bits and impact differences of the inner nodes, level by level from the root, and the
    occurrences of the leaves; the cells are distinct and their coordinates below 2**height."""
    code = _apart(rows) << np.uint64(1) | _apart(columns)
    order = np.argsort(code, kind="stable")
    code = code[order]
    most = -(-impact(tf[order], norms[columns[order]]) >> UNIT_BITS)
    masks, maxima, counts = [], [], []
    for _ in range(height):
        parent = code >> np.uint64(2)
        begin = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        masks.append(np.bitwise_or.reduceat((1 << (code & np.uint64(3)).astype(np.int64)).astype(np.uint8), begin))
        counts.append(np.diff(np.append(begin, len(code))))
        most = np.maximum.reduceat(most, begin)
        maxima.append(most)
        code = parent[begin]
    differences = [maxima[-1]]
    for level in range(height - 1, 0, -1):
        differences.append(np.repeat(maxima[level], counts[level]) - maxima[level - 1])
    return (
        zstandard.compress(np.concatenate(masks[::-1]).tobytes(), 3),
        zstandard.compress(np.concatenate(differences).astype("<u2").tobytes(), 3),
        zstandard.compress(tf[order].astype("<u4").tobytes(), 3),
    )


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th best score, 0 with fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


class Treap:
    """A stored grid, ready to be searched."""

    def __init__(self, masks: bytes, differences: bytes, tf: bytes, norms: np.ndarray, height: int):
        self.masks = np.frombuffer(zstandard.decompress(masks), np.uint8)
        self.tf = np.frombuffer(zstandard.decompress(tf), "<u4")
        self.norms, self.height = norms, height
        sizes = _POPULATION[self.masks, 4]
        # Nodes are numbered level by level, so the children of all nodes follow each other from 1 on.
        self.child = np.cumsum(sizes, dtype=np.int32) - sizes + 1
        self.most = np.frombuffer(zstandard.decompress(differences), "<u2").astype(np.int32)
        level = [0, 1]
        while level[1] < len(self.masks):
            own = np.repeat(self.most[level[0] : level[1]], sizes[level[0] : level[1]])
            self.most[level[1] : level[1] + len(own)] = own - self.most[level[1] : level[1] + len(own)]
            level = [level[1], level[1] + len(own)]

    def search(self, rows: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores that are above 0, not below ``floor`` and not below the k-th best."""
        none = np.empty(0, np.int64)
        columns, scores = none, none
        nodes = np.zeros((1, len(rows)), np.int32)
        ranges, heights = np.zeros(1, np.int64), np.full(1, self.height, np.int64)
        bounds = np.array([int(weights.sum()) * int(self.most[0]) << UNIT_BITS])
        while len(bounds):
            floor = max(floor, _kth(scores, k))
            open_ = np.flatnonzero((bounds >= floor) & (bounds > 0))
            if len(open_) > BATCH:
                parts = np.argpartition(-bounds[open_], BATCH)
                open_, rest = open_[parts[:BATCH]], open_[parts[BATCH:]]
            else:
                rest = none
            below = heights[open_] - 1
            own = nodes[open_]
            masks = np.where(own >= 0, self.masks[own], 0)
            first = self.child[own]
            row_bits = rows >> below[:, None] & 1
            kept = [(nodes[rest], ranges[rest], heights[rest], bounds[rest])]
            for side in (0, 1):
                quadrant = row_bits * 2 + side
                child = np.where(masks >> quadrant & 1, first + _POPULATION[masks, quadrant], -1)
                place = ranges[open_] * 2 + side
                leaf = below == 0
                inner = ~leaf
                if leaf.any():
                    met = child[leaf]
                    tf = np.where(met >= 0, self.tf[np.maximum(met - len(self.masks), 0)], 0).astype(np.int64)
                    column = place[leaf]
                    score = impact(tf, self.norms[np.minimum(column, len(self.norms) - 1)][:, None]) @ weights
                    good = (score > 0) & (score >= floor)
                    columns, scores = np.concatenate([columns, column[good]]), np.concatenate([scores, score[good]])
                if inner.any():
                    met = child[inner]
                    bound = (np.where(met >= 0, self.most[met], 0).astype(np.int64) << UNIT_BITS) @ weights
                    kept.append((met, place[inner], below[inner], bound))
            nodes, ranges, heights, bounds = (np.concatenate(x) for x in zip(*kept))
        good = scores >= max(floor, _kth(scores, k))
        return columns[good], scores[good]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in batches:
        for _, _, raw, at in K.slices(batch.column(0), SLICE_BYTES):
            starts, _ = K.runs(raw, at, TERM)
            counts = K.row_counts(K.rows_of(starts, at), len(at) - 1)
            docs, terms = docs + int((counts > 0).sum()), terms + int(counts.sum())
    yield pa.record_batch({"docs": pa.array([docs]), "terms": pa.array([terms])})


_INDEX = ["block", "keys", "norms", "terms", "df", "height", "masks", "differences", "tf"]


def _index(kind: pa.DataType, n_docs: int, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 33, 0
        keys: list[pa.Array] = []
        hashes: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, held
            sizes = np.concatenate(counts)
            # Documents of like length share squares, and those without terms have none.
            order = np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes)]
            column = np.empty(len(sizes), np.int64)
            column[order] = np.arange(len(order))
            terms, number = np.unique(np.concatenate(hashes), return_inverse=True)
            cells, tf = np.unique(number * len(order) + np.repeat(column[sizes > 0], sizes[sizes > 0]), return_counts=True)
            number, column = np.divmod(cells, max(1, len(order)))
            df = np.bincount(number, minlength=len(terms))
            begin = np.cumsum(df) - df
            by_df = np.lexsort((column[begin], -df))
            row = np.empty(len(terms), np.int64)
            row[by_df] = np.arange(len(terms))
            norms = np.array([75 + 25 * n * n_docs // n_terms for n in sizes[order].tolist()], np.int64)
            height = max(1, (max(len(terms), len(order)) - 1).bit_length())
            masks, differences, leaves = build_treap(row[number], column, tf, norms, height)
            names = pa.concat_arrays(keys).take(pa.array(order))
            out = pa.RecordBatch.from_arrays([
                pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names.cast(kind)),
                pa.array([norms.tobytes()], pa.binary()), pa.array([terms[by_df].tobytes()], pa.binary()),
                pa.array([df[by_df].astype("<u4").tobytes()], pa.binary()), pa.array([height], pa.int32()),
                *(pa.array([x], pa.binary()) for x in (masks, differences, leaves))], _INDEX)
            block, held = block + 1, 0
            for x in (keys, hashes, counts):
                x.clear()
            return out

        for batch in batches:
            for first, end, raw, at in K.slices(batch.column(1), SLICE_BYTES):
                if held and held + len(raw) > BLOCK_BYTES:
                    yield flush()
                values, sizes = term_hashes(raw, at)
                if len(values):
                    held += len(raw)
                    keys.append(batch.column(0).slice(first, end - first))
                    hashes.append(values)
                    counts.append(sizes)
        if held:
            yield flush()

    return run


@dataclass(frozen=True)
class LexicalIndex:
    """Stored blocks, and the numbers of documents with a term and of all their terms."""

    blocks: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, keep, key: str = "doc_id", text: str = "text") -> LexicalIndex:
    """Index every document. ``keep(df, name)`` writes a table and reads it back.

    Terms are the maximal runs of letters, digits and characters beyond ASCII of the whole text, A-Z
    lower-cased. Null and empty texts and those without terms are in no block. Very long texts are a
    block of their own. Equal texts and repeated or null keys are each indexed. An empty table gives an
    index without blocks; other columns are not read.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType
    sums = source.select("text").mapInArrow(_count, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = sums[0] or 0, sums[1] or 0
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("keys", T.ArrayType(kind)), T.StructField("norms", T.BinaryType()),
        T.StructField("terms", T.BinaryType()), T.StructField("df", T.BinaryType()), T.StructField("height", T.IntegerType()),
        *(T.StructField(x, T.BinaryType()) for x in ("masks", "differences", "tf")),
    ])
    blocks = keep(source.mapInArrow(_index(to_arrow_type(kind), n_docs, n_terms), schema), "lexical-index")
    return LexicalIndex(blocks, n_docs, n_terms)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, raw, at in K.slices(batch.column(1), SLICE_BYTES):
            values, counts = term_hashes(raw, at)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            yield pa.record_batch({
                "row": batch.column(0).slice(first, end - first), "terms": pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64)))})


def _df_of(shared):
    """The documents of each block that hold the asked terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, total = shared.value, np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for terms, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms = np.frombuffer(terms, np.uint64)
                at = np.minimum(np.searchsorted(asked, terms), len(asked) - 1)
                met = asked[at] == terms
                total[at[met]] += np.frombuffer(df, "<u4")[met]
        some = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(asked[some].view(np.int64)), "df": pa.array(total[some])})

    return run


def _order(found: tuple) -> tuple:
    """Highest score first, then the key; rows without a key come last."""
    score, key = found
    return -score, key is None, key if key is not None else 0


def _search_blocks(shared, k: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        best: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            for i in range(batch.num_rows):
                value = {x: batch.column(x)[i] for x in _INDEX[1:]}
                terms = np.frombuffer(value["terms"].as_py(), np.uint64)
                by_hash = np.argsort(terms)
                treap = Treap(*(value[x].as_py() for x in ("masks", "differences", "tf")), np.frombuffer(value["norms"].as_py(), np.int64), value["height"].as_py())
                keys = value["keys"].values
                for n, (_, asked, weights) in enumerate(items):
                    at = by_hash[np.minimum(np.searchsorted(terms, asked, sorter=by_hash), len(terms) - 1)]
                    met = terms[at] == asked
                    if not met.any():
                        continue
                    floor = best[n][-1][0] if len(best[n]) == k else 1
                    columns, scores = treap.search(at[met], weights[met], k, floor)
                    if len(columns):
                        names = keys.take(pa.array(columns)).to_pylist()
                        best[n] = sorted(best[n] + list(zip(scores.tolist(), names)), key=_order)[:k]
        rows = [(items[n][0], key, score) for n, found in enumerate(best) for score, key in found]
        yield pa.record_batch({
            "row": pa.array([r[0] for r in rows], pa.int64()), "key": pa.array([r[1] for r in rows], kind),
            "score": pa.array([r[2] for r in rows], pa.int64())})

    return run


def search(index: LexicalIndex, items: DataFrame, keep, k: int = 20, item: str = "item_id", text: str = "text", key: str = "doc_id") -> DataFrame:
    """(item, rank, key, score): for each row of ``items`` its ``k`` documents of highest score above 0.

    The score is the sum, over the item's terms with repeats, of weight * impact: floor(1000 * ln((2 N + 2) /
    (2 df + 1))) times (10**9 tf) div (1000 tf + 12 m), with m = 75 + (25 n N) div L for a document of n
    terms. Equal scores rank by the key, rows without a key last. Items are sent to the blocks in turns of
    bounded size, so the table of items may grow. Null and empty items, and those without terms or without a
    document that shares one, have no rows; very long items go whole; repeated rows each get their ranks;
    empty tables give none. Other columns are not read.
    """
    spark = prepare(items.sparkSession)
    kind = index.blocks.schema["keys"].dataType.elementType
    named = keep(items.select(F.monotonically_increasing_id().alias("row"), F.col(item).alias("item"), F.col(text).alias("text")), "items")
    asked = keep(named.select("row", "text").mapInArrow(_item_terms, "row long, terms array<long>").filter("size(terms) > 0"), "item-terms")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    turns = max(1, -(-total // TURN_TERMS))
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("key", kind), T.StructField("score", T.LongType())])
    found = spark.createDataFrame([], schema)
    for turn in range(turns if total else 0):
        part = asked.filter(F.pmod(F.xxhash64("row"), F.lit(turns)) == turn).collect()  # a turn's items, bounded on average
        counted = [(r["row"], *np.unique(np.array(r["terms"], np.int64).view(np.uint64), return_counts=True)) for r in part]
        if not counted:
            continue
        wanted = np.unique(np.concatenate([x[1] for x in counted]))
        df = np.zeros(len(wanted), np.int64)
        sums = index.blocks.select("terms", "df").mapInArrow(_df_of(spark.sparkContext.broadcast(wanted)), "term long, df long")
        for r in sums.groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row per term of the turn
            df[np.searchsorted(wanted, np.uint64(r["term"] & (1 << 64) - 1))] = r["df"]
        weights = np.array([weight(index.n_docs, int(x)) for x in df], np.int64)
        sent = spark.sparkContext.broadcast([(row, terms, weights[np.searchsorted(wanted, terms)] * counts) for row, terms, counts in counted])
        own = index.blocks.mapInArrow(_search_blocks(sent, k, to_arrow_type(kind)), schema)
        found = found.unionByName(keep(own, "found"))
    place = F.pmod(F.xxhash64("key", "score"), F.lit(SALT))
    highest = [F.desc("score"), F.asc_nulls_last("key")]
    found = found.withColumn("part", place).withColumn("rank", F.row_number().over(Window.partitionBy("row", "part").orderBy(*highest)))
    found = found.filter(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*highest)))
    found = found.filter(F.col("rank") <= k)
    return named.select("row", "item").join(found, "row").select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
