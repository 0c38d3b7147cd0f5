"""Exact nearest neighbours by inner product, and what is built on them.

A query block of checked size goes to every partition of the document table; documents are then
never shuffled. The other way round when only the documents are few. When both sides are large, the
queries go in blocks of that size, one after the other (``threadloom.operators.rotation``), and
documents still stay where they are. Tasks score blocks with a matrix product and send on only their
best ``k`` per query, never all pairs. ``threadloom.operators.pivots`` leaves out most products.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from threadloom import constants as C
from threadloom.functions.text import decimals
from threadloom.functions.vectors import l2_normalize
from threadloom.session import materialize, materialize_counted

# Values (rows x dimensions) a side may have to be sent to every executor: 32 MiB of doubles.
BROADCAST_VALUES = 4_194_304
# A task scores blocks of this shape.
BLOCK_QUERIES = 1_024
BLOCK_DOCUMENTS = 4_096
# Documents scored at once inside a block: at first as many as were scored before, so that few reach the floors.
LEAST_STEP, MOST_STEP = 64, 512
# Hits (four numbers each) that may be broadcast.
BROADCAST_HITS = 100_000
# Scores are compared at this precision, so that equal vectors tie and the smaller id wins.
SCORE_DIGITS = 9
SCORE_UNIT = 10.0 ** -SCORE_DIGITS
LOWEST = np.finfo(np.float64).min

_HIT = "query_id bigint, doc_id bigint, score double"


def _matrix(rows: pa.Table | pa.RecordBatch, width: int | None = None) -> np.ndarray:
    """The vectors as a matrix. A missing vector or number, or another width, stops the search: a
    silently skipped or shifted row would be a wrong result."""
    vectors = rows["vector"]
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(np.asarray(vectors.offsets)) if len(vectors) else np.empty(0, np.int64)
    width = width if width is not None or not len(sizes) else int(sizes[0])
    flat = vectors.flatten()
    numbers = np.asarray(flat.cast(pa.float64()).fill_null(np.nan), dtype=np.float64)
    bad = np.asarray(vectors.is_null()) | (sizes != (width or 0))
    if not bad.any() and np.isnan(numbers).any():
        bad = np.isnan(numbers.reshape(len(vectors), -1)).any(axis=1)
    if bad.any():
        raise ValueError(f"vectors with missing numbers or of another width than {width}: ids {_ids(rows['id'])[bad][:10].tolist()}")
    return numbers.reshape(len(vectors), -1)


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column, dtype=np.int64)


def _best(query: np.ndarray, doc: np.ndarray, score: np.ndarray, k: int):
    """Best ``k`` hits per query: highest score, then smallest document id."""
    order = np.lexsort((doc, -score, query))
    query, doc, score = query[order], doc[order], score[order]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(query)])
    place = np.arange(len(query)) - np.repeat(starts, sizes)
    keep = place < k
    return query[keep], doc[keep], score[keep]


class _TopHits:
    """Running best hits of a few queries while document blocks pass by."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, exclude_self: bool):
        self.ids, self.vectors, self.k, self.exclude_self = ids, vectors, k, exclude_self
        self.rows = np.empty(0, np.int64)
        self.docs = np.empty(0, np.int64)
        self.scores = np.empty(0, np.float64)
        self.floor = np.full(len(ids), -np.inf)
        self.seen = 0

    def add(self, docs: np.ndarray, vectors: np.ndarray) -> None:
        at = 0
        while at < len(docs):
            step = slice(at, at + min(max(self.seen, LEAST_STEP, self.k), MOST_STEP))
            self._score(docs[step], vectors[step])
            self.seen += len(docs[step])
            at = step.stop

    def _score(self, docs: np.ndarray, vectors: np.ndarray) -> None:
        scores = self.vectors @ vectors.T
        if self.exclude_self:
            scores[self.ids[:, None] == docs[None, :]] = -np.inf
        # Rounding can lift a score by half a unit, so the test is one unit generous.
        row, col = np.divmod(np.flatnonzero(scores >= np.maximum(self.floor - SCORE_UNIT, LOWEST)[:, None]), len(docs))
        if len(row) > 4 * self.k * len(self.ids) and len(docs) > self.k:
            kth = np.partition(scores, -self.k, axis=1)[:, -self.k]
            row, col = np.nonzero(scores >= np.maximum(kth - SCORE_UNIT, LOWEST)[:, None])
        if not len(row):
            return
        self.merge(row, docs[col], np.round(scores[row, col], SCORE_DIGITS))

    def merge(self, row: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        """Take in hits of the query at each row."""
        self.rows, self.docs, self.scores = _best(np.r_[self.rows, row], np.r_[self.docs, docs], np.r_[self.scores, scores], self.k)
        counts = np.bincount(self.rows, minlength=len(self.ids))
        last = np.cumsum(counts) - 1
        full = counts == self.k
        self.floor[full] = np.maximum(self.floor[full], self.scores[last[full]])

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.ids[self.rows], self.docs, self.scores


class _QueryBlocks:
    """All queries of a task in blocks, so that a score matrix stays small."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, exclude_self: bool):
        self.blocks = [
            _TopHits(ids[at:at + BLOCK_QUERIES], vectors[at:at + BLOCK_QUERIES], k, exclude_self)
            for at in range(0, len(ids), BLOCK_QUERIES)
        ]

    def add(self, docs: np.ndarray, vectors: np.ndarray) -> None:
        for at in range(0, len(docs), BLOCK_DOCUMENTS):
            for block in self.blocks:
                block.add(docs[at:at + BLOCK_DOCUMENTS], vectors[at:at + BLOCK_DOCUMENTS])

    def batches(self) -> Iterator[pa.RecordBatch]:
        for block in self.blocks:
            yield _as_batch(*block.hits())


def _as_batch(query: np.ndarray, doc: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query), pa.array(doc), pa.array(score)], ["query_id", "doc_id", "score"])


def _rank(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "doc_id", "score")


def _extent(side: DataFrame) -> tuple[int, int]:
    """Rows and the width of the widest vector."""
    found = side.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    return found["n"], max(1, found["width"] or 1)


def _small_block(side: DataFrame, extent: tuple[int, int]) -> tuple[np.ndarray, np.ndarray] | None:
    """The whole side when all its values fit the bound, else None."""
    rows, width = extent
    if rows * width > BROADCAST_VALUES:
        return None
    if not rows:
        return np.empty(0, np.int64), np.empty((0, 1))
    table = side.toArrow()
    return _ids(table["id"]), _matrix(table)


def _queries_to_documents(block, documents: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(block)
    width = block[1].shape[1] if len(block[0]) else None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = _QueryBlocks(*shared.value, k, exclude_self)
        for batch in batches:
            if batch.num_rows:
                top.add(_ids(batch["id"]), _matrix(batch, width))
        yield from top.batches()

    return documents.mapInArrow(score, _HIT)


def _documents_to_queries(block, queries: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    shared = queries.sparkSession.sparkContext.broadcast(block)
    width = block[1].shape[1] if len(block[0]) else None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                top = _QueryBlocks(_ids(batch["id"]), _matrix(batch, width), k, exclude_self)
                if width is not None:
                    top.add(*shared.value)
                yield from top.batches()

    return queries.mapInArrow(score, _HIT)


def _in_turns(queries: DataFrame, documents: DataFrame, k: int, exclude_self: bool, extent: tuple[int, int], turn_rows: int | None) -> DataFrame:
    """One block of queries after the other meets all documents; the ranked hits of all turns."""
    from threadloom.operators.rotation import Rotation

    rows, width = extent
    rotation = Rotation(queries, turn_rows or max(1, BROADCAST_VALUES // width), rows)
    if rotation.turns > 1:
        documents = materialize(documents)  # else each turn would compute them anew
    for block in rotation:
        hits = _queries_to_documents((_ids(block["id"]), _matrix(block)), documents, k, exclude_self)
        rotation.keep(_rank(hits, k))
    return rotation.result("query_id bigint, rank int, doc_id bigint, score double")


def knn_topk(
    queries: DataFrame,
    documents: DataFrame,
    k: int = C.NEIGHBOUR_COUNT,
    *,
    exclude_self: bool = False,
    way: str = "auto",
    turn_rows: int | None = None,
) -> DataFrame:
    """Top ``k`` documents of every query: ``(query_id, rank, doc_id, score)``.

    Both sides are ``(id BIGINT, vector ARRAY)`` with unit vectors and unique ids. ``exclude_self``
    skips the document whose id equals the query's. ``way`` is ``auto``, ``broadcast`` or ``turns``;
    ``turn_rows`` are the queries of a turn (what may be broadcast, if not given).
    Vectors of different widths, or with missing numbers, are an error that names the ids.
    """
    extent = _extent(queries)
    if way != "turns":
        block = _small_block(queries, extent)
        if block is not None:
            return _rank(_queries_to_documents(block, documents, k, exclude_self), k)
        block = _small_block(documents, _extent(documents))
        if block is not None:
            return _rank(_documents_to_queries(block, queries, k, exclude_self), k)
        if way == "broadcast":
            raise ValueError("neither side is small enough to broadcast")
    return _in_turns(queries, documents, k, exclude_self, extent, turn_rows)


def vector_side(df: DataFrame, key: str, vector: str, normalize: bool = True) -> DataFrame:
    """Bring a table into the shape the search takes. A row without a vector cannot be found and is
    left out here; a vector with missing numbers stays and makes the search fail."""
    values = l2_normalize(F.col(vector)) if normalize else F.col(vector)
    return df.where(F.col(vector).isNotNull()).select(F.col(key).cast("bigint").alias("id"), values.alias("vector"))


def retrieval_corpus(pairs: DataFrame, vectors: DataFrame, key: str = "thread_id") -> DataFrame:
    """Pairs with the unit vector of their question; repeated questions stay."""
    return pairs.join(vectors, key).withColumn("embedding", l2_normalize(F.col("embedding")))


def with_documents(
    hits: DataFrame, corpus: DataFrame, key: str = "thread_id", columns: Sequence[str] = ("customer_query", "brand_response"),
    broadcast_hits: int = BROADCAST_HITS,
) -> DataFrame:
    """Hits with ``columns`` of their documents. Stored first: the search then runs once, and few hits
    go to the texts instead of shuffling those. Many hits are shuffled by document; a corpus of
    :func:`threadloom.sources.tables.read_vectors` in buckets of ``key`` still stays where it is."""
    hits, counts = materialize_counted(hits)
    if counts["rows"] <= broadcast_hits:
        hits = F.broadcast(hits)
    texts = corpus.select(F.col(key).alias("doc_id"), *columns)
    return texts.join(hits, "doc_id")


def neighbours_nested(hits: DataFrame) -> DataFrame:
    """One row per query with its (at most ``k``) neighbours in rank order."""
    entry = F.struct(
        "rank", F.col("customer_query").alias("query"), F.col("brand_response").alias("response"), "score"
    )
    grouped = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(entry)).alias("ranked"))
    plain = F.transform("ranked", lambda x: F.struct(x["query"], x["response"], x["score"]))
    names = "array<struct<query: string, response: string, score: double>>"
    return grouped.select("query_id", plain.cast(names).alias("similar_threads"))


def retrieval_context(nested: DataFrame, n: int = C.NEIGHBOUR_COUNT) -> DataFrame:
    """Neighbours as the text block of a reply prompt."""
    def example(entry, i):
        head = F.concat(F.lit("Example "), (i + 1).cast("string"), F.lit(" (similarity: "), decimals(entry["score"], 2))
        return F.concat(
            head, F.lit("):\n  Customer: "), entry["query"], F.lit("\n  Brand response: "), entry["response"]
        )

    parts = F.transform(F.slice("similar_threads", 1, n), example)
    return nested.withColumn("context", F.array_join(parts, "\n\n"))


def leak_rate(hits: DataFrame) -> DataFrame:
    """Share of queries that find their own thread among their neighbours."""
    own = hits.groupBy("query_id").agg(F.max((F.col("query_id") == F.col("doc_id")).cast("int")).alias("leaked"))
    return own.agg(F.count("*").alias("n_queries"), F.sum("leaked").alias("n_leaked"),
                   F.round(F.avg("leaked"), 4).alias("leak_rate"))


def word_counts(df: DataFrame, key: str, text: str, dimensions: int) -> DataFrame:
    """``(key, counts)``: bucket and number of a text's words, a row per row. Words are lower-case runs of
    letters and digits; a word's bucket is the first 32 bits of its md5, modulo ``dimensions``. Words
    are counted per row and bucket inside the map tasks, so a row and at most its buckets move."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    numbered = df.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), words.alias("words"))
    rows = numbered.select("key", "row", F.explode("words").alias("word"))
    bucket = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint") % dimensions
    counted = rows.groupBy("row", "key", F.when(F.col("word") != "", bucket.cast("int")).alias("bucket")).agg(F.count("*").alias("n"))
    entry = F.when(F.col("bucket").isNotNull(), F.struct("bucket", "n"))
    return counted.groupBy("row", "key").agg(F.collect_list(entry).alias("counts")).select(F.col("key").alias(key), "counts")


def text_vectors(df: DataFrame, key: str, text: str = "text", dimensions: int = 256) -> DataFrame:
    """``(key, embedding)``: hashed word counts times ln((rows + 1) / (rows with the bucket + 1)), unit length;
    a text without words is zero. The built-in stand-in for a sentence encoder. The counts are stored
    between the two passes, so texts are read once, and one number per dimension reaches the driver."""
    counts, seen = materialize_counted(word_counts(df, key, text, dimensions))
    by_bucket = counts.select(F.explode("counts.bucket").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    held = {r["bucket"]: r["n"] for r in by_bucket.collect()}  # at most a row per dimension
    scale = np.array([math.log((seen["rows"] + 1) / (held.get(i, 0) + 1)) for i in range(dimensions)])

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["counts"]
            entries = lists.flatten()
            row = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
            bucket, n = (np.asarray(entries.field(x)) for x in ("bucket", "n"))
            vectors = np.zeros((len(lists), dimensions))
            vectors[row, bucket] = n * scale[bucket]
            length = np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))
            vectors /= np.where(length > 0, length, 1)
            offsets = pa.array(np.arange(len(lists) + 1) * dimensions, pa.int32())
            yield pa.RecordBatch.from_arrays([batch[key], pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()))], [key, "embedding"])

    kind = counts.schema[key].dataType
    return counts.mapInArrow(dense, T.StructType([T.StructField(key, kind), T.StructField("embedding", T.ArrayType(T.DoubleType()))]))


def attach_vectors(df: DataFrame, encoder, schema: str) -> DataFrame:
    """Run a user's encoder (``mapInPandas`` function) over the table."""
    return df.mapInPandas(encoder, schema)
