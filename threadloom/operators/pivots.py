"""Exact nearest neighbours that leave out most products, by distances to a few pivot vectors.

The index keeps each vector with its distances to all pivots, one column each, and lies in the order
of (nearest pivot, distance to it). A vector x and a query q are at least |d(x, p) - d(q, p)| apart for
every pivot p. A query's k-th best score among the documents of its own pivot gives a radius, beyond
which no document can enter its result. Two things follow, and the result stays exact:

- A block of queries reads only documents whose pivot distances fall in the ranges that its radii
  span: plain comparisons of columns, with which the Parquet reader skips whole row groups.
- Inside a task, a batch of documents meets only the queries whose radius reaches the batch's own
  ranges. All others are excluded before any product is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom import constants as C
from threadloom.operators import retrieval as R
from threadloom.operators.rotation import Rotation
from threadloom.session import materialize, scratch_path

# Vectors among which the pivots are chosen, on average; any choice gives the same results.
SAMPLE_ROWS = 2_000
PIVOTS = 16
# Documents that meet the queries at a time; their ranges decide which queries do.
BATCH_DOCUMENTS = 512
# Distances are compared with this much room for rounding.
SLACK = 1e-6

_HIT = "query_id bigint, doc_id bigint, score double, compared bigint"


@dataclass(frozen=True)
class PivotIndex:
    """The stored documents, the pivots and the largest squared length of a document."""

    path: str
    documents: DataFrame
    pivots: np.ndarray
    largest: float


def _columns(n: int) -> list[str]:
    return [f"p{i}" for i in range(n)]


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (vectors ** 2).sum(axis=1)[:, None] + (pivots ** 2).sum(axis=1)[None, :] - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def _spread_out(vectors: np.ndarray, n: int) -> np.ndarray:
    """Vectors far from each other: each next one is the farthest from those before."""
    chosen = [0]
    nearest = _distances(vectors, vectors[:1])[:, 0]
    while len(chosen) < min(n, len(vectors)) and nearest.max() > SLACK:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(vectors, vectors[chosen[-1:]])[:, 0])
    return vectors[chosen]


def _placed(shared):
    """Each vector with its home (nearest pivot), its distance from there and from all pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = R._matrix(batch, pivots.shape[1])
            far = _distances(vectors, pivots)
            home = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["vector"], pa.array(home.astype(np.int32)), pa.array(far[np.arange(len(home)), home]),
                 pa.array((vectors ** 2).sum(axis=1)), *(pa.array(x) for x in far.T)],
                ["id", "vector", "home", "own", "square", *_columns(len(pivots))])

    return run


def _with_places(side: DataFrame, pivots: np.ndarray) -> DataFrame:
    shared = side.sparkSession.sparkContext.broadcast(pivots)
    extra = ", ".join(f"{x} double" for x in _columns(len(pivots)))
    kind = side.schema["vector"].dataType.simpleString()
    return side.select("id", "vector").mapInArrow(
        _placed(shared), f"id bigint, vector {kind}, home int, own double, square double, {extra}")


def build_pivot_index(documents: DataFrame, path: str | None = None, pivots: int = PIVOTS) -> PivotIndex:
    """Store ``(id, vector)`` rows for ``knn_pruned``; unique ids, vectors of one width without gaps.

    Pivots are chosen far from each other among about ``SAMPLE_ROWS`` rows picked by the hash of their id.
    """
    spark = documents.sparkSession
    path = path or scratch_path(spark, "pivot-index")
    rows = documents.count()
    picked = documents.where(F.pmod(F.xxhash64("id"), F.lit(max(1, rows // SAMPLE_ROWS))) == 0)
    sample = picked.toArrow()
    if rows and not sample.num_rows:
        sample = documents.limit(1).toArrow()
    chosen = _spread_out(R._matrix(sample)[np.argsort(R._ids(sample["id"]))], pivots) if rows else np.zeros((1, 1))
    placed = _with_places(documents, chosen)
    placed.repartitionByRange("home", "own", "id").sortWithinPartitions("home", "own", "id").write.mode("overwrite").parquet(f"{path}/documents")
    saved = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(chosen)], "pivot int, vector array<double>")
    saved.coalesce(1).write.mode("overwrite").parquet(f"{path}/pivots")
    return open_pivot_index(spark, path)


def open_pivot_index(spark: SparkSession, path: str) -> PivotIndex:
    """An index stored before."""
    saved = spark.read.parquet(f"{path}/pivots").orderBy("pivot").collect()  # a few rows, fixed by the index
    documents = spark.read.parquet(f"{path}/documents")
    largest = documents.agg(F.max("square")).first()[0] or 0.0
    return PivotIndex(path, documents, np.array([r["vector"] for r in saved]), largest)


def _blocks(placed: DataFrame, block_rows: int) -> Rotation:
    """Queries dealt by home: small homes share a block, large ones are split."""
    counts = {r["home"]: r["n"] for r in placed.groupBy("home").agg(F.count("*").alias("n")).collect()}  # a row per pivot
    first, parts, turn, room = {}, {}, -1, 0
    for home in sorted(counts):
        need = -(-counts[home] // block_rows)
        if need > 1 or counts[home] > room:
            first[home], parts[home] = turn + 1, need
            turn += need
            room = block_rows - counts[home] if need == 1 else 0
        else:
            first[home], parts[home] = turn, 1
            room -= counts[home]
    def lookup(values: dict):
        return F.create_map(*(F.lit(x) for x in chain.from_iterable(values.items())))[F.col("home")] if values else F.lit(1)
    block = lookup(first) + F.pmod(F.xxhash64("id"), lookup(parts))
    return Rotation(placed.drop("square", "own"), block_rows, sum(counts.values()), block, turn + 1)


class _Queries:
    """A few queries of a task: places, radii, and the best hits so far."""

    def __init__(self, ids, vectors, homes, far, radius, floor, k, exclude_self):
        self.homes, self.far, self.radius = homes, far, radius
        self.top = R._TopHits(ids, vectors, k, exclude_self)
        self.top.floor = floor.copy()
        self.compared = 0

    def meet(self, docs: np.ndarray, vectors: np.ndarray, alive: np.ndarray) -> None:
        """Score a few documents for the queries that are alive."""
        rows = np.flatnonzero(alive)
        if not len(rows):
            return
        self.compared += len(rows) * len(docs)
        part = R._TopHits(self.top.ids[rows], self.top.vectors[rows], self.top.k, self.top.exclude_self)
        part.floor = self.top.floor[rows]
        part.add(docs, vectors)
        if len(part.rows):
            self.top.merge(rows[part.rows], part.docs, part.scores)

    def batch(self) -> pa.RecordBatch:
        query, doc, score = self.top.hits()
        columns = [np.r_[query, 0], np.r_[doc, 0], np.r_[score, 0.0], np.r_[np.zeros(len(query), np.int64), self.compared]]
        # The last row says how many pairs were scored.
        names = pa.array(columns[0], mask=np.r_[np.zeros(len(query), bool), True])
        return pa.RecordBatch.from_arrays([names, *(pa.array(x) for x in columns[1:])], ["query_id", "doc_id", "score", "compared"])


def _few_at_a_time(ids, vectors, homes, far, radius, floor, k, exclude_self) -> list[_Queries]:
    """A turn's queries by home, so many together that what a task holds beside them does not grow with the turn."""
    order = np.argsort(homes, kind="stable")
    parts = [order[at:at + R.BLOCK_QUERIES] for at in range(0, len(order), R.BLOCK_QUERIES)]
    return [_Queries(*(x[rows] for x in (ids, vectors, homes, far, radius, floor)), k, exclude_self) for rows in parts]


def _search(shared, own_home: bool, n_pivots: int):
    names = _columns(n_pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, blocks = shared.value[1].shape[1], _few_at_a_time(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_DOCUMENTS):
                batch = whole.slice(at, BATCH_DOCUMENTS)
                docs, vectors = R._ids(batch["id"]), R._matrix(batch, width)
                homes = np.asarray(batch["home"])
                groups = [(home, homes == home) for home in np.unique(homes)]
                if own_home:
                    for queries in blocks:
                        for home, mine in groups:
                            queries.meet(docs[mine], vectors[mine], queries.homes == home)
                    continue
                far = np.stack([np.asarray(batch[x]) for x in names], axis=1)
                least, most = far.min(axis=0), far.max(axis=0)
                for queries in blocks:
                    apart = np.maximum(queries.far - most, least - queries.far).max(axis=1)
                    near = apart <= queries.radius + SLACK
                    for home, mine in groups:  # the documents of its own home have met a query before
                        queries.meet(docs[mine], vectors[mine], near & (queries.homes != home))
        for queries in blocks:
            yield queries.batch()

    return run


def knn_pruned(queries: DataFrame, index: PivotIndex, k: int = C.NEIGHBOUR_COUNT, *, exclude_self: bool = False, turn_rows: int | None = None) -> DataFrame:
    """Top ``k`` documents of every query, the same rows as ``knn_topk``: ``(query_id, rank, doc_id, score)``."""
    return knn_pruned_counted(queries, index, k, exclude_self=exclude_self, turn_rows=turn_rows)[0]


def knn_pruned_counted(
    queries: DataFrame, index: PivotIndex, k: int = C.NEIGHBOUR_COUNT, *, exclude_self: bool = False, turn_rows: int | None = None,
) -> tuple[DataFrame, int]:
    """The hits, and how many pairs of a query and a document were scored for them."""
    context = index.documents.sparkSession.sparkContext
    n = len(index.pivots)
    schema, compared = "query_id bigint, rank int, doc_id bigint, score double", 0
    if not index.documents.take(1):
        return index.documents.sparkSession.createDataFrame([], schema), 0
    placed = materialize(_with_places(queries, index.pivots))
    rotation = _blocks(placed, turn_rows or max(1, R.BROADCAST_VALUES // (index.pivots.shape[1] + n)))
    for block in rotation:
        ids, vectors = R._ids(block["id"]), R._matrix(block, index.pivots.shape[1])
        homes = np.asarray(block["home"])
        far = np.stack([np.asarray(block[x]) for x in _columns(n)], axis=1)
        parts = [ids, vectors, homes, far]
        # First the documents of the queries' own homes.
        none = np.full(len(ids), np.inf)
        sent = context.broadcast([*parts, none, -none, k, exclude_self])
        near = index.documents.where(F.col("home").isin([int(x) for x in np.unique(homes)]))
        first = materialize(near.mapInArrow(_search(sent, True, n), _HIT))
        floor = np.full(len(ids), -np.inf)
        places = {int(x): i for i, x in enumerate(ids)}
        kth = R._rank(first.where("query_id is not null"), k).where(F.col("rank") == k)
        for r in kth.select("query_id", "score").toLocalIterator():  # at most a row per query of the block
            floor[places[r["query_id"]]] = r["score"]
        # A document that scores at least the floor is not farther than this.
        squares = (vectors ** 2).sum(axis=1)
        radius = np.sqrt(np.maximum(squares + index.largest - 2 * (floor - R.SCORE_UNIT), 0))
        sent = context.broadcast([*parts, radius, floor, k, exclude_self])
        ranges = [
            F.col(x).between(float((far[:, i] - radius).min() - SLACK), float((far[:, i] + radius).max() + SLACK))
            for i, x in enumerate(_columns(n)) if np.isfinite(radius).all()
        ]
        others = index.documents.where(reduce(and_, ranges)) if ranges else index.documents
        second = materialize(others.mapInArrow(_search(sent, False, n), _HIT))
        found = first.unionByName(second)
        compared += found.agg(F.sum("compared")).first()[0] or 0
        rotation.keep(R._rank(found.where("query_id is not null"), k))
    return rotation.result(schema), compared
