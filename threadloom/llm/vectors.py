"""Near-duplicate vectors by an inverted multi-index.

Each half of the unit vectors has its own codebook; a vector lies in the cell of its two nearest
centroids. A query visits cells in the order of the multi-sequence algorithm (rising sum of the two
distances) until the share of neighbours expected in the visited cells reaches the target recall,
and every vector there is compared exactly. Codebooks and the number of visited cells are fitted on
a bounded sample; every vector is indexed and every vector is a query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from threadloom.llm.common import low_hash, materialize, prepare
from threadloom.llm.components import components

# Bounds of the sample that codebooks are fitted on.
SAMPLE_ROWS = 20_000
SAMPLE_NUMBERS = 4_000_000
# Vectors of a label in a cell, on average, and centroids per half at most.
CELL_ROWS = 256
MOST_CENTROIDS = 256
TARGET_RECALL = 0.999
# Rows in one side of a block.
BLOCK = 1024


@dataclass
class MultiIndex:
    left: np.ndarray
    right: np.ndarray
    visits: int

    def order(self, unit: np.ndarray, visits: int) -> np.ndarray:
        """The first cells of the multi-sequence traversal for each vector.

        A cell of ranks (i, j) follows at least (i + 1)(j + 1) - 1 others, so only pairs of ranks
        with a product up to ``visits`` can be among the first ones.
        """
        half = self.left.shape[1]
        a, b = _distances(unit[:, :half], self.left), _distances(unit[:, half:], self.right)
        rank_a, rank_b = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        i, j = np.divmod(np.arange(a.shape[1] * b.shape[1]), b.shape[1])
        able = (i + 1) * (j + 1) <= visits
        i, j = i[able], j[able]
        total = np.take_along_axis(a, rank_a, 1)[:, i] + np.take_along_axis(b, rank_b, 1)[:, j]
        first = np.argsort(total, axis=1, kind="stable")[:, :visits]
        cells = rank_a[:, i] * b.shape[1] + rank_b[:, j]
        return np.take_along_axis(cells, first, 1)


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(12):
        near = _distances(x, centroids).argmin(1)
        for c in range(len(centroids)):
            if (own := x[near == c]).size:
                centroids[c] = own.mean(0)
    return centroids


def fit(sample: np.ndarray, centroids: int, least: float, recall: float = TARGET_RECALL) -> MultiIndex:
    """Codebooks from unit vectors; then the number of cells that a query must visit, so that a
    neighbour at exactly the least cosine, in a random direction, is in one of them with the target
    recall. Neighbours that are nearer are found more often."""
    rng = np.random.default_rng(11)
    half = sample.shape[1] // 2
    left, right = _codebook(sample[:, :half], centroids, rng), _codebook(sample[:, half:], centroids, rng)
    index = MultiIndex(left, right, len(left) * len(right))
    asked = sample[rng.choice(len(sample), min(2000, len(sample)), replace=False)]
    step = rng.normal(size=asked.shape)
    step -= (step * asked).sum(1)[:, None] * asked
    norm = np.sqrt((step * step).sum(1))[:, None]
    near = least * asked + np.sqrt(1 - least * least) * step / np.maximum(norm, 1e-12)
    own = index.order(near, 1)[:, :1]
    place = (index.order(asked, index.visits) == own).argmax(1)
    return MultiIndex(left, right, int(np.quantile(place, recall, method="higher")) + 1)


def unit_rows(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision of a list column without nulls and of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)
    # Scaling by the largest component first keeps the squares in range.
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _link(least: float):

    def run(table: pa.Table) -> pa.Table:
        query = table["query"].to_numpy(zero_copy_only=False)
        node, copies, cell = table["node"], table["copies"].to_numpy(), table["own_cell"].to_numpy()
        unit = unit_rows(table["vector"].combine_chunks())
        here = int(table["cell"][0].as_py())
        q, x = np.flatnonzero(query), np.flatnonzero(~query)
        links = np.zeros(len(query), np.int64)
        edges: list[tuple[int, int]] = []
        if len(q) and len(x):
            linked = unit[q] @ unit[x].T >= least
            same = cell[q] == here
            names = node.combine_chunks().to_numpy(zero_copy_only=False)
            linked &= names[q][:, None] != names[x]
            # A pair whose other end visits back is met twice: it counts in the larger cell only.
            lists = table["visits"].combine_chunks()
            visits = np.stack([lists[int(i)].values.to_numpy() for i in x])
            back = np.zeros((len(q), len(x)), bool)
            for c in np.unique(cell[q]):
                back[cell[q] == c] = (visits == c).any(1)
            counted = linked & ((~back) | (cell[q] > here)[:, None] | same[:, None])
            links[q] += counted @ copies[x]
            links[x] += np.where(same[:, None], False, counted).T @ copies[q]
            label = np.arange(len(query))
            for row, at in enumerate(q.tolist()):
                partners = x[linked[row]]
                while len(apart := partners[label[partners] != label[at]]):
                    edges.append((at, int(apart[0])))
                    label[label == label[apart[0]]] = label[at]
        some = np.flatnonzero(links)
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        none = pa.nulls(len(some), node.type)
        return pa.table({
            "node": pa.concat_arrays([node.combine_chunks().take(pa.array(some)), node.combine_chunks().take(pa.array(a))]),
            "links": pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)])),
            "to": pa.concat_arrays([none, node.combine_chunks().take(pa.array(b))]),
        })

    return run


def near_vectors(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.93,
    cell_rows: int = CELL_ROWS, recall: float = TARGET_RECALL,
) -> DataFrame:
    """A row per vector: the key, n_links, component_id and kept (the smallest key of its component).

    Vectors link when their labels are equal and not null, they have equally many components, and
    their cosine in double precision is ``least`` or more. Vectors that are null, empty, zero or hold
    null or non-finite components, and rows without a key, link with nothing. Equal vectors are one
    class and count as links of each other. Rows that repeat a key are kept. An empty table gives no
    rows; other columns are not read.
    """
    spark = prepare(rows.sparkSession)
    source = rows.select(F.col(key).alias("node"), F.col(vector).alias("vector"), F.col(label).cast("string").alias("label"))
    kind = source.schema["node"].dataType
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = (
        F.col("node").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite
        & F.exists("vector", lambda v: v != 0)
    )
    marked = source.withColumn("ok", F.coalesce(usable, F.lit(False))).withColumns({
        "label": F.concat_ws("/", "label", F.size("vector").cast("string")),
        "sig": F.when(F.col("ok"), F.xxhash64("vector")), "sig2": F.when(F.col("ok"), F.hash("vector"))})
    same = ["label", "sig", "sig2"]
    names = materialize(marked.select("node", "ok", *same))
    classes = materialize(names.filter("ok").groupBy(*same).agg(F.min("node").alias("first"), F.count("*").alias("copies")))
    chosen = marked.filter("ok").join(classes, same).filter("node = first").dropDuplicates(same)
    chosen = materialize(chosen.select("node", "vector", "label", "copies"))
    found = None
    for dims in [r["d"] for r in chosen.select(F.size("vector").alias("d")).distinct().collect()]:  # lengths that occur
        own = chosen.filter(F.size("vector") == dims)
        part = _links_of(own, dims, least, cell_rows, recall, kind)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = chosen.select("node", F.lit(0).cast("bigint").alias("links"), F.col("node").alias("to")).limit(0)
    found = materialize(found)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.filter("to is not null").select(F.col("node").alias("a"), F.col("to").alias("b")))
    known = classes.withColumnRenamed("first", "node").join(counts, "node", "left").join(groups, "node", "left")
    known = known.select(*same, F.coalesce("links", F.lit(0)).alias("links"), "copies", F.coalesce("component", "node").alias("component"))
    joined = names.join(known, same, "left")
    linked = F.coalesce(F.when(F.col("ok"), F.col("links") + F.col("copies") - 1), F.lit(0).cast("bigint"))
    component = F.coalesce(F.when(F.col("ok"), F.col("component")), F.col("node"))
    return joined.select(
        F.col("node").alias(key), linked.alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("node") == component, F.lit(False)).alias("kept"))


def _links_of(chosen: DataFrame, dims: int, least: float, cell_rows: int, recall: float, kind: T.DataType) -> DataFrame:
    spark = chosen.sparkSession
    size = chosen.agg(F.count("*").alias("n"), F.count_distinct("label").alias("labels")).first()
    sample_rows = min(SAMPLE_ROWS, max(1, SAMPLE_NUMBERS // dims))
    order = F.xxhash64("node", F.lit(5))
    sample = chosen.filter(low_hash(order, sample_rows, size["n"])).orderBy(order).select("vector").limit(sample_rows).toArrow()["vector"].combine_chunks()
    per_half = int(np.clip(round((size["n"] / size["labels"] / cell_rows) ** 0.5), 1, MOST_CENTROIDS)) if dims > 1 else 1
    shared = spark.sparkContext.broadcast(fit(unit_rows(sample), per_half, least, recall))

    def traverse(column: pa.Array) -> pa.Array:
        index = shared.value
        cells = index.order(unit_rows(column), index.visits).astype(np.int32)
        flat = pa.array(cells.reshape(-1))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1, dtype=np.int32) * index.visits), flat)

    placed = materialize(chosen.withColumn("visits", F.arrow_udf(traverse, "array<int>")("vector")))
    placed = placed.withColumn("own_cell", F.col("visits")[0])
    visiting = placed.select("*", F.explode("visits").alias("cell"))
    # Sizes of both sides of every cell, for blocks.
    sizes = visiting.select("label", "cell", (F.col("cell") == F.col("own_cell")).cast("int").alias("own")).groupBy("label", "cell").agg(
        F.ceil(F.sum("own") / BLOCK).cast("int").alias("x_blocks"), F.ceil(F.count("*") / BLOCK).cast("int").alias("q_blocks"),
    ).filter("x_blocks > 0")
    sized = visiting.join(sizes, ["label", "cell"])
    i = F.pmod(F.xxhash64("node", F.lit(1)), F.col("q_blocks")).cast("int")
    j = F.pmod(F.xxhash64("node", F.lit(2)), F.col("x_blocks")).cast("int")
    as_query = F.transform(F.sequence(F.lit(0), F.col("x_blocks") - 1), lambda b: F.struct(i.alias("i"), b.alias("j"), F.lit(True).alias("query")))
    as_index = F.when(F.col("cell") == F.col("own_cell"), F.transform(
        F.sequence(F.lit(0), F.col("q_blocks") - 1), lambda b: F.struct(b.alias("i"), j.alias("j"), F.lit(False).alias("query"))))
    places = F.explode(F.concat(as_query, F.coalesce(as_index, F.array().cast("array<struct<i:int,j:int,query:boolean>>"))))
    blocks = sized.select("node", "vector", "label", "copies", "visits", "own_cell", "cell", places.alias("place")).select(
        "node", "vector", "label", "copies", "visits", "own_cell", "cell", "place.i", "place.j", "place.query")
    schema = T.StructType([T.StructField("node", kind), T.StructField("links", T.LongType()), T.StructField("to", kind)])
    return blocks.groupBy("label", "cell", "i", "j").applyInArrow(_link(least), schema)
