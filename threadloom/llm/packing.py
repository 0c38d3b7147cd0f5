"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Hierarchical residual packing: every task packs the pieces it has tokenised by best fit, in blocks
of bounded size. Bins that are nearly full are final. The others become items of one size: they are
dealt into groups of bounded size, each group is packed by best fit again, nearly full results leave,
and the rest goes up the tree into fewer groups, until one group is left or a round neither closes
nor joins any bin.
Token ids are written once, beside their bin; the tree moves (bin, fill) rows only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from threadloom.llm import kernels as K
from threadloom.llm.common import materialize, prepare, stored
from threadloom.llm.tokens import encode_column

# Tokens that a task packs at once.
BLOCK_TOKENS = 2_000_000
# Bins that one task of the tree packs at once.
GROUP_ITEMS = 50_000
# A bin with less room than capacity / SLACK is nearly full.
SLACK = 128


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, largest item first: bin of each item, its place there, and the fill of each bin.

    The open bins are kept by free room; the set of occurring rooms is one integer of bits, so the
    tightest room for an item is the lowest set bit at or above its size.
    """
    bins, places = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills = 0, []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            target = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, target = capacity, len(fills)
            fills.append(0)
        bins[item], places[item] = target, fills[target]
        fills[target] += size
        left = room - size
        if left:
            by_room[left].append(target)
            rooms |= 1 << left
    return bins, places, np.array(fills, np.int64)


def _pieces(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number, start and length of each piece; of a long document the first may be shorter."""
    pieces = -(-counts // capacity)
    row = np.repeat(np.arange(len(counts)), pieces)
    number = K.spread(np.zeros(len(counts), np.int64), pieces)
    first = counts - (pieces - 1) * capacity
    start = np.where(number == 0, 0, first[row] + (number - 1) * capacity)
    length = np.where(number == 0, first[row], capacity)
    return row, number, start, length


def _pack_partition(path: str, end_id: int, capacity: int, id_type: pa.DataType):
    slack = capacity // SLACK

    def emit(block: list[tuple], task: int, made: int) -> tuple[list[pa.RecordBatch], int]:
        ids = np.concatenate([b[0] for b in block])
        keys = pa.concat_arrays([b[1] for b in block])
        row, number, start, length = (np.concatenate([b[i] for b in block]) for i in (2, 3, 4, 5))
        bins, places, fills = best_fit(length, capacity)
        names = task * (1 << 33) + made + bins
        begin = np.cumsum(length) - length  # pieces are in the order of the ids
        batches = []
        for a in range(0, len(length), 2000):
            z = min(a + 2000, len(length))
            some = ids[begin[a] : begin[z - 1] + length[z - 1]]
            batches.append(pa.record_batch({
                "doc_id": keys.slice(a, z - a), "piece": pa.array(number[a:z].astype(np.int32)),
                "start": pa.array(start[a:z]), "length": pa.array(length[a:z]),
                "ids": K.binary_column(some, length[a:z]), "bin": pa.array(names[a:z]),
                "place": pa.array(places[a:z]), "fill": pa.array(fills[bins[a:z]]),
                "open": pa.array(fills[bins[a:z]] < capacity - slack),
            }))
        return batches, made + len(fills)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, block, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            keys = batch.column(0)
            for first, end, ids, counts in encode_column(batch.column(1), path, end_id):
                row, number, start, length = _pieces(counts, capacity)
                own = keys.slice(first, end - first).take(pa.array(row)).cast(id_type)
                block.append((ids, own, row, number, start, length))
                held += len(ids)
                if held >= BLOCK_TOKENS:
                    out, made = emit(block, task, made)
                    yield from out
                    block, held = [], 0
        if block:
            yield from emit(block, task, made)[0]

    return run


def _merge(capacity: int):
    slack = capacity // SLACK

    def run(table: pa.Table) -> pa.Table:
        fills = table["fill"].to_numpy()
        bins, places, total = best_fit(fills, capacity)
        order = np.lexsort((places, bins))
        names, bases = table["bins"].combine_chunks(), table["bases"].combine_chunks()
        counts = np.diff(names.offsets.to_numpy())[order]
        offsets = np.zeros(len(total) + 1, np.int32)
        np.cumsum(np.bincount(bins[order], weights=counts, minlength=len(total)), out=offsets[1:])
        names, bases = names.take(pa.array(order)), bases.take(pa.array(order))
        moved = bases.flatten().to_numpy() + np.repeat(places[order], counts)
        return pa.table({
            "bins": pa.ListArray.from_arrays(pa.array(offsets), names.flatten()),
            "bases": pa.ListArray.from_arrays(pa.array(offsets), pa.array(moved)),
            "fill": pa.array(total), "open": pa.array(total < capacity - slack),
        })

    return run


_ITEMS = "bins array<bigint>, bases array<bigint>, fill bigint, open boolean"


def merge_bins(items: DataFrame, capacity: int) -> DataFrame:
    """Pack underfull bins (``bin``, ``fill``) as items, round by round, up the tree.

    Returns (bin, sequence_id, base) for the bins that share a sequence with another one.
    """
    left = materialize(items.select(
        F.array("bin").alias("bins"), F.array(F.lit(0).cast("bigint")).alias("bases"), "fill", F.lit(True).alias("open")
    ))
    n, level, done = left.count(), 0, []
    while n > 1:
        groups = -(-n // GROUP_ITEMS)
        dealt = left.withColumn("group", F.pmod(F.xxhash64(F.col("bins")[0], F.lit(level)), F.lit(groups)))
        packed = materialize(
            dealt.groupBy("group").applyInArrow(_merge(capacity), _ITEMS)
        )
        left, rest = packed.filter("open"), packed.filter("open").count()
        if groups == 1 or rest == n:
            done.append(packed)
            break
        done.append(packed.filter("not open"))
        n, level = rest, level + 1
    else:
        done.append(left)
    merged = done[0]
    for more in done[1:]:
        merged = merged.unionByName(more)
    return merged.filter(F.size("bins") > 1).select(
        F.col("bins")[0].alias("sequence_id"), F.explode(F.arrays_zip("bins", "bases")).alias("member")
    ).select(F.col("member.bins").alias("bin"), "sequence_id", F.col("member.bases").alias("base"))


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    A document is the ids of its text, then ``end_id``; a null or empty text is the end id alone.
    Longer documents are cut into pieces of ``capacity`` tokens, of which the first may be shorter.
    Returns a row per piece: doc_id, piece, start (ids before it in its document), length, ids
    (little-endian unsigned 32-bit numbers), sequence_id (any number) and offset (place in the
    sequence, without gaps). Rows with equal or null ids are packed like any others; an empty table
    gives no rows; other columns are not read. ``tokenizer`` is a path that the executors can open.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
        *(T.StructField(x, T.LongType()) for x in ("start", "length")), T.StructField("ids", T.BinaryType()),
        *(T.StructField(x, T.LongType()) for x in ("bin", "place", "fill")), T.StructField("open", T.BooleanType()),
    ])
    from pyspark.sql.pandas.types import to_arrow_type

    run = _pack_partition(tokenizer, end_id, capacity, to_arrow_type(source.schema["doc_id"].dataType))
    rows = stored(source.mapInArrow(run, schema), "pieces")
    open_bins = rows.filter("open and place = 0").select("bin", "fill")
    moved = materialize(merge_bins(open_bins, capacity))
    columns = ["doc_id", "piece", "start", "length", "ids"]
    full = rows.filter("not open").select(*columns, F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
    rest = rows.filter("open").join(moved, "bin", "left").select(
        *columns, F.coalesce("sequence_id", "bin").alias("sequence_id"),
        (F.col("place") + F.coalesce("base", F.lit(0))).alias("offset"),
    )
    return full.unionByName(rest)
