"""Token ids in files of a byte-aligned variable-length coding, and back.

Ids are replaced by their rank of frequency, so that the commonest 256 take one byte. A block holds
whole documents: one control byte for every four ranks gives their lengths of 1 to 4 bytes, and the
bytes themselves lie apart from the control bytes. Blocks are rows of a Parquet table in ascending
order of the document key, so that Spark's commit protocol and any of its stores apply; the ranks
are a second small table. Readers take all lengths of a control byte from a table of 256 entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from threadloom.llm import kernels as K
from threadloom.llm.common import prepare, temporary
from threadloom.llm.tokens import encode_column

# Ids in a block at most, unless one document has more.
BLOCK_IDS = 500_000

# Lengths of the four values that a control byte describes.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4) < size[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


def _width(path: str, end_id: int) -> type:
    """The narrowest of two number types that holds every id of the vocabulary."""
    from tokenizers import Tokenizer

    largest = max(end_id, *Tokenizer.from_file(path).get_vocab().values())
    return np.uint16 if largest < 1 << 16 else np.uint32


def _tokenise(path: str, end_id: int, width: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, end, ids, counts in encode_column(batch.column(1), path, end_id):
                yield pa.record_batch({
                    "doc_id": batch.column(0).slice(first, end - first),
                    "row": pa.array(np.arange(row, row + end - first)),
                    "ids": K.binary_column(ids.astype(width), counts),
                })
                row += end - first

    return run


def _count(width: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            values, _ = _numbers(batch.column(0), width)
            seen = np.bincount(values) if len(values) else np.zeros(0, np.int64)
            if len(seen) > len(total):
                seen, total = total, seen
            total = total.copy()
            total[: len(seen)] += seen
        ids = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(ids), "n": pa.array(total[ids])})

    return run


def _numbers(column: pa.Array, width: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column end to end, and how many each row has."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return np.frombuffer(raw.tobytes(), width), np.diff(at) // np.dtype(width).itemsize


def _blocks(rank_of: np.ndarray, id_type: pa.DataType, width: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, start, keys, ids, counts = TaskContext.get().partitionId(), 0, 0, [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal block, start
            values, sizes = np.concatenate(ids), np.concatenate(counts)
            control, data = pack_ranks(rank_of[values])
            names = pa.concat_arrays(keys).cast(id_type)
            out = pa.record_batch({
                "part": pa.array([part]), "block": pa.array([block]), "start": pa.array([start]),
                "n_ids": pa.array([len(values)]), "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                "counts": pa.array([sizes.tolist()]), "control": pa.array([control], pa.binary()),
                "data": pa.array([data], pa.binary()),
            })
            block, start = block + 1, start + len(values)
            for x in (keys, ids, counts):
                x.clear()
            return out

        for batch in batches:
            values, sizes = _numbers(batch.column(1), width)
            ends = np.cumsum(sizes)
            first = 0
            while first < len(sizes):
                room = BLOCK_IDS - sum(map(len, ids))
                base = ends[first] - sizes[first]
                end = int(np.searchsorted(ends, base + room, side="right"))
                if end == first and not ids:
                    end += 1
                if end > first:
                    keys.append(batch.column(0).slice(first, end - first))
                    ids.append(values[base : ends[end - 1]])
                    counts.append(sizes[first:end])
                    first = end
                if first < len(sizes):
                    yield flush()
        if ids:
            yield flush()

    return run


def write_tokens(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode every whole text, append ``end_id``, and write ids in ascending order of the key.

    A null or empty text is the end id alone. Rows of equal keys keep all, in their order in the
    source; null keys come first. An empty table writes two empty tables. Other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType
    staged_schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("row", T.LongType()), T.StructField("ids", T.BinaryType())
    ])
    block_schema = T.StructType([
        *(T.StructField(x, T.LongType()) for x in ("part", "block", "start", "n_ids")),
        T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("control", T.BinaryType()), T.StructField("data", T.BinaryType()),
    ])
    width = _width(tokenizer, end_id)
    with temporary(spark) as keep:
        staged = keep(source.mapInArrow(_tokenise(tokenizer, end_id, width), staged_schema), "tokens")
        # At most one row for each id of the vocabulary reaches the driver.
        ranked = staged.select("ids").mapInArrow(_count(width), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
        ids = np.array([r["id"] for r in sorted(ranked.collect(), key=lambda r: (-r["n"], r["id"]))], np.int64)
        rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
        rank_of[ids] = np.arange(len(ids))
        ordered = staged.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "ids")
        ordered.mapInArrow(_blocks(rank_of, to_arrow_type(kind), width), block_schema).write.option(
            "compression", "none").parquet(f"{path}/blocks")
        spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "rank long, id long").coalesce(1).write.parquet(
            f"{path}/ranks")


def _decode(id_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("doc_ids")
            for i in range(batch.num_rows):
                n, start = batch.column("n_ids")[i].as_py(), batch.column("start")[i].as_py()
                ranks = unpack_ranks(batch.column("control")[i].as_py(), batch.column("data")[i].as_py(), n)
                counts = batch.column("counts")[i].values.to_numpy()
                yield pa.record_batch({
                    "doc_id": names[i].values, "start": pa.array(start + np.cumsum(counts) - counts),
                    "n_tokens": pa.array(counts), "ids": K.binary_column(id_of[ranks], counts),
                })

    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written folder: doc_id, start (ids of all documents before it), n_tokens, ids
    (little-endian unsigned 32-bit numbers)."""
    prepare(spark)
    blocks = spark.read.parquet(f"{path}/blocks")
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()  # bounded by the vocabulary
    id_of = np.array([r["id"] for r in ranks], np.uint32)
    # One row per written partition; the running sum is over those only.
    before = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    placed = blocks.join(F.broadcast(before), "part").withColumn("start", F.col("start") + F.col("before"))
    kind = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])
    return placed.select("start", "n_ids", "doc_ids", "counts", "control", "data").mapInArrow(_decode(id_of), schema)
