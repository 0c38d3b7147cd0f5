"""Quality scores from compression with dictionaries of good and bad text.

Two zstandard dictionaries are trained, one from texts labelled good and one from texts labelled bad.
A text is compressed in parts with each of them; the difference of the two sizes over their sum says
which dictionary knows the text better. What a given difference means depends on how far the text
can be compressed at all (repetitive text is small with either), so a logistic fit weighs the
difference by that rate, and a monotone calibration on other labelled texts makes it a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm import kernels as K
from threadloom.llm.common import low_hash, materialize, prepare
from threadloom.session import materialize_counted

# Labelled rows of each class that the model is fitted on at most (half for the dictionary, half for
# the calibration), and their bytes at most. Of one text no more than its first ROW_CHARS characters
# (1 MB at most) are learned from, so that no row can use up the bound alone.
FIT_ROWS = 3000
FIT_BYTES = 12_000_000
ROW_CHARS = 250_000
DICTIONARY_BYTES = 112_640
# A text is compressed in parts of so many bytes, so that the dictionary counts in all of it.
PART_BYTES = 4096
LEVEL = 3


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    weights: np.ndarray  # of the logistic fit
    steps: np.ndarray  # its values at which the calibrated score rises
    scores: np.ndarray

    def features(self, texts: list[bytes]) -> np.ndarray:
        import zstandard

        sizes = []
        for data in (self.good, self.bad):
            if data:
                made = zstandard.ZstdCompressionDict(data)
                made.precompute_compress(level=LEVEL)
                tool = zstandard.ZstdCompressor(dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False)
            else:
                tool = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
            sizes.append(np.array([
                sum(len(tool.compress(t[a : a + PART_BYTES])) for a in range(0, max(1, len(t)), PART_BYTES)) for t in texts
            ], np.float64))
        difference = (sizes[1] - sizes[0]) / (sizes[1] + sizes[0])
        rate = (sizes[1] + sizes[0]) / (2 * np.array([len(t) + 16 for t in texts], np.float64))
        x = np.stack([20 * difference, np.log(rate)], axis=1)
        return np.concatenate([np.ones((len(x), 1)), x, x * x, x[:, :1] * x[:, 1:]], axis=1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        return np.interp(self.features(texts) @ self.weights, self.steps, self.scores)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by Newton's method on scaled columns, with a ridge; the floor under the curvature keeps
    steps short where the classes are apart."""
    scale = np.maximum(np.abs(x).mean(0), 1e-9)
    z = x / scale
    weights = np.zeros(x.shape[1])
    for _ in range(100):
        share = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        slope = z.T @ (share - y) + 0.1 * weights
        bend = (z * np.maximum(share * (1 - share), 0.02)[:, None]).T @ z + 0.1 * np.eye(len(weights))
        weights = weights - np.linalg.solve(bend, slope)
    return weights / scale


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling neighbours that violate the order; ends are drawn inwards, so
    that no score is exactly 0 or 1."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, count, sum of x
    for value, label in zip(x[order].tolist(), y[order].tolist()):
        blocks.append([label, 1.0, value])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    steps = np.array([b[2] / b[1] for b in blocks])
    scores = np.array([(b[0] + 0.5) / (b[1] + 1.0) for b in blocks])
    return steps, np.maximum.accumulate(scores)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> CompressionModel:
    """Fit on a bounded sample of the labelled rows: for each label the FIT_ROWS whose keys have the
    smallest hash, up to FIT_BYTES of text, of which each row adds its first ROW_CHARS characters. Rows of
    one key are one row, with the smallest of their texts. Keys of several labels, or of none, are not learned from.
    Without rows of both labels every score is the share of label 1, or one half."""
    known = labels.filter(f"{label} in (0, 1)").groupBy(key).agg(F.min(label).alias("_low"), F.max(label).alias("_high")).filter("_low = _high")
    known, counts = materialize_counted(known.select(F.col(key).alias("_key"), "_low"), bad=F.col("_low") == 0)
    order, chosen = F.xxhash64("_key", F.lit(3)), None
    for value, among in ((0, counts["bad"]), (1, counts["rows"] - counts["bad"])):
        # Only keys with small hashes are ranked, so what meets there does not grow with the table.
        few = known.filter((F.col("_low") == value) & low_hash(order, FIT_ROWS, max(1, among)))
        few = few.orderBy(order, "_key").limit(FIT_ROWS)
        chosen = few if chosen is None else chosen.unionByName(few)
    # One look at the documents for both labels; at most FIT_ROWS keys of each are sent to them.
    rows = docs.select(F.col(key).alias("_key"), F.left(text, F.lit(ROW_CHARS)).alias("_text")).filter(F.length("_text") > 0)
    sample = materialize(rows.join(F.broadcast(chosen), "_key").groupBy("_key", "_low").agg(F.min("_text").alias("_text")))
    parts = []
    for value in (0, 1):
        # Each row adds its bytes; the sample ends where the bound is met, in the order of the hash.
        found = sample.filter(F.col("_low") == value)
        few = found.select(order.alias("o"), F.octet_length("_text").alias("b")).toArrow().to_pandas().sort_values("o")
        within = few[few["b"].cumsum() <= FIT_BYTES]
        limit = int(within["o"].max()) if len(within) else -(2**63)
        chosen = found.filter(order <= limit).select(order.alias("o"), "_text").distinct().toArrow()
        pairs = sorted(zip(chosen["o"].to_pylist(), chosen["_text"].to_pylist()))
        parts.append([t.encode() for _, t in pairs])
    return _fit(*parts)


def _fit(bad: list[bytes], good: list[bytes]) -> CompressionModel:
    import zstandard

    def dictionary(texts: list[bytes]) -> bytes:
        samples = [t[a : a + PART_BYTES] for t in texts for a in range(0, len(t), PART_BYTES)]
        size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
        try:
            return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too few samples: their own text serves
            return b"".join(samples)[:DICTIONARY_BYTES]

    model = CompressionModel(dictionary(good[0::2]), dictionary(bad[0::2]), np.zeros(6), np.zeros(1), np.full(1, 0.5))
    rest = good[1::2] + bad[1::2]
    if rest:
        x = model.features(rest)
        y = np.array([1.0] * len(good[1::2]) + [0.0] * len(bad[1::2]))
        model.weights = _logistic(x, y)
        model.steps, model.scores = _calibrate(x @ model.weights, y)
    return model


def score_quality(docs: DataFrame, model: CompressionModel, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``: the calibrated probability of label 1, from 0 to 1, for every whole text.

    Null and empty texts get the score of an empty text. Rows and other columns stay as they are; a
    column already called like ``out`` is replaced.
    """
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        scores = []
        for _, _, raw, at in K.slices(texts):
            data = raw.tobytes()
            scores.append(shared.value.score([data[a:z] for a, z in zip(at[:-1].tolist(), at[1:].tolist())]))
        return pa.array(np.concatenate(scores) if scores else np.empty(0), pa.float64())

    return docs.withColumn(out, F.arrow_udf(run, "double")(F.col(text)))
