"""Language identification, words first.

A known word scores by its frequency in each language. An unseen word falls back to its character
n-grams: the longest length of which any n-gram is known decides, down to single characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.llm import kernels as K
from threadloom.llm.common import low_hash, materialize, prepare
from threadloom.session import materialize_counted

# Labelled documents of each language that the model is fitted on at most.
FIT_ROWS = 1500
# Their bytes at most, in each language; a text adds its first ROW_CHARS characters (1 MB at most).
FIT_BYTES = 12_000_000
ROW_CHARS = 250_000
# Rows of one number and a name that may be broadcast.
BROADCAST_ROWS = 1_000_000
# Words and n-grams seen less often are left to shorter ones.
LEAST_COUNT = 2
LONGEST = 5
# Longer words (text without spaces is one word) are cut for counting n-grams, to keep rows short.
PART = 100

# Letters of lower-cased text as far as bytes tell; the rest of Unicode counts as part of words.
WORD = np.zeros(256, bool)
WORD[97:123] = WORD[128:] = True
_WORD_PATTERN = r"[a-z\x{80}-\x{10FFFF}]+"


@dataclass
class LanguageModel:
    languages: list[str]
    words: K.HashTable
    word_logs: np.ndarray
    grams: K.HashTable
    gram_logs: np.ndarray


@dataclass
class Counts:
    """Rows (lang, name, n) with each lang and name once, held as Arrow columns: as Python rows they take a
    multiple of the driver's memory and leave holes in it. Who iterates gets them as dicts, a batch at a time."""

    columns: pa.Table

    @classmethod
    def of(cls, df: DataFrame) -> Counts:
        return cls(df.select("lang", "name", "n").toArrow())

    def __iter__(self) -> Iterator[dict]:
        for batch in self.columns.to_batches(max_chunksize=1000):
            yield from batch.to_pylist()

    def languages(self) -> set[str]:
        return set(self.columns["lang"].unique().to_pylist())


def _table(rows: Counts, languages: list[str]) -> tuple[K.HashTable, np.ndarray]:
    """Hash table and log frequencies by language; names in their order."""
    coded = rows.columns["name"].combine_chunks().dictionary_encode()
    order = pa.compute.sort_indices(coded.dictionary)
    names = coded.dictionary.take(order)
    place = np.empty(len(names), np.int64)
    place[order.to_numpy()] = np.arange(len(names))
    column = pa.compute.index_in(rows.columns["lang"], pa.array(languages, rows.columns["lang"].type))
    logs = np.zeros((len(names), len(languages)))
    logs[place[coded.indices.to_numpy()], column.to_numpy()] = rows.columns["n"].to_numpy()
    total = logs.sum(0)
    logs = np.log(logs + 0.5) - np.log(total + 0.5 * max(1, len(names)))
    raw, at = K.text_buffer(names)
    table = K.HashTable()
    table.insert(K.span_hashes(raw, at[:-1], at[1:]))
    return table, logs.astype(np.float32)


def _sent(small: DataFrame) -> DataFrame:
    """A table stored and counted, sent to all executors if it is small indeed."""
    table, counts = materialize_counted(small)
    return F.broadcast(table) if counts["rows"] <= BROADCAST_ROWS else table


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """Fit on a bounded sample of the labelled rows: of each language the FIT_ROWS documents whose
    keys have the smallest hash, up to FIT_BYTES of text, of which each adds its first ROW_CHARS
    characters. Rows with the same key and language are one document, with the smallest of their texts."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.left(text, F.lit(ROW_CHARS)).alias("text"))
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_key", F.lit(9)), "_key")
    # Keys are ranked without their texts, and only those with small hashes: a language with most of the
    # rows is no larger there than any other. The chosen ones, FIT_ROWS per language, go to the texts.
    keys = known.filter(F.col("_key").isNotNull()).select("_key", "_lang")
    many = _sent(keys.groupBy("_lang").agg(F.approx_count_distinct("_key").alias("_many")))
    few = keys.join(many, "_lang").filter(low_hash(F.xxhash64("_key", F.lit(9)), FIT_ROWS, F.col("_many"))).select("_key", "_lang")
    ranked = few.distinct().withColumn("_rank", F.row_number().over(order))
    chosen = _sent(ranked.filter(F.col("_rank") <= FIT_ROWS).select("_key", "_lang"))
    rows = materialize(known.join(chosen, ["_key", "_lang"]).groupBy("_key", "_lang").agg(F.min("text").alias("text")))
    sizes = rows.select("_key", "_lang", F.sum(F.octet_length("text")).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_bytes"))
    sample = rows.join(sizes.filter(F.col("_bytes") <= FIT_BYTES).drop("_bytes"), ["_key", "_lang"]).select(
        F.col("_lang").alias("lang"), "text")
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_WORD_PATTERN), F.lit(0))).alias("name"))
    counted = words.groupBy("lang", "name").agg(F.count("*").alias("n")).persist()
    listed = Counts.of(counted.filter(F.col("n") >= LEAST_COUNT))
    # A part has the n-grams that begin in its first PART characters; what follows lets them end.
    parts = counted.select("lang", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("name"), F.lit(PART)), lambda i: F.substr(
        F.col("name"), i, F.lit(PART + LONGEST - 1)))).alias("part"))
    spans = F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("part"))), lambda k: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(PART), F.length("part") - k + 1)), lambda i: F.substr(F.col("part"), i, k))))
    grams = parts.select("lang", "n", F.explode(spans).alias("name"))
    pieces = Counts.of(grams.groupBy("lang", "name").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT))
    counted.unpersist()
    languages = sorted(pieces.languages() | listed.languages())
    return LanguageModel(languages, *_table(listed, languages), *_table(pieces, languages))


def _word_logs(model: LanguageModel, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Log frequencies of words, by n-grams where the word is unknown."""
    out = np.zeros((len(starts), len(model.languages)), np.float32)
    known = found >= 0
    out[known] = model.word_logs[found[known]]
    rest = np.flatnonzero(~known)
    if not len(rest):
        return out
    # Character starts of the unseen words, end to end.
    positions = K.spread(starts[rest], ends[rest] - starts[rest])
    owner = np.repeat(np.arange(len(rest)), ends[rest] - starts[rest])
    head = (raw[positions] & 0xC0) != 0x80
    char, owner = positions[head], owner[head]
    stop = np.append(char[1:], 0)
    last = np.append(owner[1:] != owner[:-1], True)
    stop[last] = ends[rest][owner[last]]
    open_ = np.ones(len(rest), bool)
    for k in range(LONGEST, 0, -1):
        n = len(char) - k + 1
        if n <= 0:
            continue
        begin = np.flatnonzero((owner[:n] == owner[k - 1 :]) & open_[owner[:n]])
        place = model.grams.find(K.span_hashes(raw, char[begin], stop[begin + k - 1]))
        begin, place = begin[place >= 0], place[place >= 0]
        if not len(begin):
            continue
        total = np.zeros((len(rest), len(model.languages)))
        np.add.at(total, owner[begin], model.gram_logs[place])
        hits = np.bincount(owner[begin], minlength=len(rest))
        seen = hits > 0
        out[rest[seen]] = total[seen] / hits[seen, None]
        open_ &= ~seen
    return out


def score_texts(model: LanguageModel, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best language and its share of the likelihood for each lower-cased text."""
    n = len(at) - 1
    total = np.zeros((n, len(model.languages)))
    starts, ends = K.runs(raw, at, WORD)
    if len(starts):
        hashes, first, inverse = np.unique(K.span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        logs = _word_logs(model, raw, starts[first], ends[first], model.words.find(hashes))
        rows = K.rows_of(starts, at)
        for i in range(total.shape[1]):
            total[:, i] = np.bincount(rows, weights=logs[inverse, i], minlength=n)
    best = total.argmax(1)
    return best, 1.0 / np.exp(total - total.max(1, keepdims=True)).sum(1)


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "language") -> DataFrame:
    """Add ``out``: a struct of lang (``und`` if the text is null or has no letter) and score, from 0 to 1.

    Every row and its other columns stay; a column already called like ``out`` is replaced. With no
    learned language every text is ``und`` with score 0.
    """
    prepare(docs.sparkSession)
    letters = has_letters(F.col(text))
    nothing = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"))
    if not model.languages:
        return docs.withColumn(out, nothing)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def run(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for _, _, raw, at in K.slices(texts):
            best, score = score_texts(shared.value, raw, at)
            names += [shared.value.languages[i] for i in best]
            scores.append(score)
        score = np.concatenate(scores) if scores else np.empty(0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64())], fields=list(kind))

    # Texts without a letter need no look.
    asked: Column = F.when(letters, F.lower(text))
    answer = F.arrow_udf(run, "lang string, score double")(asked)
    known = docs.withColumn(out, answer)
    return known.withColumn(out, F.when(letters, F.col(out)).otherwise(nothing))
