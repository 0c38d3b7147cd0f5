"""Secret scans by fixed patterns and by character Markov models; column functions only.

Two first-order Markov models over ASCII characters, one of random strings and one of ordinary
identifiers, are counted from labelled samples: the values that the fixed patterns find are random
strings, other long runs of the same characters are ordinary. A run is a secret if its
log-likelihood ratio exceeds the odds against a secret.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import prepare

# The base patterns.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A run that is too short can hold no longer match, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "markov")

RUN = "[A-Za-z0-9+/_=-]"
# Runs from this length on are judged; from TRAIN_LENGTH on they are samples.
RUN_LENGTH = 16
TRAIN_LENGTH = 10
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Odds against a run being a secret.
PRIOR_ODDS = 10_000.0


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratios (random over ordinary) by pair of characters, row-major over ALPHABET."""

    ratios: tuple[float, ...]
    threshold: float = math.log(PRIOR_ODDS)


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _placed(text: Column, found: Column, pattern: str, rank: int, keep) -> Column:
    """Spans (start, end, rank, value) of matches, in code points, by adding up what lies between."""
    between = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,end:int,rank:int,value:string>>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["between"])
        end = start + F.length(x["found"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(rank).alias("rank"), x["found"].alias("value"))
        return F.struct(end.alias("at"), F.when(keep(x["found"]), F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    pairs = F.arrays_zip(found.alias("found"), F.slice(between, F.lit(1), F.size(found)).alias("between"))
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    return F.when(F.size(found) > 0, F.aggregate(pairs, start, step, lambda s: s["out"])).otherwise(empty)


def _base(df: DataFrame, text: str) -> DataFrame:
    """Add ``_text`` and the base spans ``_base``, sorted by start and kind."""
    df = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumns({
        "_assign": _matches(F.col("_text"), ASSIGN), "_access": _matches(F.col("_text"), ACCESS),
        "_hex": _matches(F.col("_text"), HEX),
    })
    long_value = lambda v: F.length(F.regexp_extract(v, ASSIGN, 2)) >= LEAST_VALUE
    always = lambda v: F.lit(True)
    spans = F.concat(
        _placed(F.col("_text"), F.col("_assign"), ASSIGN, 0, long_value),
        _placed(F.col("_text"), F.col("_access"), ACCESS, 1, always),
        _placed(F.col("_text"), F.col("_hex"), HEX, 2, always),
    )
    return df.withColumn("_base", F.array_sort(spans)).drop("_assign", "_access", "_hex")


def _blanked(text: Column, spans: Column) -> Column:
    """The text with spaces in place of the spans, so that everything else keeps its position."""
    def step(state: Column, s: Column) -> Column:
        at = F.greatest(state["at"], s["start"])
        end = F.greatest(state["at"], s["end"])
        piece = F.concat(F.substr(text, state["at"] + 1, at - state["at"]), F.repeat(F.lit(" "), end - at))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(piece)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    blank = F.aggregate(spans, start, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substr(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, blank).otherwise(text)


def train(samples: DataFrame) -> MarkovModel:
    """Count the two models from ``samples`` (``value`` string, ``random`` boolean).

    Every distinct sample counts once, whatever it is copied. Pairs are counted by Spark; what comes
    to the driver is one row per pair of characters and label. Without samples both models are even.
    """
    values = samples.dropna().distinct().withColumn("n", F.length("value"))
    pairs = values.filter("n > 1").select("random", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("n") - 1), lambda i: F.substr(F.col("value"), i, F.lit(2)))).alias("pair"))
    counted = pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()
    size = len(ALPHABET)
    place = {c: i for i, c in enumerate(ALPHABET)}
    counts = {True: [[0] * size for _ in range(size)], False: [[0] * size for _ in range(size)]}
    for row in counted:
        a, b = place.get(row["pair"][0]), place.get(row["pair"][1])
        if a is not None and b is not None:
            counts[row["random"]][a][b] += row["n"]
    logs = {}
    for label, table in counts.items():
        columns = [sum(table[a][b] for a in range(size)) for b in range(size)]
        total = sum(columns)
        # A row leans on the frequencies of single characters, those on the even distribution.
        single = [(columns[b] + 1.0) / (total + size) for b in range(size)]
        logs[label] = [math.log((table[a][b] + 5.0 * single[b]) / (sum(table[a]) + 5.0)) for a in range(size) for b in range(size)]
    return MarkovModel(tuple(round(r - o, 6) for r, o in zip(logs[True], logs[False])))


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """Samples from all documents: values found by the base patterns are random strings, other runs
    of TRAIN_LENGTH characters or more are ordinary identifiers."""
    base = _base(docs.select(text), text)
    value = lambda s: F.when(s["rank"] == 0, F.regexp_extract(s["value"], ASSIGN, 2)).otherwise(s["value"])
    tagged = base.select(
        F.transform("_base", value).alias("secrets"), _matches(F.col("_text"), f"{RUN}{{{TRAIN_LENGTH},}}").alias("runs"))
    tagged = tagged.select(F.explode(F.concat(
        F.transform("secrets", lambda v: F.struct(v.alias("value"), F.lit(True).alias("random"))),
        F.transform(F.array_except("runs", "secrets"), lambda v: F.struct(v.alias("value"), F.lit(False).alias("random"))),
    )).alias("sample"))
    return tagged.select("sample.value", "sample.random")


def scan(docs: DataFrame, model: MarkovModel, text: str = "text") -> DataFrame:
    """Add ``secrets``: the spans (kind, start, end) of every whole text, by start and kind.

    Positions are code points, the end is exclusive. Null and empty texts have no spans. Base spans
    are those of the patterns; ``markov`` spans are runs that the models call random, cut where base
    spans begin and end: what a run holds beside a base span is judged by itself.
    Every row is kept, with its other columns; a column already called ``secrets`` is replaced.
    """
    prepare(docs.sparkSession)
    columns = [c for c in docs.columns if c != "secrets"]
    # The row's own columns go in one, so that none of them can clash with a working name.
    df = _base(docs.select(F.struct(*columns).alias("row"), F.col(text).alias("text")), "text")
    pattern = f"[A-Za-z0-9]{RUN}{{{RUN_LENGTH - 1},}}"
    size = len(ALPHABET)
    table = F.split(F.lit(",".join(map(str, model.ratios))), ",").cast("array<double>")

    def ratio(run: Column) -> Column:
        def at(i: Column) -> Column:
            a = F.instr(F.lit(ALPHABET), F.substr(run, i, F.lit(1)))
            b = F.instr(F.lit(ALPHABET), F.substr(run, i + 1, F.lit(1)))
            return F.element_at(table, (a - 1) * size + b)

        return F.aggregate(F.sequence(F.lit(1), F.length(run) - 1), F.lit(0.0), lambda s, i: s + at(i))

    df = df.withColumn("_rest", _blanked(F.col("_text"), F.col("_base")))
    df = df.withColumn("_runs", _matches(F.col("_rest"), pattern))
    df = df.withColumn("_likely", F.filter(F.array_distinct("_runs"), lambda r: ratio(r) > model.threshold))
    # Places are added up only where some run is random.
    placed = F.when(F.size("_likely") > 0, _placed(
        F.col("_rest"), F.col("_runs"), pattern, 3, lambda v: F.array_contains("_likely", v),
    )).otherwise(F.array().cast("array<struct<start:int,end:int,rank:int,value:string>>"))
    kinds = F.array(*(F.lit(k) for k in KINDS))
    named = lambda s: F.struct(
        F.element_at(kinds, s["rank"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    return df.withColumn("secrets", F.transform(F.array_sort(F.concat(F.col("_base"), placed)), named)).select("row.*", "secrets")


def spelled(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span (overlapping ones together) replaced by ``mark``; null stays null."""
    def step(state: Column, s: Column) -> Column:
        apart = s["start"] >= state["at"]
        out = F.when(apart, F.concat(
            state["out"], F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, masked).otherwise(text)
