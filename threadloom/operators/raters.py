"""Judge averages, the human scoring sheet, and agreement of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom import constants as C
from threadloom.functions.stats import correlation_p
from threadloom.operators.sampling import BROADCAST_SAMPLE, sample_rows
from threadloom.session import materialize


def judge_aggregate(scores: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean and population deviation per dimension, one pass."""
    names = (*C.DIMENSIONS, "overall")
    measures = [f(d).alias(f"{tag}_{d}") for d in names for tag, f in (("mean", F.avg), ("std", F.stddev_pop))]
    grouped = scores.groupBy(*by) if by else scores.groupBy()
    row = grouped.agg(*measures, F.count("*").alias("n_judged"))
    entries = [
        F.struct(F.lit(d).alias("dimension"), F.col(f"mean_{d}").alias("mean"), F.col(f"std_{d}").alias("std"))
        for d in names
    ]
    return row.select(*by, "n_judged", F.inline(F.array(*entries)))


def judge_subsample(predictions: DataFrame, n: int = C.JUDGE_SAMPLE, seed: int = C.SEED) -> DataFrame:
    """The examples a judge gets to see."""
    return sample_rows(predictions, "example_id", n, seed)


def human_sheet(predictions: DataFrame, golden: DataFrame, n: int = C.JUDGE_SAMPLE, seed: int = C.SEED) -> DataFrame:
    """Sampled rows with empty score cells. The sample is drawn first, so the join is small: its ids,
    whose number is bounded, may be broadcast to the golden rows; texts of any length are not."""
    chosen = materialize(judge_subsample(predictions.select("example_id", "query", "reply"), n, seed))
    ids = chosen.select("example_id")
    if n <= BROADCAST_SAMPLE:
        ids = F.broadcast(ids)
    rows = golden.select("example_id", "brand_response_actual").join(ids, "example_id", "left_semi").join(chosen, "example_id")
    blank = [F.lit("").alias(f"human_{c}") for c in (*C.DIMENSIONS, "notes")]
    return rows.select(
        F.col("example_id").alias("index"), F.col("query").alias("customer_query"),
        F.col("reply").alias("generated_reply"), F.coalesce("brand_response_actual", F.lit("")).alias("actual_reply"),
        *blank,
    )


def score_pairs(judge: DataFrame, human: DataFrame) -> DataFrame:
    """How often each pair of judge and human score occurs: a handful of rows per dimension."""
    both = judge.select("example_id", *C.DIMENSIONS).join(
        human.select("example_id", *[f"human_{d}" for d in C.DIMENSIONS]), "example_id"
    )
    pairs = F.inline(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("double").alias("x"),
                 F.col(f"human_{d}").cast("double").alias("y"))
        for d in C.DIMENSIONS
    ]))
    return both.select(pairs).where("x IS NOT NULL AND y IS NOT NULL").groupBy("dimension", "x", "y").agg(
        F.count("*").cast("double").alias("w")
    )


def _average_ranks(pairs: DataFrame, value: str) -> DataFrame:
    """Average rank of every distinct value, from its count and the count of smaller values."""
    sizes = pairs.groupBy("dimension", value).agg(F.sum("w").alias("m"))
    below = F.sum("m").over(Window.partitionBy("dimension").orderBy(value))
    return sizes.select("dimension", value, (below - (F.col("m") - 1) / 2).alias(f"rank_{value}"))


def _correlation(x: Column, y: Column, w: Column) -> Column:
    """Weighted Pearson coefficient; NULL when one side is constant."""
    n, sx, sy = F.sum(w), F.sum(w * x), F.sum(w * y)
    sxx, syy, sxy = F.sum(w * x * x), F.sum(w * y * y), F.sum(w * x * y)
    spread = (n * sxx - sx * sx) * (n * syy - sy * sy)
    return F.when(spread > 0, F.try_divide(n * sxy - sx * sy, F.sqrt(spread)))


def human_agreement(judge: DataFrame, human: DataFrame, p_values: bool = True) -> DataFrame:
    """Pearson and Spearman correlation per dimension; fewer than five pairs give a message instead.
    The two score tables are joined once; ranks and sums work on the counts of score pairs."""
    pairs = materialize(score_pairs(judge, human))
    ranked = pairs.join(_average_ranks(pairs, "x"), ["dimension", "x"]).join(
        _average_ranks(pairs, "y"), ["dimension", "y"]
    )
    w = F.col("w")
    found = ranked.groupBy("dimension").agg(
        _correlation(F.col("x"), F.col("y"), w).alias("pearson_r"),
        _correlation(F.col("rank_x"), F.col("rank_y"), w).alias("spearman_r"),
        F.sum(w).cast("bigint").alias("n_samples"),
    )
    enough = F.col("n_samples") >= C.MIN_AGREEMENT_PAIRS
    message = F.concat(F.lit("Not enough samples ("), F.col("n_samples").cast("string"), F.lit(")"))
    result = found.select(
        "dimension",
        F.when(enough, F.col("pearson_r")).alias("pearson_r"),
        F.when(enough, F.col("spearman_r")).alias("spearman_r"),
        "n_samples",
        F.when(~enough, message).alias("error"),
    )
    if p_values:
        n = F.col("n_samples").cast("double")
        result = result.withColumns({
            "pearson_p": correlation_p(F.col("pearson_r"), n), "spearman_p": correlation_p(F.col("spearman_r"), n)
        })
    return result
