import math

import pytest
from pyspark.sql import functions as F

from threadloom import constants as C
from threadloom.functions.stats import correlation_p
from threadloom.operators import failures, metrics, predictions as P, raters
from threadloom.plans import evaluation


def labels(spark, pairs):
    return spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(pairs)], "example_id bigint, t string, p string")


def by_label(df):
    return {r["label"]: r for r in df.collect()}


def test_published_escalation_counts(spark):
    """Confusion counts of three systems over 200 examples and the F1 each must give."""
    for (tp, fp, fn, tn), f1, precision, recall in [
        ((59, 54, 5, 82), 66.7, 52.2, 92.2), ((39, 75, 25, 61), 43.8, 34.2, 60.9), ((64, 136, 0, 0), 48.5, 32.0, 100.0),
    ]:
        pairs = [("yes", " YES ")] * tp + [("no", "true")] * fp + [("1", "no")] * fn + [("no", "maybe")] * tn
        row = metrics.binary_metrics(labels(spark, pairs), "t", "p").first()
        assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (tp, fp, fn, tn)
        assert [round(row[m] * 100, 1) for m in ("f1", "precision", "recall")] == [f1, precision, recall]
        assert row["true_escalation_rate"] == (tp + fn) / 200


def test_majority_class_macro_f1(spark):
    rest = [i for i in C.INTENTS if i != "technical_issue"]
    pairs = [("technical_issue", "technical_issue")] * 143 + [(rest[i % 6], "technical_issue") for i in range(57)]
    row = metrics.intent_metrics(metrics.pair_counts(labels(spark, pairs), "t", "p")).first()
    assert round(row["accuracy"], 3) == 0.715 and round(row["macro_f1"], 3) == 0.119 and row["n"] == 200


def test_per_class_with_absent_and_unknown_labels(spark):
    pairs = [(" How_To ", "how_to"), ("how_to", "junk"), ("other", "other"), ("billing_purchase", "how_to")]
    counts = metrics.pair_counts(labels(spark, pairs), "t", "p")
    classes = by_label(metrics.per_class(counts))
    assert set(classes) == set(C.INTENTS)
    assert (classes["how_to"]["precision"], classes["how_to"]["recall"], classes["how_to"]["support"]) == (0.5, 0.5, 2)
    assert (classes["other"]["precision"], classes["other"]["recall"]) == (0.5, 1.0)
    assert (classes["service_status"]["f1"], classes["service_status"]["support"]) == (0.0, 0)
    matrix = metrics.confusion_matrix(counts).collect()
    assert len(matrix) == 49 and sum(r["n"] for r in matrix) == 4
    wide = {r["true_label"]: r for r in metrics.confusion_matrix_wide(counts).collect()}
    assert wide["how_to"]["other"] == 1 and wide["other"]["how_to"] == 0


def test_empty_input(spark):
    counts = metrics.pair_counts(labels(spark, [("a", "b")]).limit(0), "t", "p")
    row = metrics.intent_metrics(counts).first()
    assert row["accuracy"] is None and row["macro_f1"] == 0.0
    row = metrics.binary_metrics(labels(spark, [("a", "b")]).limit(0), "t", "p").first()
    assert (row["f1"], row["tp"], row["true_escalation_rate"]) == (0.0, 0, 0.0)


def test_kappa(spark):
    pairs = [("how_to", "how_to")] * 20 + [("how_to", "other")] * 5 + [("other", "how_to")] * 10 + [("other", "other")] * 15
    row = metrics.cohen_kappa(metrics.pair_counts(labels(spark, pairs), "t", "p")).first()
    assert round(row["kappa"], 4) == 0.4 and row["observed"] == 0.7


def ranks(values):
    ordered = sorted(values)
    return [ordered.index(v) + (ordered.count(v) - 1) / 2 for v in values]


def pearson(x, y):
    n = len(x)
    mx, my = sum(x) / n, sum(y) / n
    top = sum((a - mx) * (b - my) for a, b in zip(x, y))
    return top / (sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)) ** 0.5


def scores(spark, values, prefix=""):
    names = ", ".join(f"{prefix}{d} int" for d in C.DIMENSIONS)
    return spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"example_id bigint, {names}")


def test_agreement_with_ties_constants_and_few_pairs(spark):
    judge = [(1, 2, 3), (2, 2, 3), (3, 4, 3), (3, 1, 3), (5, 5, 3), (4, 3, 3)]
    human = [(1, 3, 2), (3, 2, 4), (2, 5, 1), (4, 1, 5), (5, 4, 2), (4, 4, 3)]
    got = {r["dimension"]: r for r in raters.human_agreement(scores(spark, judge), scores(spark, human, "human_")).collect()}
    for i, d in enumerate(C.DIMENSIONS[:2]):
        x, y = [j[i] for j in judge], [h[i] for h in human]
        assert got[d]["pearson_r"] == pytest.approx(pearson(x, y))
        assert got[d]["spearman_r"] == pytest.approx(pearson(ranks(x), ranks(y)))
        assert got[d]["n_samples"] == 6 and got[d]["error"] is None
    assert got["groundedness"]["pearson_r"] is None and got["groundedness"]["pearson_p"] is None
    few = raters.human_agreement(scores(spark, judge[:4]), scores(spark, human[:4], "human_")).first()
    assert few["pearson_r"] is None and few["error"] == "Not enough samples (4)"


def test_p_values_against_known_tables(spark):
    # Two-sided t tail: r chosen so that t equals the tabulated 5 % point for n - 2 degrees of freedom.
    cases = [(t / (t * t + df) ** 0.5, df + 2.0, 0.05, 1e-6) for df, t in [(3, 3.182446), (10, 2.228139), (48, 2.010635), (1000, 1.962339)]]
    # One degree of freedom is the Cauchy distribution, two have a closed form; very many are normal.
    cases += [(t / (t * t + 1) ** 0.5, 3.0, 1 - 2 / math.pi * math.atan(t), 1e-10) for t in (0.001, 0.5, 1.7, 40.0)]
    cases += [(t / (t * t + 2) ** 0.5, 4.0, 1 - t / (t * t + 2) ** 0.5, 1e-10) for t in (0.01, 1.0, 9.0)]
    cases += [(t / (t * t + 1e8) ** 0.5, 1e8 + 2, math.erfc(t / 2 ** 0.5), 1e-6) for t in (0.1, 1.0, 1.73, 1.75, 3.0, 6.0)]
    cases += [(0.0, 10.0, 1.0, 0), (1e-200, 10.0, 1.0, 1e-12), (1.0, 10.0, 0.0, 0), (-1.0, 10.0, 0.0, 0), (0.01, 1e9, 0.0, 1e-12), (-0.6, 8.0, 0.11584, 1e-9)]
    cases += [(0.5, 2.0, None, 0), (None, 9.0, None, 0), (float("nan"), 9.0, None, 0), (0.5, None, None, 0)]
    rows = spark.createDataFrame([(i, r, n) for i, (r, n, *_) in enumerate(cases)], "i int, r double, n double")
    got = {x["i"]: x["p"] for x in rows.select("i", correlation_p(F.col("r"), F.col("n")).alias("p")).collect()}
    for i, (r, n, want, room) in enumerate(cases):
        assert got[i] == (want if want is None else pytest.approx(want, abs=room, rel=1e-5)), (r, n)


def test_judge_aggregate_uses_population_deviation(spark):
    rows = P.clamp_scores(scores(spark, [(1, 9, 0), (3, 4, None), (5, 4, 3)]))
    got = {r["dimension"]: r for r in raters.judge_aggregate(rows).collect()}
    assert got["helpfulness"]["std"] == pytest.approx((8 / 3) ** 0.5) and got["helpfulness"]["n_judged"] == 3
    assert got["tone"]["mean"] == pytest.approx(13 / 3) and got["groundedness"]["mean"] == pytest.approx(7 / 3)


def test_failures(spark):
    columns = "example_id bigint, query string, intent string, escalate string"
    predictions = spark.createDataFrame([
        (1, "q1", "how_to", "yes"), (2, "q2", "HOW_TO", "no"), (3, "q3", "junk", "no"), (4, "q4", "other", "True"), (5, "q5", "other", "no"),
    ], columns)
    golden = spark.createDataFrame([
        (1, "technical_issue", "no"), (2, "how_to", "no"), (3, "other", "yes"), (4, "other", "1"), (5, "other", "no"),
    ], "example_id bigint, intent string, escalate string")
    judge = spark.createDataFrame([(1, 1.67), (4, 2.0), (5, 2.33)], "example_id bigint, overall double")
    found = failures.find_failures(predictions, golden, judge)
    rows = [(r["example_id"], round(r["error_score"], 2), r["error_types"]) for r in found.collect()]
    assert rows == [
        (1, 5.33, ["Intent: predicted 'how_to' vs actual 'technical_issue'", "Escalation: over-escalated", "Reply quality: 1.67/5"]),
        (3, 4.0, ["Intent: predicted 'junk' vs actual 'other'", "Escalation: under-escalated"]),
        (4, 1.0, ["Reply quality: 2.0/5"]),
    ]
    report = {r["example_id"]: r["hypothesis"] for r in failures.failure_report(found).collect()}
    assert report[1] == C.FAILURE_HYPOTHESES["how_to", "technical_issue"]
    assert report[3].startswith("Boundary case between 'junk' and 'other'")


def test_report_shows_missing_values(spark):
    columns = "system string, example_id bigint, intent string, escalate string"
    predictions = spark.createDataFrame([("pipeline", 1, "how_to", "yes"), ("trivial_baseline", 1, "other", "no")], columns)
    golden = spark.createDataFrame([(1, "how_to", "yes")], "example_id bigint, intent string, escalate string")
    long = evaluation.evaluate(predictions, golden)
    rows = {r["title"]: (r["pipeline"], r["simple_baseline"], r["trivial_baseline"]) for r in evaluation.report_rows(long).collect()}
    assert rows["Accuracy"] == ("100.0%", "N/A", "0.0%") and rows["Overall"] == ("N/A", "N/A", "N/A")
    assert rows["Macro F1"][0] == f"{100 / 7:.1f}%"
