"""Metrics, raters, failures and report rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom import constants as C
from threadloom.functions.text import to_taxonomy
from threadloom.operators import failures, metrics, predictions as P, raters, sampling
from threadloom.plans import evaluation
from threadloom.plans.catalog.base import LABEL_LIST, query, sql_label, sql_quote, sql_strip, view, with_views
from threadloom.session import scratch_path
from threadloom.sources.tables import write_metrics

_LABELS = "labels_dim AS (SELECT unnest([" + LABEL_LIST + "]) AS label)"


def _counts_sql(source: str, truth: str, predicted: str, by: str = "'x'") -> str:
    return f"""counts AS (
      SELECT {by} AS system, {sql_label(truth)} AS true_label, {sql_label(predicted)} AS pred_label, count(*) AS n
      FROM {source} GROUP BY 1, 2, 3)"""


_DERIVED = f"""{_LABELS},
    systems AS (SELECT DISTINCT system FROM counts),
    grid AS (SELECT system, label FROM systems JOIN labels_dim ON TRUE),
    classes AS (
      SELECT g.system, g.label, coalesce(sum(n) FILTER (true_label = g.label AND pred_label = g.label), 0) AS hits,
             coalesce(sum(n) FILTER (true_label = g.label), 0) AS true_n, coalesce(sum(n) FILTER (pred_label = g.label), 0) AS pred_n
      FROM grid g LEFT JOIN counts c ON c.system = g.system AND (true_label = g.label OR pred_label = g.label)
      GROUP BY g.system, g.label),
    per_class AS (
      SELECT system, label, CASE WHEN pred_n = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / pred_n END AS precision,
             CASE WHEN true_n = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / true_n END AS recall,
             CASE WHEN true_n + pred_n = 0 THEN 0.0 ELSE 2.0 * CAST(hits AS DOUBLE) / (true_n + pred_n) END AS f1,
             CAST(true_n AS BIGINT) AS support, hits FROM classes),
    matrix AS (
      SELECT a.system, a.label AS true_label, b.label AS pred_label, coalesce(c.n, 0) AS n
      FROM grid a JOIN grid b ON b.system = a.system
      LEFT JOIN counts c ON c.system = a.system AND c.true_label = a.label AND c.pred_label = b.label),
    intent_scores AS (
      SELECT system, CAST(sum(hits) AS DOUBLE) / sum(support) AS accuracy, avg(f1) AS macro_f1,
             sum(f1 * support) / sum(support) AS weighted_f1, CAST(sum(support) AS BIGINT) AS n FROM per_class GROUP BY system),
    spread AS (
      SELECT system, 'true' AS side, true_label AS label, sum(n) AS n FROM counts GROUP BY 1, 2, 3
      UNION ALL SELECT system, 'pred', pred_label, sum(n) FROM counts GROUP BY 1, 2, 3)"""

_INTENT = f"{with_views('intents')}, {_counts_sql('intents', 'gold_intent', 'intent')}, {_DERIVED}"


def _counts(spark, sf_dir):
    return metrics.pair_counts(view(spark, sf_dir, "intents"), "gold_intent", "intent")


@query("intent_metrics", f"""{_INTENT}
    SELECT round(accuracy, 4) AS accuracy, round(macro_f1, 4) AS macro_f1, round(weighted_f1, 4) AS weighted_f1, n FROM intent_scores""")
def intent_metrics(spark, sf_dir):
    return metrics.rounded(metrics.intent_metrics(_counts(spark, sf_dir)))


@query("intent_per_class", f"""{_INTENT}
    SELECT label, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM per_class""")
def intent_per_class(spark, sf_dir):
    return metrics.rounded(metrics.per_class(_counts(spark, sf_dir)).drop("hits"))


@query("confusion_matrix", f"{_INTENT} SELECT true_label, pred_label, n FROM matrix")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_counts(spark, sf_dir))


@query("confusion_matrix_wide", f"""{_INTENT} SELECT true_label,
    {', '.join(f"CAST(sum(n) FILTER (pred_label = '{i}') AS BIGINT) AS {i}" for i in metrics.LABELS)} FROM matrix GROUP BY true_label""")
def confusion_matrix_wide(spark, sf_dir):
    return metrics.confusion_matrix_wide(_counts(spark, sf_dir))


@query("label_distribution", f"{_INTENT} SELECT side, label, CAST(n AS BIGINT) AS n FROM spread")
def label_distribution(spark, sf_dir):
    return metrics.label_distribution(_counts(spark, sf_dir))


@query("cohen_kappa", f"""{_INTENT},
    margins AS (SELECT label, coalesce(sum(n) FILTER (side = 'true'), 0) AS a, coalesce(sum(n) FILTER (side = 'pred'), 0) AS b
                FROM spread GROUP BY label),
    parts AS (SELECT (SELECT CAST(sum(n) FILTER (true_label = pred_label) AS DOUBLE) / sum(n) FROM counts) AS po,
                     CAST(sum(a * b) AS DOUBLE) / (sum(a) * sum(a)) AS pe FROM margins)
    SELECT round(po, 4) AS observed, round(pe, 4) AS expected, round((po - pe) / (1 - pe), 4) AS kappa FROM parts""")
def cohen_kappa(spark, sf_dir):
    return metrics.rounded(metrics.cohen_kappa(_counts(spark, sf_dir)))


@query("unknown_labels", f"""{with_views('intents')}
    SELECT label, count(*) AS n FROM (SELECT lower({sql_strip('intent')}) AS label FROM intents) labels
    WHERE label NOT IN ({LABEL_LIST}) GROUP BY label""")
def unknown_labels(spark, sf_dir):
    return metrics.unknown_labels(view(spark, sf_dir, "intents"), "intent")


@query("stratified_sample", f"""{with_views('intents')}
    SELECT example_id, label, place FROM (
      SELECT example_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(example_id AS VARCHAR)), example_id) AS place
      FROM (SELECT example_id, {sql_label('gold_intent')} AS label FROM intents) labels) placed WHERE place <= 20""")
def stratified_sample(spark, sf_dir):
    rows = view(spark, sf_dir, "intents").select("example_id", to_taxonomy(F.col("gold_intent")).alias("label"))
    sample = sampling.stratified_sample(rows, "label", "example_id", 20)
    return sample.withColumn("place", F.col("place").cast("bigint"))


def _binary_sql(source: str, truth: str, predicted: str, by: str = "'x'") -> str:
    def yes(c: str) -> str:
        return f"coalesce(lower({sql_strip(c)}) IN ('true', '1', 'yes'), FALSE)"

    return f"""binary_counts AS (
      SELECT {by} AS system, count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp,
             count(*) FILTER (t AND NOT p) AS fn, count(*) FILTER (NOT t AND NOT p) AS tn
      FROM (SELECT *, {yes(truth)} AS t, {yes(predicted)} AS p FROM {source}) flags GROUP BY 1),
    binary_scores AS (
      SELECT system, (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
             coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
             tp, fp, fn, tn, (tp + fn) / (tp + fp + fn + tn) AS true_escalation_rate,
             (tp + fp) / (tp + fp + fn + tn) AS predicted_escalation_rate FROM binary_counts)"""


@query("binary_metrics", f"""{with_views('escalations')}, {_binary_sql('escalations', 'gold_escalate', 'escalate')}
    SELECT round(accuracy, 4) AS accuracy, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
           tp, fp, fn, tn, round(true_escalation_rate, 4) AS true_escalation_rate,
           round(predicted_escalation_rate, 4) AS predicted_escalation_rate FROM binary_scores""")
def binary_metrics(spark, sf_dir):
    return metrics.rounded(metrics.binary_metrics(view(spark, sf_dir, "escalations"), "gold_escalate", "escalate"))


def _clamped(source: str) -> str:
    def one(d: str) -> str:
        return f"CASE WHEN {d} IS NULL THEN 3 ELSE CAST(floor(greatest(1.0, least(5.0, CAST({d} AS DOUBLE)))) AS INTEGER) END AS {d}"

    return f"""judge AS (
      SELECT *, round((helpfulness + tone + groundedness) / 3.0, 2) AS overall
      FROM (SELECT * REPLACE ({', '.join(one(d) for d in C.DIMENSIONS)}) FROM {source}) clamped)"""


_DIMENSIONS = (*C.DIMENSIONS, "overall")


def _judge(spark, sf_dir):
    return P.clamp_scores(view(spark, sf_dir, "judge_raw"))


@query("judge_aggregate", f"{with_views('judge_raw')}, {_clamped('judge_raw')} " + " UNION ALL ".join(
    f"SELECT count(*) AS n_judged, '{d}' AS dimension, round(avg({d}), 4) AS mean, round(stddev_pop({d}), 4) AS std FROM judge"
    for d in _DIMENSIONS))
def judge_aggregate(spark, sf_dir):
    return metrics.rounded(raters.judge_aggregate(_judge(spark, sf_dir)))


_MAIN = "main AS (SELECT * FROM predictions WHERE system = 'pipeline')"


def _main(spark, sf_dir):
    return view(spark, sf_dir, "predictions").where("system = 'pipeline'")


@query("judge_subsample", f"""{with_views('predictions')}, {_MAIN}
    SELECT example_id, query, reply FROM main ORDER BY md5('42:' || CAST(example_id AS VARCHAR)), example_id LIMIT 50""")
def judge_subsample(spark, sf_dir):
    return raters.judge_subsample(_main(spark, sf_dir).select("example_id", "query", "reply"))


@query("human_sheet", f"""{with_views('predictions', 'golden')}, {_MAIN}
    SELECT m.example_id AS index, m.query AS customer_query, m.reply AS generated_reply, g.brand_response_actual AS actual_reply,
           '' AS human_helpfulness, '' AS human_tone, '' AS human_groundedness, '' AS human_notes
    FROM (SELECT * FROM main ORDER BY md5('42:' || CAST(example_id AS VARCHAR)), example_id LIMIT 50) m
    JOIN golden g ON g.example_id = m.example_id""")
def human_sheet(spark, sf_dir):
    return raters.human_sheet(_main(spark, sf_dir), view(spark, sf_dir, "golden"))


@query("human_sheet_scores", f"""{with_views('human_scores')}
    SELECT example_id, CAST(human_helpfulness AS INTEGER) AS human_helpfulness, CAST(human_tone AS INTEGER) AS human_tone,
           CAST(human_groundedness AS INTEGER) AS human_groundedness FROM human_scores WHERE example_id % 3 <> 0""")
def human_sheet_scores(spark, sf_dir):
    from threadloom.session import scratch_path
    from threadloom.sources.human import read_human_scores, write_human_sheet

    filled = F.col("example_id") % 3 != 0
    sheet = view(spark, sf_dir, "human_scores").select(
        F.col("example_id").cast("string").alias("index"),
        *[F.lit("a, \"b\"\nc").alias(c) for c in ("customer_query", "generated_reply", "actual_reply")],
        *[F.when(filled, F.col(f"human_{d}").cast("string")).alias(f"human_{d}") for d in C.DIMENSIONS],
        F.lit("").alias("human_notes"),
    )
    path = scratch_path(spark, "sheet")
    write_human_sheet(sheet, path)
    return read_human_scores(spark, path)


_RANK = "rank() OVER (PARTITION BY dimension ORDER BY {0}) + (count(*) OVER (PARTITION BY dimension, {0}) - 1) / 2.0"


def _agreement_sql(main: str = "judge") -> str:
    """Correlations, and their p-values by the same fraction, one step of a recursion after the other."""
    from threadloom.functions.stats import FRACTION_STEPS

    pairs = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST(j.{d} AS DOUBLE) AS x, CAST(h.human_{d} AS DOUBLE) AS y FROM {main} j JOIN human_scores h ON h.example_id = j.example_id"
        for d in C.DIMENSIONS)
    tiny = "CASE WHEN abs({0}) < 1e-300 THEN 1e-300 ELSE {0} END"
    return f"""score_pairs AS ({pairs}),
    score_ranks AS (SELECT *, {_RANK.format('x')} AS rx, {_RANK.format('y')} AS ry FROM score_pairs),
    agreed AS (SELECT dimension, corr(x, y) AS pearson_r, corr(rx, ry) AS spearman_r, count(*) AS n_samples FROM score_ranks GROUP BY dimension),
    tails AS (
      SELECT *, (n - 2) / 2.0::DOUBLE AS a, 1 - r * r AS x
      FROM (SELECT dimension, 'pearson' AS kind, pearson_r AS r, CAST(n_samples AS DOUBLE) AS n FROM agreed
            UNION ALL SELECT dimension, 'spearman', spearman_r, CAST(n_samples AS DOUBLE) FROM agreed) both_kinds
      WHERE n >= 3 AND abs(r) < 1 AND 1 - r * r < 1),
    sides AS (
      SELECT dimension, kind, direct, front, CASE WHEN direct THEN a ELSE 0.5 END AS p, CASE WHEN direct THEN 0.5 ELSE a END AS q,
             CASE WHEN direct THEN x ELSE 1 - x END AS y
      FROM (SELECT *, x < (a + 1) / (a + 2.5) AS direct, exp(lgamma(a + 0.5) - lgamma(a) - ln(sqrt(pi())) + a * ln(x) + 0.5 * ln(1 - x)) AS front FROM tails) t),
    fraction AS (
      SELECT dimension, kind, p, q, y, 1 AS j, 1.0::DOUBLE AS c, 1 / ({tiny.format('(1 - (p + q) * y / (p + 1))')}) AS d, 1 / ({tiny.format('(1 - (p + q) * y / (p + 1))')}) AS f
      FROM sides
      UNION ALL
      SELECT dimension, kind, p, q, y, j, c, d, f * c * d
      FROM (SELECT dimension, kind, p, q, y, j, f, {tiny.format('(1 + step / c)')} AS c, 1 / ({tiny.format('(1 + step * d)')}) AS d
            FROM (SELECT dimension, kind, p, q, y, j + 1 AS j, c, d, f,
                         CASE WHEN (j + 1) % 2 = 0 THEN ((j + 1) // 2) * (q - (j + 1) // 2) * y / ((p + 2 * ((j + 1) // 2) - 1) * (p + 2 * ((j + 1) // 2)))
                              ELSE -(p + (j + 1) // 2) * (p + q + (j + 1) // 2) * y / ((p + 2 * ((j + 1) // 2)) * (p + 2 * ((j + 1) // 2) + 1)) END AS step
                  FROM fraction WHERE j < {FRACTION_STEPS}) next_step) moved),
    p_values AS (
      SELECT f.dimension, f.kind, CASE WHEN s.direct THEN s.front * f.f / s.p ELSE 1 - s.front * f.f / s.p END AS p_value
      FROM fraction f JOIN sides s ON s.dimension = f.dimension AND s.kind = f.kind WHERE f.j = {FRACTION_STEPS}),
    agreement AS (
      SELECT a.*, {', '.join(f"CASE WHEN abs(a.{k}_r) >= 1 THEN 0.0 WHEN 1 - a.{k}_r * a.{k}_r >= 1 THEN 1.0 ELSE {k[0]}.p_value END AS {k}_p" for k in ('pearson', 'spearman'))}
      FROM agreed a LEFT JOIN p_values p ON p.dimension = a.dimension AND p.kind = 'pearson'
      LEFT JOIN p_values s ON s.dimension = a.dimension AND s.kind = 'spearman')"""


@query("human_agreement", f"""{with_views('judge_raw', 'human_scores', recursive=True)}, {_clamped('judge_raw')}, {_agreement_sql()}
    SELECT dimension, round(pearson_r, 4) AS pearson_r, round(spearman_r, 4) AS spearman_r, n_samples, CAST(NULL AS VARCHAR) AS error FROM agreement""")
def human_agreement(spark, sf_dir):
    return metrics.rounded(raters.human_agreement(_judge(spark, sf_dir), view(spark, sf_dir, "human_scores"), p_values=False))


@query("human_agreement_p", f"""{with_views('judge_raw', 'human_scores', recursive=True)}, {_clamped('judge_raw')}, {_agreement_sql()}
    SELECT dimension, round(pearson_r, 4) AS pearson_r, round(spearman_r, 4) AS spearman_r, n_samples, CAST(NULL AS VARCHAR) AS error,
           round(pearson_p, 4) AS pearson_p, round(spearman_p, 4) AS spearman_p FROM agreement""")
def human_agreement_p(spark, sf_dir):
    return metrics.rounded(raters.human_agreement(_judge(spark, sf_dir), view(spark, sf_dir, "human_scores")))


def _failures_sql(n: int) -> str:
    pred, gold = "lower(m.escalate) IN ('yes', '1', 'true')", "lower(g.escalate) IN ('yes', '1', 'true')"
    return f"""{with_views('predictions', 'golden', 'judge_raw')}, {_MAIN}, {_clamped('judge_raw')},
    marked AS (
      SELECT m.example_id, m.query, m.intent AS prediction_intent, g.intent AS golden_intent, j.overall,
             lower(m.intent) <> lower(g.intent) AS intent_wrong, ({pred}) <> ({gold}) AS escalation_wrong, {pred} AS said_yes,
             coalesce(j.overall <= 2, FALSE) AS poor
      FROM main m JOIN golden g ON g.example_id = m.example_id LEFT JOIN judge j ON j.example_id = m.example_id),
    failures AS (
      SELECT example_id, query, prediction_intent, golden_intent, overall,
             CASE WHEN intent_wrong THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN escalation_wrong THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END
             + CASE WHEN poor THEN 3.0::DOUBLE - overall ELSE 0.0::DOUBLE END AS error_score,
             concat_ws(', ', CASE WHEN intent_wrong THEN concat('Intent: predicted ''', prediction_intent, ''' vs actual ''', golden_intent, '''') END,
                       CASE WHEN escalation_wrong THEN CASE WHEN said_yes THEN 'Escalation: over-escalated' ELSE 'Escalation: under-escalated' END END,
                       CASE WHEN poor THEN concat('Reply quality: ', CAST(overall AS VARCHAR), '/5') END) AS error_types
      FROM marked WHERE intent_wrong OR escalation_wrong OR poor ORDER BY error_score DESC, example_id LIMIT {n})"""


@query("find_failures", f"""{_failures_sql(1_000_000_000)}
    SELECT example_id, query, round(error_score, 4) AS error_score, error_types, prediction_intent, golden_intent, overall FROM failures""")
def score_all_failures(spark, sf_dir):
    found = failures.score_failures(_main(spark, sf_dir), view(spark, sf_dir, "golden"), _judge(spark, sf_dir))
    return metrics.rounded(found.withColumn("error_types", F.array_join("error_types", ", ")))


_HYPOTHESIS = "CASE " + " ".join(
    f"WHEN prediction_intent = '{p}' AND golden_intent = '{g}' THEN {sql_quote(text)}" for (p, g), text in C.FAILURE_HYPOTHESES.items()
) + f" ELSE concat({sql_quote(C.HYPOTHESIS_DEFAULT[0])}, prediction_intent, {sql_quote(C.HYPOTHESIS_DEFAULT[1])}, golden_intent, {sql_quote(C.HYPOTHESIS_DEFAULT[2])}) END"


@query("failure_report_rows", f"""{_failures_sql(50)}
    SELECT example_id, substring(query, 1, 100) AS query_preview, error_types, round(error_score, 4) AS error_score,
           prediction_intent, golden_intent, {_HYPOTHESIS} AS hypothesis FROM failures""")
def failure_report_rows(spark, sf_dir):
    worst = failures.find_failures(_main(spark, sf_dir), view(spark, sf_dir, "golden"), _judge(spark, sf_dir), top_n=50)
    return metrics.rounded(failures.failure_report(worst))


def _long_sql(human: bool = False) -> str:
    def part(source: str, family: str, names, label: str = "''") -> str:
        return " UNION ALL ".join(
            f"SELECT system, '{family}' AS family, '{m}' AS metric, {label} AS class, CAST({m} AS DOUBLE) AS value FROM {source}" for m in names
        )

    quality = " UNION ALL ".join(
        f"SELECT system, '{d}' AS dimension, avg({d}) AS mean, stddev_pop({d}) AS std, count(*) AS n_judged FROM judge GROUP BY system"
        for d in _DIMENSIONS
    )
    parts = [
        part("intent_scores", "intent", ("accuracy", "macro_f1", "weighted_f1", "n")),
        part("per_class", "intent_class", ("precision", "recall", "f1", "support"), "label"),
        part("matrix", "confusion", ("n",), "concat(true_label, '->', pred_label)"),
        part("spread", "distribution", ("n",), "concat(side, ':', label)"),
        part("binary_scores", "escalation", ("accuracy", "precision", "recall", "f1", "tp", "fp", "fn", "tn",
                                             "true_escalation_rate", "predicted_escalation_rate")),
        part("quality", "reply_quality", ("mean", "std", "n_judged"), "dimension"),
    ]
    agreed = ""
    if human:
        names = ("pearson_r", "pearson_p", "spearman_r", "spearman_p", "n_samples")
        parts.append(part("(SELECT 'pipeline' AS system, * FROM agreement)", "human_agreement", names, "dimension"))
        agreed = f"main_judge AS (SELECT * FROM judge WHERE system = 'pipeline'), {_agreement_sql('main_judge')},"
    return f"""{with_views('predictions', 'golden', 'judged', 'human_scores', recursive=True)},
    aligned AS (SELECT p.system, p.intent, p.escalate, g.intent AS gold_intent, g.escalate AS gold_escalate
                FROM predictions p JOIN golden g ON g.example_id = p.example_id),
    {_counts_sql('aligned', 'gold_intent', 'intent', 'system')}, {_DERIVED},
    {_binary_sql('aligned', 'gold_escalate', 'escalate', 'system')}, {_clamped('judged')},
    quality AS ({quality}), {agreed} long AS ({' UNION ALL '.join(parts)})"""


_LONG = _long_sql()
_WIDE = ", ".join(f"max(value) FILTER (system = '{s}') AS {s}" for s in evaluation.SYSTEMS)


def _evaluated(spark, sf_dir, human=None):
    judge = P.clamp_scores(view(spark, sf_dir, "judged"))
    return evaluation.evaluate(view(spark, sf_dir, "predictions"), view(spark, sf_dir, "golden"), judge, human)


@query("evaluation_long", f"{_LONG} SELECT system, family, metric, class, round(value, 4) AS value FROM long")
def evaluation_long(spark, sf_dir):
    return metrics.rounded(_evaluated(spark, sf_dir))


@query("metrics_roundtrip", f"{_LONG} SELECT system, family, metric, class, round(value, 4) AS value FROM long")
def metrics_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    write_metrics(_evaluated(spark, sf_dir), path)
    return metrics.rounded(spark.read.parquet(path).select("system", "family", "metric", "class", "value"))


@query("evaluation_with_agreement", f"{_long_sql(human=True)} SELECT system, family, metric, class, round(value, 4) AS value FROM long")
def evaluation_with_agreement(spark, sf_dir):
    return metrics.rounded(_evaluated(spark, sf_dir, view(spark, sf_dir, "human_scores")))


@query("system_comparison", f"""{_LONG}, wide AS (SELECT family, metric, class, {_WIDE} FROM long GROUP BY family, metric, class)
    SELECT family, metric, class, {', '.join(f'round({s}, 4) AS {s}' for s in evaluation.SYSTEMS)} FROM wide""")
def system_comparison(spark, sf_dir):
    return metrics.rounded(evaluation.system_comparison(_evaluated(spark, sf_dir)))


_CELLS = ", ".join(
    f"CASE WHEN {s} IS NULL THEN 'N/A' WHEN l.family = 'reply_quality' THEN printf('%.2f', round({s}, 2)) ELSE printf('%.1f%%', round({s}, 4) * 100) END AS {s}"
    for s in evaluation.SYSTEMS
)


@query("report_rows", f"""{_LONG}, wide AS (SELECT family, metric, class, {_WIDE} FROM long GROUP BY family, metric, class),
    lines AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{t}', '{f}', '{m}', '{c}')" for i, (t, f, m, c) in enumerate(evaluation.REPORT_LINES))})
              AS v(line, title, family, metric, class))
    SELECT l.line, l.family, l.title, {_CELLS}
    FROM lines l LEFT JOIN wide w ON w.family = l.family AND w.metric = l.metric AND w.class = l.class""")
def report_rows(spark, sf_dir):
    return evaluation.report_rows(_evaluated(spark, sf_dir))


@query("per_class_report", f"""{_LONG}
    SELECT label AS class, printf('%.0f%%', round(precision, 4) * 100) AS precision, printf('%.0f%%', round(recall, 4) * 100) AS recall,
           printf('%.0f%%', round(f1, 4) * 100) AS f1, support FROM per_class WHERE system = 'pipeline'""")
def per_class_report(spark, sf_dir):
    return evaluation.per_class_report(_evaluated(spark, sf_dir))
