"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from threadloom.plans.catalog import QUERIES  # noqa: E402
from threadloom.session import build_session  # noqa: E402

HEADLINE = (
    "clean_documents", "ascii_english_filter", "prefix_dedup", "tweet_lookup_dedup", "reply_edges", "build_threads",
    "thread_summary", "first_pairs", "thread_context", "golden_sample", "knn_topk", "knn_topk_grid", "retrieval_context",
    "tfidf_embed", "render_prompts", "parse_intent_responses", "parse_judge_scores", "assemble_predictions",
    "intent_metrics", "confusion_matrix", "binary_metrics", "judge_aggregate", "human_agreement", "find_failures",
    "evaluation_long", "report_rows",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "threadloom-bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_driver_memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    warm = warm if os.path.isdir(warm) else sf_dir
    for name in HEADLINE:
        run(spark, name, warm)
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
