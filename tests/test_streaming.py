import pytest
from pyspark.sql import functions as F

from threadloom.plans.catalog import QUERIES
from threadloom.streaming.resumable import run_pending, start_scoring

SCHEMA = "example_id bigint, text string"


def queries(spark, ids):
    return spark.createDataFrame([(i, f"q{i}") for i in ids], SCHEMA)


def score(df):
    return df.select("example_id", F.length("text").alias("score"))


def test_batch_continues_by_key(spark, tmp_path):
    sink = str(tmp_path / "sink")
    assert run_pending(queries(spark, [1, 2]), score, sink) == 2
    assert run_pending(queries(spark, [3, 2, 1]), score, sink) == 3
    assert run_pending(queries(spark, [3, 2, 1]), score, sink) == 3
    assert sorted(r["example_id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 3]


def test_stream_survives_a_crash_and_repeats_nothing(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    queries(spark, range(10)).coalesce(1).write.mode("append").parquet(source)
    queries(spark, range(5, 15)).coalesce(1).write.mode("append").parquet(source)
    schema = queries(spark, []).schema
    calls = []

    def crash_on_second(df):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return score(df)

    try:
        start_scoring(spark, source, schema, crash_on_second, sink, checkpoint, files_per_batch=1).awaitTermination()
        raised = False
    except Exception:
        raised = True
    assert raised
    start_scoring(spark, source, schema, score, sink, checkpoint, files_per_batch=1).awaitTermination()
    queries(spark, range(12, 18)).coalesce(1).write.mode("append").parquet(source)
    start_scoring(spark, source, schema, score, sink, checkpoint, files_per_batch=1).awaitTermination()
    ids = sorted(r["example_id"] for r in spark.read.parquet(sink).collect())
    assert ids == list(range(18))


def test_batch_keeps_one_row_per_key_and_refuses_null_keys(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "example_id long, text string")
    sink = str(tmp_path / "sink")
    for partitions in (1, 3):
        assert run_pending(rows.repartition(partitions), lambda q: q, sink) == 2
    with pytest.raises(Exception, match="without a key"):
        run_pending(spark.createDataFrame([(None, "a")], rows.schema), lambda q: q, sink)


def test_batches_ask_the_state_and_never_the_sink(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = queries(spark, []).schema
    for batch in range(20):  # half of each file was in the one before
        queries(spark, range(batch * 5, batch * 5 + 10)).coalesce(1).write.mode("append").parquet(source)

    def run(stop_at=None):
        seen = []

        def count(df):
            rows = sorted(r["example_id"] for r in df.collect())
            seen.append(rows)
            if len(seen) == stop_at:
                raise RuntimeError("lost")
            return score(df)

        query = start_scoring(spark, source, schema, count, sink, checkpoint, files_per_batch=1)
        try:
            query.awaitTermination()
        except Exception:
            assert stop_at
        return seen, [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]

    first, _ = run(stop_at=8)
    # What was written is taken away: a stream that read its sink would score those keys again.
    written = {r["example_id"] for r in spark.read.parquet(sink).collect()}
    moved = tmp_path / "moved"
    (tmp_path / "out").rename(moved)
    second, states = run()
    assert first[-1] == second[0]  # the broken batch again, alike
    later = {r["example_id"] for r in spark.read.parquet(sink).collect()}
    assert written | later == set(range(105)) and not written & later
    assert all(s["numRowsUpdated"] <= 10 for s in states) and states[-1]["numRowsTotal"] == 105


def test_a_stream_keeps_the_row_that_a_batch_job_keeps(spark, tmp_path):
    rows = spark.createDataFrame([(i % 7, f"text {i}", True) for i in range(60)], "example_id long, text string, flag boolean")
    run_pending(rows, lambda q: q, str(tmp_path / "batch"))
    want = sorted(map(str, spark.read.parquet(str(tmp_path / "batch")).collect()))
    for parts in (1, 5):
        base = tmp_path / f"run{parts}"
        rows.repartition(parts).write.parquet(str(base / "in"))
        start_scoring(spark, str(base / "in"), rows.schema, lambda q: q, str(base / "out"), str(base / "state")).awaitTermination()
        assert sorted(map(str, spark.read.parquet(str(base / "out")).drop("batch").collect())) == want


def test_a_stream_refuses_null_keys(spark, tmp_path):
    rows = spark.createDataFrame([(None, "a"), (1, "b")], SCHEMA)
    rows.write.parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="without a key"):
        start_scoring(spark, str(tmp_path / "in"), rows.schema, score, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()


@pytest.mark.parametrize("parts", [1, 3])
def test_the_scoring_query_reads_a_table_of_one_file_and_of_many(spark, tmp_path, parts):
    """a table that is a folder of files was not found by its name, and no sink was written."""
    rows = spark.createDataFrame(
        [(c, t, "assistant", f' "turn {t}" ') for c in range(4) for t in range(3)], "conv_id bigint, turn int, role string, text string")
    rows.repartition(parts).write.parquet(str(tmp_path / "conversations.parquet"))
    folder = tmp_path
    if parts == 1:
        [file] = (tmp_path / "conversations.parquet").glob("*.parquet")
        folder = tmp_path / "files"
        folder.mkdir()
        (folder / "conversations.parquet").write_bytes(file.read_bytes())
    found = QUERIES["resumable_scoring"](spark, str(folder)).collect()
    assert sorted(map(tuple, found)) == [(c, t, f"turn {t}") for c in range(4) for t in range(3)]
