import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadloom.operators import graph, predictions as P, retrieval
from threadloom.plans import jobs
from threadloom.schemas import TWEETS
from threadloom.sources import golden as G, human, tables, threads as T, tweets as W

ODD = ['plain', 'comma, "quoted"', "line\nbreak", "  padded  ", "", "tab\t\\slash\\", "ünï"]


def dump(spark, n=12, brand="Brand"):
    rows = []
    for c in range(n):
        root = c * 10 + 1
        rows += [
            (str(root), f"u{c}", "True", "", f"my problem number {c}, please", str(root + 1), ""),
            (str(root + 1), brand, "False", "", f"@u{c} try this fix {c}", str(root + 2), str(root)),
            (str(root + 2), f"u{c}", "True", "", "thanks, that helped", "", str(root + 1)),
        ]
    return spark.createDataFrame(rows, TWEETS)


def test_tweet_csv_keeps_odd_text(spark, tmp_path):
    rows = [(str(i), "a", "True", "", text, "", "1") for i, text in enumerate(ODD)]
    W.write_tweets(spark.createDataFrame(rows, TWEETS).coalesce(1), str(tmp_path / "t"))
    back = W.read_tweets(spark, str(tmp_path / "t"), file_order=True).orderBy("position").collect()
    assert [r["text"] for r in back] == [t or None for t in ODD]
    assert back[0]["response_tweet_id"] is None and back[0]["in_response_to_tweet_id"] == "1"


def test_file_order_follows_names_not_sizes(spark, tmp_path):
    def rows(name, n):
        return [(f"{name}{i}", "a", "True", "", f"{name} {i} " + "x" * 50, "", "") for i in range(n)]
    for sizes in ((3, 400), (400, 3)):
        folder = tmp_path / f"d{sizes[0]}"
        folder.mkdir()
        for name, n in zip("ab", sizes):
            W.write_tweets(spark.createDataFrame(rows(name, n), TWEETS).coalesce(1), str(tmp_path / "one"))
            (part,) = (tmp_path / "one").glob("part-*.csv")
            (folder / f"{name}.csv").write_bytes(part.read_bytes())
        back = W.read_tweets(spark, f"{folder}/*.csv", file_order=True).orderBy("position").collect()
        assert [r["tweet_id"] for r in back] == [r[0] for name, n in zip("ab", sizes) for r in rows(name, n)]


def test_ids_without_numbers_need_positions(spark):
    odd = spark.createDataFrame([("x1", "a", "True", "", "some text", "", "")], TWEETS)
    with pytest.raises(Exception, match="needs a position column"):
        graph.message_nodes(odd).collect()
    assert graph.message_nodes(odd.withColumn("position", F.lit(1))).count() == 1


def test_golden_csv_keeps_empty_text(spark, tmp_path):
    rows = [(str(i), text, "r", "", "", "", "extra") for i, text in enumerate(ODD)]
    df = spark.createDataFrame(rows, "thread_id string, customer_query string, brand_response_actual string, intent string, escalate string, escalation_reason string, more string")
    G.write_golden_csv(df.withColumn("notes", F.lit(None).cast("string")), str(tmp_path / "g"))
    back = G.read_golden_csv(spark, str(tmp_path / "g"))
    assert back.columns == ["thread_id", "customer_query", "brand_response_actual", "intent", "escalate", "escalation_reason", "notes"]
    assert {r["thread_id"]: r["customer_query"] for r in back.collect()} == {str(i): t for i, t in enumerate(ODD)}
    assert {r["notes"] for r in back.collect()} == {""}


def test_human_sheet_keeps_scored_rows_only(spark, tmp_path):
    rows = [("1", "q", "r", "a", "5", "4", "x", ""), ("2", "q\nq", "r", "a", "", "4", "3", "")]
    names = ["index", "customer_query", "generated_reply", "actual_reply", "human_helpfulness", "human_tone", "human_groundedness", "human_notes"]
    human.write_human_sheet(spark.createDataFrame(rows, names), str(tmp_path / "h"))
    assert [tuple(r) for r in human.read_human_scores(spark, str(tmp_path / "h")).collect()] == [(1, 5, 4, None)]


def test_table_is_reused_only_for_the_same_key(spark, tmp_path):
    calls = []

    def build(n):
        calls.append(n)
        return spark.range(n)

    for n in (3, 3, 4):
        path = tables.table_path(str(tmp_path), "ids", brand="b", n=n)
        assert tables.read_or_build(spark, path, lambda: build(n)).count() == n
    assert calls == [3, 4]
    broken = tmp_path / "ids-broken"
    broken.mkdir()
    assert not tables.is_complete(spark, str(broken))


def test_every_change_of_the_input_files_is_another_state(spark, tmp_path):
    folder = tmp_path / "a b%20c [x]"  # names that an address would write differently

    def part(name, text):
        (folder / name).parent.mkdir(exist_ok=True)
        (folder / name).write_text(text)

    def state(*columns):
        return tables.input_state(spark.read.schema("a string, b string").csv(str(folder).replace("[", "\\[").replace("]", "\\]")).select(*columns or ("a", "b")))

    part("1.csv", "x,y\n")
    part("2.csv", "z,y\n")
    seen = [state()]
    assert state() == seen[0] != state("a")
    part("1.csv", "x,yy\n")  # changed
    seen.append(state())
    part("3.csv", "x,y\n")  # added
    seen.append(state())
    (folder / "2.csv").write_text("")  # emptied
    seen.append(state())
    assert len(set(seen)) == 4


def test_state_of_wide_plans_and_of_tables_without_files(spark, tmp_path):
    spark.range(5).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(60)]).write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    usual = spark.conf.get("spark.sql.debug.maxToStringFields")
    one, two = [wide.where(F.col("c0").isin(*range(80), last)) for last in (100, 101)]
    assert tables.input_state(one) == tables.input_state(wide.where(F.col("c0").isin(*range(80), 100))) != tables.input_state(two)
    assert spark.conf.get("spark.sql.debug.maxToStringFields") == usual
    rows = spark.createDataFrame([(1, "a"), (2, None)], "a int, b string")
    again = spark.createDataFrame([(2, None), (1, "a")], "a int, b string")
    assert tables.input_state(rows) == tables.input_state(again) != tables.input_state(rows.limit(0))


def test_vector_table_joins_without_moving_its_documents(spark, tmp_path):
    vectors = spark.range(200).select(
        F.col("id").alias("thread_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("embedding"),
        F.concat(F.lit("q"), "id").alias("customer_query"), F.lit("it's").alias("brand_response"))
    path = str(tmp_path / "it's here")
    for buckets in (3, 7):  # a second write replaces the first, its number of buckets too
        tables.write_vectors(vectors, path, buckets=buckets)
        stored = tables.read_vectors(spark, path)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, vectors.collect()))
    hits = spark.range(500).select(F.col("id").alias("query_id"), (F.col("id") % 200).alias("doc_id"), F.lit(0.5).alias("score"))
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a corpus too large to be sent
    try:
        joined = retrieval.with_documents(hits, stored, broadcast_hits=0)
        assert joined.where("customer_query = concat('q', doc_id)").count() == 500
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    lines = plan.split("SortMergeJoin")[1].split("\n")[1:]
    at = lines[0].index(":-")
    second = next(i for i, line in enumerate(lines) if line[at:at + 2] == "+-")
    sides = ["\n".join(lines[:second]), "\n".join(lines[second:])]
    scanned, moved = sides if "FileScan" in sides[0] else sides[::-1]
    assert "Bucketed: true" in scanned and "Exchange" not in scanned and moved.count("Exchange") == 1
    empty = str(tmp_path / "empty")
    tables.write_vectors(vectors.limit(0), empty)
    assert tables.read_vectors(spark, empty).count() == 0


def test_all_steps_end_to_end(spark, tmp_path):
    tweets = dump(spark)
    turns = jobs.build_conversations(spark, tweets, str(tmp_path), "brand", n=8)
    again = jobs.build_conversations(spark, tweets, str(tmp_path), "brand", n=8)
    assert turns.count() == again.count() == 24 and again.inputFiles() == turns.inputFiles()
    # Another input is another table.
    assert jobs.build_conversations(spark, tweets.limit(0), str(tmp_path), "brand", n=8).count() == 0
    T.write_threads(turns, str(tmp_path / "threads"))
    assert sorted(map(tuple, T.read_threads(spark, str(tmp_path / "threads")).collect())) == sorted(
        map(tuple, turns.select("thread_id", "root_id", "brand", "seq", "role", "author_id", "text", "tweet_id").collect()))

    golden = jobs.build_golden(turns, n=6)
    labels = golden.select("example_id", F.lit("label").alias("stage"),
                           F.lit('{"intent": "how_to", "escalate": "no"}').alias("response"))
    golden = jobs.label_golden(golden, labels)
    assert {(r["intent"], r["escalate"], r["auto_labeled"]) for r in golden.collect()} == {("how_to", "no", True)}
    jobs.save_golden(golden, turns, str(tmp_path / "g.csv"), str(tmp_path / "g.json"))
    assert G.read_golden_csv(spark, str(tmp_path / "g.csv")).count() == 6
    saved = G.read_golden_json(spark, str(tmp_path / "g.json"))
    assert saved.count() == 6 and {r["example_id"] for r in saved.collect()} == {r["example_id"] for r in golden.collect()}
    assert {len(r["full_thread"]) for r in G.read_golden_threads(spark, str(tmp_path / "g.json")).collect()} == {3}
    edited = G.with_example_ids(G.read_golden_csv(spark, str(tmp_path / "g.csv")), golden)
    assert sorted(r["example_id"] for r in edited.collect()) == sorted(r["example_id"] for r in golden.collect())
    with pytest.raises(Exception, match="without its example"):
        G.with_example_ids(edited.drop("root_id", "example_id").withColumn("customer_query", F.lit("other")), golden).collect()

    def encoder(batches):
        for b in batches:
            yield pd.DataFrame({"root_id": b.root_id, "embedding": [[float(len(q)), float(len(q) % 7), 1.0] for q in b.customer_query]})

    questions = turns.where("seq = 0").select("root_id", F.col("text").alias("customer_query"))
    vectors = retrieval.attach_vectors(questions, encoder, "root_id string, embedding array<double>")
    index = jobs.build_index(turns, vectors)
    assert index.count() == 8 and {len(r["full_thread"]) for r in index.collect()} == {3}
    tables.write_vectors(index, str(tmp_path / "index"), "root_id")
    assert tables.read_vectors(spark, str(tmp_path / "index")).count() == 8

    answers = golden.select("example_id", F.inline(F.array(*[
        F.struct(F.lit(s).alias("stage"), F.lit(t).alias("response"))
        for s, t in {"intent": '{"intent": "how_to"}', "reply": "Try this", "escalation": '{"escalate": "yes"}'}.items()])))
    systems = {
        "pipeline": P.assemble_predictions(golden.select("example_id", "customer_query"), answers),
        "trivial_baseline": P.trivial_baseline(golden.select("example_id", F.col("customer_query").alias("query"))),
    }
    judge = P.clamp_scores(golden.select(F.lit("pipeline").alias("system"), "example_id", F.lit(2).alias("helpfulness"),
                                         F.lit(1).alias("tone"), F.lit(2).alias("groundedness")))
    long, worst = jobs.evaluate_systems(golden, systems, judge, metrics_path=str(tmp_path / "m"), sheet_path=str(tmp_path / "s"))
    table, classes, failed = jobs.report(long, worst)
    rows = {r["title"]: (r["pipeline"], r["trivial_baseline"]) for r in table.collect()}
    assert rows["Accuracy"] == ("100.0%", "0.0%") and rows["Helpfulness"] == ("2.00", "N/A")
    assert classes.where("class = 'how_to'").first()["recall"] == "100%"
    assert failed.count() == 5 and failed.first()["error_types"] == "Escalation: over-escalated, Reply quality: 1.67/5"
    assert spark.read.options(**W.CSV_OPTIONS).csv(str(tmp_path / "s")).count() == 6


def test_checkpoint_folder_comes_from_the_session(spark):
    from threadloom.session import checkpoint_dir, scratch_path

    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(checkpoint_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from threadloom.session import checkpoint_dir

    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)


def test_long_threads_do_not_repeat_their_golden_row(spark, tmp_path):
    golden = spark.createDataFrame([("1", "q", "r", "", "", "", "", "root", 7)], "thread_id string, customer_query string, brand_response_actual string, intent string, escalate string, escalation_reason string, notes string, root_id string, example_id long")
    turns = spark.range(2500).select(F.lit("root").alias("root_id"), F.lit("1").alias("thread_id"), F.col("id").cast("int").alias("seq"), F.lit("customer").alias("role"), F.lit("a").alias("author_id"), F.lit("t").alias("text"), F.col("id").cast("string").alias("tweet_id"))
    jobs.save_golden(golden, turns, str(tmp_path / "c"), str(tmp_path / "j"))
    assert G.read_golden_json(spark, str(tmp_path / "j")).count() == 1
    pages = G.read_golden_threads(spark, str(tmp_path / "j")).collect()
    assert sorted(len(p["full_thread"]) for p in pages) == [500, 1000, 1000]
