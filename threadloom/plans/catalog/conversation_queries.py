"""Threads, pairs, samples and their files."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.operators import graph, pairs, sampling, threads
from threadloom.plans import jobs
from threadloom.plans.catalog.base import (
    query, sql_clean, sql_missing, sql_ok, sql_prefix, sql_truthy, view, with_views,
)
from threadloom.session import scratch_path
from threadloom.sources.golden import read_golden_csv, read_golden_json, read_golden_threads, write_golden_csv, write_golden_json
from threadloom.sources.threads import read_threads, write_threads
from threadloom.sources.tweets import read_tweets, with_inbound_flag, write_tweets

BRAND = "Brand1"


@query("scan_tweets", f"""
    {with_views('tweets')}
    SELECT tweet_id, author_id, inbound, created_at, text, response_tweet_id,
           nullif(in_response_to_tweet_id, '') AS in_response_to_tweet_id FROM tweets""")
def scan_tweets(spark, sf_dir):
    path = scratch_path(spark, "tweets")
    write_tweets(view(spark, sf_dir, "tweets"), path)
    return read_tweets(spark, path)


_OUTBOUND = f"""{with_views('tweets')}, authors AS (
    SELECT author_id, count(*) AS n_messages FROM tweets WHERE NOT {sql_truthy('inbound')} GROUP BY author_id)"""


@query("brand_authors", f"""
    {_OUTBOUND}, matched AS (SELECT *, contains(lower(author_id), 'brand1') OR contains('brand1', lower(author_id)) AS m FROM authors)
    SELECT author_id, n_messages FROM matched WHERE m""")
def brand_authors(spark, sf_dir):
    return graph.brand_authors(view(spark, sf_dir, "tweets"), BRAND)


@query("brand_authors_fallback", f"{_OUTBOUND} SELECT author_id, n_messages FROM authors ORDER BY n_messages DESC, author_id LIMIT 1")
def brand_authors_fallback(spark, sf_dir):
    return graph.brand_authors(view(spark, sf_dir, "tweets"), "nobody knows this name")


@query("top_outbound_author", f"{_OUTBOUND} SELECT author_id, n_messages FROM authors ORDER BY n_messages DESC, author_id LIMIT 20")
def top_outbound_author(spark, sf_dir):
    return graph.top_outbound_authors(view(spark, sf_dir, "tweets"))


@query("inbound_split", f"""
    {with_views('tweets')} SELECT {sql_truthy('inbound')} AS is_inbound, count(*) AS n, count(DISTINCT author_id) AS n_authors
    FROM tweets GROUP BY 1""")
def inbound_split(spark, sf_dir):
    tweets = with_inbound_flag(view(spark, sf_dir, "tweets"))
    authors = tweets.groupBy("is_inbound", "author_id").agg(F.count("*").alias("n"))
    return authors.groupBy("is_inbound").agg(F.sum("n").alias("n"), F.count("author_id").alias("n_authors"))


@query("thread_roots", f"""
    {with_views('tweets')} SELECT tweet_id FROM tweets
    WHERE {sql_truthy('inbound')} AND {sql_missing('in_response_to_tweet_id')} IS NULL""")
def thread_roots(spark, sf_dir):
    return graph.thread_roots(graph.message_nodes(view(spark, sf_dir, "tweets"))).select("tweet_id")


_EDGES = f"""
    SELECT in_response_to_tweet_id AS src, tweet_id AS dst, 0 AS kind, CAST(tweet_id AS BIGINT) AS place
    FROM tweets WHERE {sql_missing('in_response_to_tweet_id')} IS NOT NULL
    UNION ALL
    SELECT tweet_id, trim(part), 1, i - 1
    FROM (SELECT tweet_id, unnest(string_split(response_tweet_id, ',')) AS part,
                 unnest(range(1, len(string_split(response_tweet_id, ',')) + 1)) AS i
          FROM tweets WHERE {sql_missing('response_tweet_id')} IS NOT NULL) parts"""


@query("reply_edges", f"{with_views('tweets')} {_EDGES}")
def reply_edges(spark, sf_dir):
    return graph.reply_edges(graph.message_nodes(view(spark, sf_dir, "tweets")))


def _walk_sql(brand: str) -> str:
    return f"""{with_views('tweets', recursive=True)},
    nodes AS (SELECT tweet_id, author_id, clean AS text, {sql_ok('clean')} AS ok, {sql_truthy('inbound')} AS is_inbound,
                     {sql_missing('in_response_to_tweet_id')} AS parent_id
              FROM (SELECT *, {sql_clean('text')} AS clean FROM tweets) cleaned),
    members AS (SELECT DISTINCT author_id FROM nodes WHERE NOT is_inbound
                AND (contains(lower(author_id), '{brand.lower()}') OR contains('{brand.lower()}', lower(author_id)))),
    all_edges AS ({_EDGES}),
    edges AS (SELECT e.src, e.dst, min(CASE WHEN kind = 0 THEN place ELSE {graph.LIST_BASE} + place END) AS ord
              FROM all_edges e JOIN nodes s ON s.tweet_id = e.src AND s.ok JOIN nodes d ON d.tweet_id = e.dst
              GROUP BY e.src, e.dst),
    walk AS (
      SELECT tweet_id AS root, tweet_id AS tid, 0 AS level, CAST([] AS BIGINT[]) AS path
      FROM nodes WHERE ok AND is_inbound AND parent_id IS NULL
      UNION ALL
      SELECT w.root, e.dst, w.level + 1, list_append(w.path, e.ord) FROM walk w JOIN edges e ON e.src = w.tid),
    visits AS (SELECT w.*, n.author_id, n.text, n.ok, n.author_id IN (SELECT author_id FROM members) AS is_brand
               FROM walk w JOIN nodes n ON n.tweet_id = w.tid),
    chosen AS (SELECT root FROM visits GROUP BY root HAVING bool_or(is_brand) AND count(*) FILTER (ok) >= 2),
    thread_turns AS (
      SELECT substring(md5(root), 1, 12) AS thread_id, root AS root_id, '{brand}' AS brand,
             row_number() OVER (PARTITION BY root ORDER BY level, path) - 1 AS seq,
             CASE WHEN is_brand THEN 'brand' ELSE 'customer' END AS role, author_id, text, tid AS tweet_id
      FROM visits WHERE ok AND root IN (SELECT root FROM chosen))"""


@query("build_threads", f"{_walk_sql(BRAND)} SELECT * FROM thread_turns")
def build_threads(spark, sf_dir):
    return threads.build_threads(view(spark, sf_dir, "tweets"), BRAND)


@query("conversation_sample", f"""
    {_walk_sql(BRAND)},
    picked AS (SELECT root_id FROM (SELECT DISTINCT root_id FROM thread_turns) ids ORDER BY md5('42:' || root_id), root_id LIMIT 20)
    SELECT * FROM thread_turns WHERE root_id IN (SELECT root_id FROM picked)""")
def conversation_sample(spark, sf_dir):
    """The data step as users run it: threads of a brand, sampled and stored."""
    base = scratch_path(spark, "conversations")
    return jobs.build_conversations(spark, view(spark, sf_dir, "tweets"), base, BRAND, n=20)


_SUMMARY = """
    SELECT count(*) AS n_threads, CAST(sum(c) AS BIGINT) AS customer_messages, CAST(sum(b) AS BIGINT) AS brand_messages,
           round(avg(n), 4) AS avg_turns, median(n) AS median_turns, max(n) AS max_turns, min(n) AS min_turns
    FROM (SELECT thread_id, count(*) AS n, count(*) FILTER (role = 'customer') AS c, count(*) FILTER (role = 'brand') AS b
          FROM {0} GROUP BY thread_id) sizes"""


@query("thread_summary", f"{with_views('turns')} {_SUMMARY.format('turns')}")
def thread_summary(spark, sf_dir):
    return threads.thread_summary(view(spark, sf_dir, "turns"))


@query("thread_walk_summary", f"{_walk_sql('Brand2')} {_SUMMARY.format('thread_turns')}")
def thread_walk_summary(spark, sf_dir):
    turns = threads.build_threads(view(spark, sf_dir, "tweets"), "Brand2")
    return threads.thread_summary(turns, "root_id")


PAIRS = f"""{with_views('turns')},
    firsts AS (SELECT thread_id, min(seq) AS customer_seq FROM turns WHERE role = 'customer' AND text <> '' GROUP BY thread_id),
    answers AS (SELECT t.thread_id, min(t.seq) AS brand_seq FROM turns t JOIN firsts f ON f.thread_id = t.thread_id
                WHERE t.role = 'brand' AND t.text <> '' AND t.seq > f.customer_seq GROUP BY t.thread_id),
    pairs AS (SELECT f.thread_id, f.customer_seq, c.text AS customer_query, a.brand_seq, b.text AS brand_response
              FROM firsts f JOIN answers a ON a.thread_id = f.thread_id
              JOIN turns c ON c.thread_id = f.thread_id AND c.seq = f.customer_seq
              JOIN turns b ON b.thread_id = a.thread_id AND b.seq = a.brand_seq)"""


@query("first_pairs", f"{PAIRS} SELECT * FROM pairs")
def first_pairs(spark, sf_dir):
    return pairs.first_pairs(view(spark, sf_dir, "turns"))


@query("thread_context", f"""
    {with_views('turns')}
    SELECT thread_id, count(*) AS n_turns, string_agg(role || ': ' || text, chr(10) ORDER BY seq) AS context
    FROM (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY seq) AS place FROM turns) placed
    WHERE place <= 6 GROUP BY thread_id""")
def thread_context(spark, sf_dir):
    nested = pairs.thread_context(view(spark, sf_dir, "turns"))
    lines = F.transform("context", lambda t: F.concat(t["role"], F.lit(": "), t["text"]))
    return nested.select(
        "thread_id", F.size("context").cast("bigint").alias("n_turns"), F.array_join(lines, "\n").alias("context")
    )


@query("full_threads", f"""
    {with_views('turns')}
    SELECT thread_id, CAST(floor(seq / 1000) AS BIGINT) AS page, count(*) AS n_turns,
           string_agg(text, chr(10) ORDER BY seq) AS whole
    FROM turns GROUP BY thread_id, floor(seq / 1000)""")
def full_threads(spark, sf_dir):
    pages = pairs.thread_pages(view(spark, sf_dir, "turns"))
    texts = F.transform("turns", lambda t: t["text"])
    return pages.select(
        "thread_id", "page", F.size("turns").cast("bigint").alias("n_turns"), F.array_join(texts, "\n").alias("whole")
    )


@query("sample_threads", f"""
    {with_views('turns')},
    chosen AS (SELECT thread_id FROM (SELECT DISTINCT thread_id FROM turns) ids
               ORDER BY md5('42:' || CAST(thread_id AS VARCHAR)), thread_id LIMIT 30)
    SELECT * FROM turns WHERE thread_id IN (SELECT thread_id FROM chosen)""")
def sample_threads(spark, sf_dir):
    return sampling.sample_threads(view(spark, sf_dir, "turns"), 30)


def _golden(n: int) -> str:
    return f"""{PAIRS}, candidates AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY thread_id) AS rn
                     FROM (SELECT *, {sql_prefix('customer_query')} AS prefix FROM pairs) keyed) ranked WHERE rn = 1),
    sample AS (SELECT * FROM candidates ORDER BY md5('42:' || CAST(thread_id AS VARCHAR)), thread_id LIMIT {n})"""


@query("golden_sample", f"""
    {_golden(60)} SELECT thread_id, customer_query, brand_response AS brand_response_actual,
           '' AS intent, '' AS escalate, '' AS escalation_reason, '' AS notes FROM sample""")
def golden_sample(spark, sf_dir):
    return sampling.golden_sample(pairs.first_pairs(view(spark, sf_dir, "turns")), 60)


@query("golden_shortfall", f"""
    {_golden(5000)} SELECT count(*) AS n_rows, greatest(0, 5000 - count(*)) AS shortfall FROM sample""")
def golden_shortfall(spark, sf_dir):
    sample = sampling.golden_sample(pairs.first_pairs(view(spark, sf_dir, "turns")), 5000)
    return sampling.shortfall(sample, 5000)


@query("threads_roundtrip", f"{_walk_sql(BRAND)} SELECT * FROM thread_turns")
def threads_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "threads")
    write_threads(threads.build_threads(view(spark, sf_dir, "tweets"), BRAND), path)
    return read_threads(spark, path)


@query("golden_csv_roundtrip", f"""
    {PAIRS} SELECT CAST(thread_id AS VARCHAR) AS thread_id, customer_query, brand_response AS brand_response_actual,
           '' AS intent, '' AS escalate, '' AS escalation_reason, '' AS notes FROM pairs""")
def golden_csv_roundtrip(spark, sf_dir):
    found = pairs.first_pairs(view(spark, sf_dir, "turns"))
    golden = found.select("thread_id", "customer_query", F.col("brand_response").alias("brand_response_actual"),
                          *[F.lit("").alias(c) for c in ("intent", "escalate", "escalation_reason", "notes")])
    path = scratch_path(spark, "golden-csv")
    write_golden_csv(golden, path)
    return read_golden_csv(spark, path)


@query("golden_json_roundtrip", f"""
    {PAIRS} SELECT CAST(p.thread_id AS VARCHAR) AS thread_id, p.customer_query, s.n_turns
    FROM pairs p JOIN (SELECT thread_id, count(*) AS n_turns FROM turns GROUP BY thread_id) s ON s.thread_id = p.thread_id""")
def golden_json_roundtrip(spark, sf_dir):
    turns = view(spark, sf_dir, "turns")
    found = pairs.first_pairs(turns).withColumn("thread_id", F.col("thread_id").cast("string"))
    whole = pairs.thread_pages(turns.withColumn("thread_id", F.col("thread_id").cast("string")))
    path = scratch_path(spark, "golden-json")
    write_golden_json(found, whole, path, key="thread_id")
    rows = read_golden_json(spark, path).select("thread_id", "customer_query")
    pages = read_golden_threads(spark, path, key="thread_id")
    return rows.join(pages, "thread_id").groupBy("thread_id", "customer_query").agg(F.sum(F.size("full_thread")).alias("n_turns"))
