"""Text functions over messages, documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom import constants as C
from threadloom.functions import text as X
from threadloom.operators import retrieval
from threadloom.operators.graph import keep_last
from threadloom.operators.sampling import prefix_dedup
from threadloom.plans.catalog.base import (
    query, sql_ascii_share, sql_cap, sql_clean, sql_mask, sql_mentions, sql_ok, sql_prefix, sql_quote, sql_tidy,
    sql_truthy, table, view, with_views,
)


@query("clean_text", f"{with_views('tweets')} SELECT tweet_id, {sql_clean('text')} AS text FROM tweets")
def clean_text(spark, sf_dir):
    return view(spark, sf_dir, "tweets").select("tweet_id", X.clean_text(F.col("text")).alias("text"))


@query("clean_documents", f"SELECT doc_id, {sql_clean('text')} AS text FROM documents")
def clean_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.clean_text(F.col("text")).alias("text"))


@query("mask_urls", f"SELECT page_id, {sql_mask('url')} AS url FROM pages")
def mask_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.mask_urls(F.col("url")).alias("url"))


@query("strip_mentions", f"SELECT doc_id, {sql_mentions('text')} AS text FROM documents")
def strip_mentions(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.strip_mentions(F.col("text")).alias("text"))


@query("ascii_english_filter", f"SELECT doc_id, n_chars FROM documents WHERE {sql_ok('text')}")
def ascii_english_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(X.is_mostly_ascii(F.col("text"))).select("doc_id", "n_chars")


@query("english_heuristic_quality", f"""
    SELECT lang, count(*) AS n, count(*) FILTER ({sql_ok('text')}) AS n_pass,
           round(avg({sql_ascii_share('text')}), 4) AS mean_ascii_share
    FROM documents GROUP BY lang""")
def english_heuristic_quality(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count("*").alias("n"),
        F.count_if(X.is_mostly_ascii(text)).alias("n_pass"),
        F.round(F.avg(X.ascii_share(text)), 4).alias("mean_ascii_share"),
    )


@query("parse_bool_flags", f"{with_views('tweets')} SELECT tweet_id, {sql_truthy('inbound')} AS is_inbound FROM tweets")
def parse_bool_flags(spark, sf_dir):
    return view(spark, sf_dir, "tweets").select("tweet_id", X.truthy(F.col("inbound")).alias("is_inbound"))


@query("explode_reply_lists", f"""
    {with_views('tweets')}
    SELECT tweet_id, CAST(row_number() OVER (PARTITION BY tweet_id ORDER BY i) - 1 AS BIGINT) AS place, child_id
    FROM (SELECT tweet_id, unnest(range(len(string_split(response_tweet_id, ',')))) AS i,
                 trim(unnest(string_split(response_tweet_id, ','))) AS child_id
          FROM tweets WHERE response_tweet_id NOT IN ('', 'nan', 'None', 'NaN')) parts
    WHERE child_id <> ''""")
def explode_reply_lists(spark, sf_dir):
    lists = X.split_ids(X.null_if_missing(F.col("response_tweet_id")))
    exploded = view(spark, sf_dir, "tweets").select("tweet_id", F.posexplode(lists))
    return exploded.select("tweet_id", F.col("pos").cast("bigint").alias("place"), F.col("col").alias("child_id"))


@query("thread_keys", f"{with_views('tweets')} SELECT tweet_id, substring(md5(tweet_id), 1, 12) AS thread_id FROM tweets")
def thread_keys(spark, sf_dir):
    return view(spark, sf_dir, "tweets").select("tweet_id", X.thread_key(F.col("tweet_id")).alias("thread_id"))


@query("prefix_key", f"SELECT doc_id, {sql_prefix('text')} AS prefix FROM documents")
def prefix_key(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.prefix_key(F.col("text")).alias("prefix"))


@query("prefix_dedup", f"""
    SELECT doc_id, prefix FROM (
      SELECT doc_id, prefix, row_number() OVER (PARTITION BY prefix ORDER BY doc_id) AS rn
      FROM (SELECT doc_id, {sql_prefix('text')} AS prefix FROM documents) keyed) ranked WHERE rn = 1""")
def prefix_dedup_query(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return prefix_dedup(documents, "text", "doc_id").select("doc_id", "prefix")


_QUOTED = "concat(' \"', text, '\" ')"


@query("reply_postprocess", f"""
    SELECT doc_id, coalesce({sql_cap('tidy')}, {sql_quote(C.REPLY_ON_ERROR)}) AS reply
    FROM (SELECT doc_id, {sql_tidy(f"CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN {_QUOTED} ELSE text END")} AS tidy
          FROM documents) tidied""")
def reply_postprocess(spark, sf_dir):
    from threadloom.operators.predictions import finish_reply

    answer = F.expr(f"CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN {_QUOTED} ELSE text END")
    return table(spark, sf_dir, "documents").select("doc_id", finish_reply(answer).alias("reply"))


@query("text_previews", r"""
    SELECT doc_id, regexp_replace(substring(text, 1, 120), '[^\x00-\x7F]', '?', 'g') AS preview FROM documents""")
def text_previews(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.ascii_preview(F.col("text"), 120).alias("preview"))


@query("tweet_lookup_dedup", f"""
    {with_views('reposts')}
    SELECT tweet_id, text, position FROM (
      SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY position DESC) AS rn FROM reposts) ranked
    WHERE rn = 1""")
def tweet_lookup_dedup(spark, sf_dir):
    return keep_last(view(spark, sf_dir, "reposts"), "tweet_id", "position").select("tweet_id", "text", "position")


@query("tfidf_embed", r"""
    WITH rows AS (SELECT row_number() OVER () AS n, doc_id, text FROM documents),
    words AS (SELECT n, unnest(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+')) AS word FROM rows),
    counts AS (SELECT n, CAST(concat('0x', substring(md5(word), 1, 8)) AS BIGINT) % 256 AS bucket, count(*) AS tf FROM words WHERE word <> '' GROUP BY 1, 2),
    held AS (SELECT bucket, ln(((SELECT count(*) FROM rows) + 1) / (count(*) + 1)) AS scale FROM counts GROUP BY bucket),
    weights AS (SELECT n, bucket, tf * scale AS w FROM counts JOIN held USING (bucket)),
    lengths AS (SELECT n, sqrt(sum(w * w)) AS length FROM weights GROUP BY n),
    places AS (SELECT n, doc_id, unnest(range(256)) AS bucket FROM rows),
    vectors AS (
      SELECT p.n, p.doc_id, p.bucket, coalesce(w.w / CASE WHEN l.length > 0 THEN l.length ELSE 1 END, 0) AS value
      FROM places p LEFT JOIN weights w ON w.n = p.n AND w.bucket = p.bucket LEFT JOIN lengths l ON l.n = p.n)
    SELECT doc_id, CAST(count(*) AS INTEGER) AS dimensions, round(sqrt(sum(value * value)), 6) AS length,
           string_agg(CAST(CAST(round(value * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY bucket) AS millionths
    FROM vectors GROUP BY n, doc_id""")
def tfidf_embed(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = retrieval.text_vectors(documents, "doc_id")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x * x))
    millionths = F.transform("embedding", lambda x: F.round(x * 1000000).cast("bigint").cast("string"))
    return encoded.select(
        "doc_id", F.size("embedding").alias("dimensions"), F.round(length, 6).alias("length"), F.array_join(millionths, ",").alias("millionths"))
