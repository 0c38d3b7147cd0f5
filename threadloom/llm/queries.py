"""The registered queries of the corpus operators, with the SQL that checks them where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.llm import language, quality
from threadloom.llm.common import held_out, materialize, prepare, temporary
from threadloom.llm.decontaminate import decontaminate
from threadloom.llm.jaccard import similar_groups
from threadloom.llm.lexical import build_index, search
from threadloom.llm.packing import pack
from threadloom.llm.periodic import find_runs, strongest
from threadloom.llm.secrets import labelled_samples, scan, spelled, train
from threadloom.llm.sharding import assign_shards
from threadloom.llm.token_files import read_tokens, write_tokens
from threadloom.llm.url_filters import judge_urls
from threadloom.llm.vectors import near_vectors
from threadloom.llm.word_bpe import decode_words, encode_words
from threadloom.session import scratch_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=2, capacity=1024)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query("op2_secret_scans")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(labelled_samples(docs)))
    base = F.filter("secrets", lambda s: s["kind"] != "markov")

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(spelled(base), 256).alias("base_sha256"),
        spelled(F.col("secrets")).alias("spans"), count("markov"),
    )


@query("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return assign_shards(docs, ["doc_id", "text_crc32", "size"], shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op4_embedding_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.93)


@query("op5_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return hit.select(
        "doc_id", "hit.n_words", "hit.n_hit", F.size("hit.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit.items", ","), 256).alias("items_sha256"), contaminated(F.col("hit")).alias("contaminated"))


def contaminated(hit: Column) -> Column:
    """Any hit word, and 5 % of the words or more."""
    return (hit["n_hit"] > 0) & (20 * hit["n_hit"] >= hit["n_words"])


@query("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "token-files")
    write_tokens(docs, public_tokenizers.path(TOKENIZER), path, end_id=0)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_ngram_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"), size=5, percent=80)


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out()).select("doc_id", "quality")
    scored = quality.score_quality(docs, quality.fit(docs, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    known = language.identify(docs.select("doc_id", "text"), model)
    return known.select(
        "doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


# The rules of the contract.
URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)

OP10_SQL = r"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
numbered AS (SELECT row_number() OVER () AS n, page_id, url FROM pages),
parts AS (
  SELECT n, page_id,
    CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN '' ELSE substring(url, strpos(url, '://') + 3) END AS rest
  FROM numbered),
split AS (
  SELECT n, page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
fits AS (
  SELECT n, concat(rule_host, rule_path) AS rule, verdict,
    row_number() OVER (PARTITION BY n ORDER BY length(concat(rule_host, rule_path)) DESC, verdict = 'block' DESC) AS place
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, concat('.', rule_host))) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN (SELECT n, rule, verdict FROM fits WHERE place = 1) best USING (n)
"""


@query("op10_url_filters", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT row_number() OVER () AS n, doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents)
  GROUP BY ALL),
lengths AS (SELECT n, CAST(sum(tf) AS BIGINT) AS own FROM words GROUP BY n),
totals AS (SELECT count(*) AS docs, CAST(sum(own) AS BIGINT) AS terms FROM lengths),
norms AS (SELECT n, 75 + (25 * own * docs) // terms AS m FROM lengths, totals),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM words, totals GROUP BY term, docs),
asked AS (
  SELECT i, item_id, term, count(*) AS repeats
  FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)
  GROUP BY ALL),
scores AS (
  SELECT i, item_id, n, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN words USING (term) JOIN norms USING (n)
  GROUP BY i, item_id, n, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query("op11_lexical_search", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    with temporary(spark) as keep:
        index = build_index(table(spark, sf_dir, "documents"), keep)
        return materialize(search(index, table(spark, sf_dir, "benchmark"), keep, k=20))


@query("op12_word_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_TOKENIZER)
    with temporary(spark) as keep:
        decoded = decode_words(encode_words(table(spark, sf_dir, "documents"), path, keep), path)
        return materialize(decoded.select(
            "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")))


def periodic_text(key: str, text: str) -> Column:
    """The text, in a tenth of the documents with a periodic end: let h be the crc32 of the key's
    decimals and g = h div 10. If h % 10 is 0, the n words from a = g % n on are original word
    a + (i - a) % p, with p = 1 + (n - a) div (3 + g % 8), and one space joins all words."""
    return F.expr(f"""
        CASE WHEN crc32(cast(cast({key} AS string) AS binary)) % 10 = 0 AND size(own_words) > 0 THEN array_join(
            transform(own_words, (w, i) -> CASE WHEN i < turn THEN w
                ELSE own_words[cast(turn + (i - turn) % (1 + (size(own_words) - turn) div (3 + grain % 8)) AS int)] END), ' ')
        ELSE {text} END""")


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Only the texts that are changed are cut into words here.
    own_words = F.expr(r"""CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 10 = 0
        THEN filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', -1), w -> w <> '') END""")
    docs = docs.withColumns({"own_words": own_words, "grain": F.expr("crc32(cast(cast(doc_id AS string) AS binary)) div 10")})
    docs = docs.withColumn("turn", F.expr("CASE WHEN size(own_words) > 0 THEN grain % size(own_words) END"))
    found = find_runs(docs.select("doc_id", periodic_text("doc_id", "text").alias("text")), into="periodic")
    runs, best = F.col("periodic.runs"), F.col("best")
    spelled = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", strongest(runs)).select(
        "doc_id", F.size(runs).cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(spelled, 256).alias("runs_sha256"), F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"))
