"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. ``run`` writes each stage's rows as Parquet in the shared folder and reads them
again as the next one's input, so a lost executor never costs more than its stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.llm import language
from threadloom.llm.common import fresh, held_out, prepare, stored
from threadloom.llm.decontaminate import decontaminate
from threadloom.llm.jaccard import similar_groups
from threadloom.llm.packing import pack
from threadloom.llm.queries import TOKENIZER, contaminated
from threadloom.llm.secrets import labelled_samples, redact, scan, train

# A text whose best language has less than this share of the likelihood is rejected.
LEAST_LANGUAGE_SCORE = 0.5
# Dropped keys up to this many are sent to the documents; more are removed by a shuffle join.
BROADCAST_KEYS = 1_000_000


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID. Documents without a letter (null and empty ones too) go, and those of which no
    language is likelier than all others together. Repeated rows and rows without a key stay. Where no
    language can be learned (no row with text has one), all documents with a letter stay."""
    prepare(spark)
    model = language.fit(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    if not model.languages:
        return docs.filter(language.has_letters(F.col("text")))
    [found] = fresh(docs.columns, "_language")
    known = language.identify(docs, model, out=found)
    kept = (F.col(found)["lang"] != "und") & (F.col(found)["score"] >= LEAST_LANGUAGE_SCORE)
    return known.filter(kept).select(*docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join. Of each group of similar documents the one with the smallest key stays.
    Where keys repeat or are null, rows count as documents of their own, in the order of the table."""
    prepare(spark)
    ids = docs.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("distinct")).first()
    key, rows = "doc_id", docs
    if ids["n"] != ids["distinct"]:
        [key] = fresh(docs.columns, "_row")
        rows = docs.withColumn(key, F.monotonically_increasing_id())
    groups = similar_groups(rows, key=key)
    dropped = groups.filter(F.col("component_id") != F.col(key)).select(key)
    dropped = F.broadcast(dropped) if dropped.count() <= BROADCAST_KEYS else dropped
    return rows.join(dropped, key, "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination. Documents of which 5 % of the words or more, and one at least, lie
    in passages of the benchmark go; others stay as they are."""
    [aside] = fresh(docs.columns, "_hit_column")
    hit = decontaminate(docs.withColumnRenamed("hit", aside), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    clean = hit.filter(~contaminated(F.col("hit"))).drop("hit")
    return clean.withColumnRenamed(aside, "hit").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans. Every found span is replaced by [SECRET], and n_chars follows; all documents stay."""
    model = train(labelled_samples(docs.select("text")))
    [aside] = fresh(docs.columns, "_secrets_column")
    found = scan(docs.withColumnRenamed("secrets", aside), model)
    any_ = F.size("secrets") > 0
    masked = found.withColumn("text", redact(F.col("text"), F.col("secrets")))
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(any_, count).otherwise(F.col("n_chars")))
    return masked.drop("secrets").withColumnRenamed(aside, "secrets").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 1024 ids: a row per piece, with its ids and its place."""
    return pack(docs, public_tokenizers.path(TOKENIZER), end_id=2, capacity=1024)


STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard_join", keep_one_of_similar),
    ("decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

# Tokenising and the fitted language model have no SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
