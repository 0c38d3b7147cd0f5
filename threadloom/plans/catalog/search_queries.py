"""Vector search over the embeddings and over conversation pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions.vectors import dot, l2_normalize, norm
from threadloom.operators import pairs, pivots, retrieval
from threadloom.plans.catalog.base import query, table, view
from threadloom.plans.catalog.conversation_queries import PAIRS
from threadloom.session import scratch_path
from threadloom.sources.tables import read_vectors, write_vectors

_UNIT = """unit AS (
    SELECT vec_id, list_transform(v, lambda x: x / CASE WHEN n > 0 THEN n ELSE 1 END) AS v
    FROM (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS n
          FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) raw) sized)"""


def _top(queries: str, documents: str, k: int, condition: str = "TRUE") -> str:
    return f"""hits AS (
      SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
      FROM (SELECT q.id AS query_id, d.id AS doc_id, round(list_inner_product(q.v, d.v), 9) AS score
            FROM {queries} q JOIN {documents} d ON {condition}) scored
      QUALIFY rank <= {k})"""


_ALL = "docs AS (SELECT vec_id AS id, v FROM unit)"
_HITS = "SELECT query_id, rank, doc_id, round(score, 6) AS score FROM hits"


def _rounded(hits):
    return hits.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", F.round("score", 6).alias("score"))


def _embeddings(spark, sf_dir):
    return retrieval.vector_side(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@query("l2_normalize", f"WITH {_UNIT} SELECT vec_id, round(v[1], 6) AS first, round(list_inner_product(v, v), 6) AS squared FROM unit")
def l2_normalize_query(spark, sf_dir):
    unit = table(spark, sf_dir, "embeddings").withColumn("v", l2_normalize(F.col("embedding")))
    return unit.select("vec_id", F.round(F.get("v", F.lit(0)), 6).alias("first"), F.round(dot(F.col("v"), F.col("v")), 6).alias("squared"))


@query("cosine_pairs", f"""
    WITH {_UNIT} SELECT a.vec_id, b.vec_id AS next_id, round(list_inner_product(a.v, b.v), 6) AS cosine
    FROM unit a JOIN unit b ON b.vec_id = a.vec_id + 1""")
def cosine_pairs(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("next_id"), F.col("embedding").alias("b"))
    both = vectors.join(following, "vec_id")
    cosine = dot(F.col("embedding"), F.col("b")) / (norm(F.col("embedding")) * norm(F.col("b")))
    return both.select("vec_id", "next_id", F.round(cosine, 6).alias("cosine"))


@query("knn_topk", f"WITH {_UNIT}, {_ALL}, {_top('docs', 'docs', 3)} {_HITS}")
def knn_topk(spark, sf_dir):
    documents = _embeddings(spark, sf_dir)
    return _rounded(retrieval.knn_topk(documents, documents))


@query("knn_topk_other_threads", f"WITH {_UNIT}, {_ALL}, {_top('docs', 'docs', 3, 'q.id <> d.id')} {_HITS}")
def knn_topk_other_threads(spark, sf_dir):
    documents = _embeddings(spark, sf_dir)
    return _rounded(retrieval.knn_topk(documents, documents, exclude_self=True))


@query("knn_topk_grid", f"WITH {_UNIT}, {_ALL}, {_top('docs', 'docs', 3)} {_HITS}")
def knn_topk_grid(spark, sf_dir):
    """Two sides that both count as large: the queries go in turns."""
    documents = _embeddings(spark, sf_dir)
    return _rounded(retrieval.knn_topk(documents, documents, way="turns", turn_rows=1_000))


@query("knn_pruned", f"WITH {_UNIT}, {_ALL}, {_top('docs', 'docs', 3)} {_HITS}")
def knn_pruned(spark, sf_dir):
    documents = _embeddings(spark, sf_dir)
    return _rounded(pivots.knn_pruned(documents, pivots.build_pivot_index(documents)))


@query("vector_table_roundtrip", f"""WITH {_UNIT}, {_ALL}, {_top('docs', 'docs', 3)}
    SELECT h.query_id, h.rank, h.doc_id, round(h.score, 6) AS score, e.label, round(u.v[1], 6) AS first
    FROM hits h JOIN embeddings e ON e.vec_id = h.doc_id JOIN unit u ON u.vec_id = h.doc_id""")
def vector_table_roundtrip(spark, sf_dir):
    """Search in a stored table in buckets; the hits fetch their documents without moving these."""
    path = scratch_path(spark, "vectors")
    write_vectors(table(spark, sf_dir, "embeddings").withColumn("embedding", l2_normalize(F.col("embedding"))), path, "vec_id", buckets=8)
    stored = read_vectors(spark, path)
    documents = retrieval.vector_side(stored, "vec_id", "embedding", normalize=False)
    found = retrieval.with_documents(retrieval.knn_topk(documents, documents), stored, "vec_id", ("label", "embedding"), broadcast_hits=0)
    return found.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", F.round("score", 6).alias("score"), "label",
        F.round(F.get("embedding", F.lit(0)), 6).alias("first"),
    )


_CORPUS = f"""{PAIRS}, {_UNIT},
    corpus AS (SELECT p.*, u.v, p.thread_id AS id FROM pairs p JOIN unit u ON u.vec_id = p.thread_id)"""


def _corpus(spark, sf_dir):
    found = pairs.first_pairs(view(spark, sf_dir, "turns"))
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("thread_id"), "embedding")
    return retrieval.retrieval_corpus(found, vectors)


def _corpus_hits(spark, sf_dir):
    corpus = _corpus(spark, sf_dir)
    documents = retrieval.vector_side(corpus, "thread_id", "embedding", normalize=False)
    hits = retrieval.knn_topk(documents, documents)
    return retrieval.with_documents(hits, corpus)


@query("retrieval_corpus", f"{_CORPUS} SELECT thread_id, customer_query, brand_response, round(v[1], 6) AS first, len(v) AS dimensions FROM corpus")
def retrieval_corpus(spark, sf_dir):
    return _corpus(spark, sf_dir).select(
        "thread_id", "customer_query", "brand_response", F.round(F.get("embedding", F.lit(0)), 6).alias("first"),
        F.size("embedding").cast("bigint").alias("dimensions"),
    )


_NESTED = f"""{_CORPUS}, {_top('corpus', 'corpus', 3)},
    texts AS (SELECT h.query_id, h.rank, h.score, c.customer_query, c.brand_response
              FROM hits h JOIN corpus c ON c.thread_id = h.doc_id)"""


@query("knn_topk_nested", f"""
    {_NESTED} SELECT query_id, count(*) AS n_neighbours, string_agg(customer_query, chr(10) ORDER BY rank) AS queries,
           string_agg(brand_response, chr(10) ORDER BY rank) AS responses, round(max(score), 6) AS best
    FROM texts GROUP BY query_id""")
def knn_topk_nested(spark, sf_dir):
    nested = retrieval.neighbours_nested(_corpus_hits(spark, sf_dir))
    similar = F.col("similar_threads")
    return nested.select(
        "query_id", F.size(similar).cast("bigint").alias("n_neighbours"),
        F.array_join(similar["query"], "\n").alias("queries"), F.array_join(similar["response"], "\n").alias("responses"),
        F.round(F.get(similar, F.lit(0))["score"], 6).alias("best"),
    )


@query("retrieval_context", f"""
    {_NESTED} SELECT query_id, string_agg(concat('Example ', rank, ' (similarity: ', printf('%.2f', score), '):', chr(10),
             '  Customer: ', customer_query, chr(10), '  Brand response: ', brand_response), chr(10) || chr(10) ORDER BY rank) AS context
    FROM texts GROUP BY query_id""")
def retrieval_context(spark, sf_dir):
    nested = retrieval.neighbours_nested(_corpus_hits(spark, sf_dir))
    return retrieval.retrieval_context(nested).select("query_id", "context")


@query("knn_leak_rate", f"""
    {_CORPUS}, {_top('corpus', 'corpus', 3)}
    SELECT count(*) AS n_queries, CAST(sum(leaked) AS BIGINT) AS n_leaked, round(avg(leaked), 4) AS leak_rate
    FROM (SELECT query_id, max(CASE WHEN query_id = doc_id THEN 1 ELSE 0 END) AS leaked FROM hits GROUP BY query_id) own""")
def knn_leak_rate(spark, sf_dir):
    documents = retrieval.vector_side(_corpus(spark, sf_dir), "thread_id", "embedding", normalize=False)
    return retrieval.leak_rate(retrieval.knn_topk(documents, documents))
