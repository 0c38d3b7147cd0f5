"""First question and first answer of every thread, and the nested view of a thread."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom import constants as C
from threadloom.schemas import TURN
from threadloom.session import materialize_counted

# Turns per nested row. Longer threads continue on further pages, nothing is left out.
PAGE_TURNS = 1_000
# Threads (id and one number each) that may be broadcast.
BROADCAST_ROWS = 100_000


def _spoken(role: str) -> Column:
    return F.when((F.col("role") == role) & (F.coalesce("text", F.lit("")) != ""), F.struct("seq", "text"))


def first_pairs(turns: DataFrame, key: str = "thread_id", carry: Sequence[str] = ()) -> DataFrame:
    """``(key, customer_seq, customer_query, brand_seq, brand_response)`` per thread that has both.

    The first customer turn and the first brand turn are mergeable aggregates, so each map task
    sends one row per thread. These rows are stored once. Only threads whose brand spoke before the
    customer need a second look at the turns, and usually there are none or few.
    """
    carried = [F.min(c).alias(c) for c in carry]
    firsts = turns.groupBy(key).agg(
        F.min(_spoken("customer")).alias("c"), F.min(_spoken("brand")).alias("b"), *carried
    ).where("c IS NOT NULL AND b IS NOT NULL")
    brand_first = F.col("b.seq") < F.col("c.seq")
    firsts, counts = materialize_counted(firsts, waiting=brand_first)
    pairs = firsts.where(~brand_first)
    if counts["waiting"]:
        late = _late_answers(turns, key, firsts.where(brand_first).drop("b"), counts["waiting"])
        pairs = pairs.unionByName(late.select(*pairs.columns))
    return pairs.select(
        key,
        *carry,
        F.col("c.seq").alias("customer_seq"),
        F.col("c.text").alias("customer_query"),
        F.col("b.seq").alias("brand_seq"),
        F.col("b.text").alias("brand_response"),
    )


def _late_answers(turns: DataFrame, key: str, waiting: DataFrame, n_waiting: int) -> DataFrame:
    """First brand turn after the question, for threads that do not start with the question."""
    asked = waiting.select(key, F.col("c.seq").alias("asked"))
    if n_waiting <= BROADCAST_ROWS:
        asked = F.broadcast(asked)
    answers = turns.where(_spoken("brand").isNotNull()).select(key, F.struct("seq", "text").alias("b"))
    later = answers.join(asked, key).where("b.seq > asked")
    return waiting.join(later.groupBy(key).agg(F.min("b").alias("b")), key)


def first_turns(turns: DataFrame, n: int = C.CONTEXT_TURNS, key: str = "thread_id") -> DataFrame:
    """The first ``n`` turns of every thread; map tasks already keep no more than ``n`` per thread."""
    order = Window.partitionBy(key).orderBy("seq")
    return turns.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def _turn_fields(turns: DataFrame) -> Column:
    return F.struct(*[c for c in TURN.fieldNames() if c in turns.columns])


def thread_context(turns: DataFrame, n: int = C.CONTEXT_TURNS, key: str = "thread_id") -> DataFrame:
    """First turns as one array; at most ``n`` elements per thread reach a group."""
    head = first_turns(turns, n, key)
    return head.groupBy(key).agg(F.array_sort(F.collect_list(_turn_fields(turns))).alias("context"))


def thread_pages(turns: DataFrame, keys: Sequence[str] = ("thread_id",), page_turns: int = PAGE_TURNS) -> DataFrame:
    """Whole threads as arrays of at most ``page_turns`` turns; a usual thread has page 0 only."""
    page = F.floor(F.col("seq") / page_turns).alias("page")
    return turns.groupBy(*keys, page).agg(F.array_sort(F.collect_list(_turn_fields(turns))).alias("turns"))
