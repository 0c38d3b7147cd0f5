"""Message graph: nodes, brand authors, roots and reply edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.functions.text import clean_text, is_mostly_ascii, null_if_missing, split_ids
from threadloom.session import materialize
from threadloom.sources.tweets import with_inbound_flag

# Children named in a parent's own list come after those that point to it.
LIST_BASE = 1 << 62

# Author sets up to this size become a literal set inside the plan, larger ones are joined.
LITERAL_AUTHORS = 10_000


def message_position(tweets: DataFrame) -> Column:
    """File order: the ``position`` column when there is one, else the numeric message id. Other ids
    have no order of their own, so they need a ``position``; without one the job fails."""
    if "position" in tweets.columns:
        return F.col("position").cast("bigint")
    missing = F.raise_error(F.concat(F.lit("message id without a number needs a position column: "), F.col("tweet_id")))
    number = F.col("tweet_id").try_cast("bigint")
    return F.when(number.isNull() & F.col("tweet_id").isNotNull(), missing.cast("bigint")).otherwise(number)


def keep_last(df: DataFrame, key: str, position: str) -> DataFrame:
    """One row per key, the last one. The planner limits each map task to one row per key first."""
    ties = F.xxhash64(*[F.col(c) for c in df.columns])
    order = Window.partitionBy(key).orderBy(F.col(position).desc(), ties.desc())
    return df.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def message_nodes(tweets: DataFrame, unique_ids: bool = False) -> DataFrame:
    """One row per message id with cleaned text. ``ok`` marks text a thread keeps; ``unique_ids``
    skips the shuffle that removes repeated ids when the source rules them out. Of repeated ids the
    last by ``position`` stays; without that column their order is unknown, and one of them stays."""
    text = clean_text(F.col("text"))
    nodes = with_inbound_flag(tweets).select(
        "tweet_id",
        "author_id",
        "is_inbound",
        text.alias("text"),
        null_if_missing(F.col("in_response_to_tweet_id")).alias("parent_id"),
        null_if_missing(F.col("response_tweet_id")).alias("response_ids"),
        message_position(tweets).alias("position"),
    )
    nodes = nodes.withColumn("ok", is_mostly_ascii(F.col("text")))
    return nodes if unique_ids else keep_last(nodes, "tweet_id", "position")


def outbound_authors(tweets: DataFrame) -> DataFrame:
    """Authors of messages that are not inbound, with their message counts."""
    outbound = with_inbound_flag(tweets).where(~F.col("is_inbound"))
    return outbound.groupBy("author_id").agg(F.count("*").alias("n_messages"))


def top_outbound_authors(tweets: DataFrame, n: int = 20) -> DataFrame:
    return outbound_authors(tweets).orderBy(F.desc("n_messages"), "author_id").limit(n)


def matches_brand(author: Column, brand: str, exact: bool = False) -> Column:
    """Brand name inside the author name or the other way round, in any case."""
    wanted, name = F.lit(brand.lower()), F.lower(author)
    return (name == wanted) if exact else F.contains(name, wanted) | F.contains(wanted, name)


def brand_authors(tweets: DataFrame, brand: str, exact: bool = False) -> DataFrame:
    """Outbound authors that match the brand; when none does, the most prolific one. The messages
    are read once, for the table of authors; the choice is made on that."""
    authors = materialize(outbound_authors(tweets))
    matched = authors.withColumn("matched", matches_brand(F.col("author_id"), brand, exact))
    any_match = matched.agg(F.max("matched")).scalar()
    busiest = authors.orderBy(F.desc("n_messages"), "author_id").limit(1).select("author_id").scalar()
    chosen = F.when(any_match, F.col("matched")).otherwise(F.col("author_id") == busiest)
    return matched.where(chosen).select("author_id", "n_messages")


def flag_brand(nodes: DataFrame, authors: DataFrame) -> DataFrame:
    """Add ``is_brand``. A small author set is inlined, so the nodes need no shuffle."""
    ids = authors.select("author_id")
    head = [row[0] for row in ids.limit(LITERAL_AUTHORS + 1).collect()]
    if len(head) <= LITERAL_AUTHORS:
        return nodes.withColumn("is_brand", F.coalesce(F.col("author_id").isin(head), F.lit(False)))
    flagged = ids.withColumn("is_brand", F.lit(True))
    return nodes.join(flagged, "author_id", "left").withColumn("is_brand", F.coalesce("is_brand", F.lit(False)))


def thread_roots(nodes: DataFrame, orphan_roots: bool = False) -> DataFrame:
    """Inbound messages without a parent; ``orphan_roots`` adds those whose parent is not in the data."""
    inbound = nodes.where("is_inbound")
    roots = inbound.where(F.col("parent_id").isNull())
    if orphan_roots:
        known = nodes.select(F.col("tweet_id").alias("parent_id"))
        roots = roots.unionByName(inbound.where(F.col("parent_id").isNotNull()).join(known, "parent_id", "left_anti"))
    return roots


def reply_edges(nodes: DataFrame) -> DataFrame:
    """Edges parent to child: ``kind`` 0 from the child's parent id, ``kind`` 1 from the parent's list."""
    replies = nodes.where(F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("src"), F.col("tweet_id").alias("dst"), F.lit(0).alias("kind"),
        F.col("position").alias("place"),
    )
    listed = nodes.select(F.col("tweet_id").alias("src"), F.posexplode(split_ids(F.col("response_ids"))))
    listed = listed.select(
        "src", F.col("col").alias("dst"), F.lit(1).alias("kind"), F.col("pos").cast("bigint").alias("place")
    )
    return replies.unionByName(listed)


def edge_order(kind: Column, place: Column) -> Column:
    """Both parts of the child order in one number."""
    return F.when(kind == 0, place).otherwise(F.lit(LIST_BASE) + place)
