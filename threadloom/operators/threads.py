"""Thread rebuild: from every root, all messages that replies lead to, in the order of a queue.

The visit order is level first, then the order of the parents, then the order of the children. A
message that is missing, empty or mostly non-ASCII ends its branch.

Two ways give the same rows. Where every message has one parent, replies form trees: each message
finds its root by doubling its ancestor distance, so depth 1,000 takes ten rounds. Threads in which a
message can be met twice are walked level by level. No step gathers a whole thread in one task: the
children of a very popular message are split over salted groups or skew-join pieces, the order comes
from a distributed sort, and the running number is a sum over the small per-chunk counts of a thread.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from threadloom.functions.text import thread_key
from threadloom.operators import graph
from threadloom.operators.sampling import BROADCAST_SAMPLE, sample_rows
from threadloom.operators.tours import rank_messages
from threadloom.session import materialize, materialize_counted

# Children of one message per edge group, nodes per edge partition, short rows that may be broadcast.
GROUP_EDGES = 1_000_000
PARTITION_EDGES = 2_000_000
BROADCAST_ROWS = 100_000
# Branching levels whose order a row carries itself; deeper trees are ranked along their tours.
PATH_LEVELS = 16
# Levels merged into one table, to keep plans short on deep threads.
MERGE_LEVELS = 32

_VISIT = ["root", "tid", "level", "pos", "ok", "is_brand", "multi", "fan"]
_OUT = ["root", "tid", "level", "pos", "ok", "is_brand"]


def walk_edges(slim: DataFrame) -> DataFrame:
    """Edges a walk can use: kept source, existing target, one row per pair, target flags attached."""
    raw = graph.reply_edges(slim).where("src <> dst")
    order = graph.edge_order(F.col("kind"), F.col("place"))
    pairs = raw.groupBy("src", "dst").agg(F.min(order).alias("ord"))
    targets = slim.select(F.col("tweet_id").alias("dst"), "ok", "is_brand")
    sources = slim.where("ok").select(F.col("tweet_id").alias("src"))
    return materialize(pairs.join(targets, "dst").join(sources, "src", "left_semi"))


class Shape(NamedTuple):
    """What the edges look like: largest child and parent counts, roots that are replied into."""

    children: int
    parents: int
    entered_roots: int


def edge_shape(edges: DataFrame, roots: DataFrame) -> Shape:
    def most(column: str) -> DataFrame:
        sizes = edges.groupBy(column).agg(F.count("*").alias("n"))
        return sizes.agg(F.lit(column).alias("side"), F.coalesce(F.max("n"), F.lit(0)).alias("n"))

    entered = roots.join(edges.select(F.col("dst").alias("root")), "root", "left_semi")
    entered = entered.agg(F.lit("roots").alias("side"), F.count("*").alias("n"))
    found = {r["side"]: r["n"] for r in most("src").unionByName(most("dst")).unionByName(entered).collect()}
    return Shape(found["src"], found["dst"], found["roots"])


# --- trees: ancestor doubling ---------------------------------------------------------------

def split_irregular(edges: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges into messages with one parent, and the others: into a shared message or into a root."""
    shared = edges.groupBy("dst").agg(F.count("*").alias("n")).where("n > 1").select("dst")
    irregular = shared.unionByName(roots.select(F.col("root").alias("dst"))).distinct()
    return edges.join(irregular, "dst", "left_anti"), edges.join(irregular, "dst", "left_semi")


def _tree_rows(edges: DataFrame) -> DataFrame:
    """One row per message below a top. ``path`` holds the order among siblings, but only where there
    are siblings, so that long back-and-forth chains stay short rows. Beyond ``PATH_LEVELS`` it is null."""
    children = edges.groupBy("src").agg(F.count("*").alias("n_children"))
    several = children.where("n_children > 1").select("src", F.lit(True).alias("branching"))
    inner = children.select(F.col("src").alias("tid"), F.lit(True).alias("internal"))
    step = F.when(F.col("branching"), F.array("ord")).otherwise(F.array().cast("array<bigint>"))
    rows = edges.join(several, "src", "left").select(
        F.col("dst").alias("tid"), F.col("src").alias("anc"), F.lit(1).alias("dist"), step.alias("path"), "ok", "is_brand"
    )
    return rows.join(inner, "tid", "left").withColumn("internal", F.coalesce("internal", F.lit(False)))


def find_tops(edges: DataFrame, path_levels: int = PATH_LEVELS) -> tuple[DataFrame, int]:
    """Top, distance and sibling path of every message below a top, and the number of rows whose path
    would be longer than ``path_levels`` and is null instead. Every target has one parent.

    Each round joins the rows still on their way with the row of their current ancestor. A round that
    finishes nothing leaves only closed circles, which no top leads to.
    """
    columns = ["tid", "anc", "dist", "path", "ok", "is_brand", "internal"]
    active, finished, unordered = materialize(_tree_rows(edges)).select(*columns, F.lit(False).alias("done")), [], 0
    fits = F.size("up_path") + F.size("path") <= path_levels
    while True:
        ancestors = reduce(DataFrame.unionByName, [*finished, active]).where("internal").select(
            F.col("tid").alias("anc"), F.col("anc").alias("up"), F.col("dist").alias("up_dist"),
            F.col("path").alias("up_path"), F.col("done").alias("up_done"),
        )
        is_top = F.col("up").isNull()
        moved = active.drop("done").join(ancestors, "anc", "left").select(
            "tid",
            F.coalesce("up", "anc").alias("anc"),
            (F.col("dist") + F.coalesce("up_dist", F.lit(0))).alias("dist"),
            F.when(is_top, F.col("path")).when(fits, F.concat("up_path", "path")).alias("path"),
            "ok", "is_brand", "internal",
            F.coalesce("up_done", F.lit(True)).alias("done"),
        )
        table, counts = materialize_counted(moved, done=F.col("done"), unordered=F.col("done") & F.col("path").isNull())
        finished.append(table.where("done"))
        active = table.where("NOT done")
        unordered += counts["unordered"]
        if counts["done"] in (0, counts["rows"]):
            return reduce(DataFrame.unionByName, finished), unordered


def qualified_roots(visits: DataFrame, min_turns: int) -> DataFrame:
    """Roots whose visits include a brand message and enough kept ones."""
    sizes = visits.groupBy("root").agg(F.count_if("ok").alias("n_kept"), F.max("is_brand").alias("has_brand"))
    return sizes.where(F.col("has_brand") & (F.col("n_kept") >= min_turns)).select("root")


def tree_visits(edges: DataFrame, below: DataFrame, unordered: int, roots: DataFrame, min_turns: int) -> DataFrame:
    """Visits of the qualified trees under ``roots``; ``pos`` follows the sibling paths of a level, or, in a
    tree with a row that has none, the tour of the tree. Other trees are dropped before the sort."""
    members = below.select(F.col("anc").alias("root"), "tid", F.col("dist").alias("level"), "path", "ok", "is_brand")
    tops = roots.select(
        "root", F.col("root").alias("tid"), F.lit(0).alias("level"), F.array().cast("array<bigint>").alias("path"),
        F.lit(True).alias("ok"), "is_brand",
    )
    visits = members.unionByName(tops)
    chosen = qualified_roots(visits, min_turns).join(roots.select("root"), "root", "left_semi")
    visits = visits.join(chosen, "root", "left_semi")
    order = ["root", "level", "path", "tid"]
    if unordered:
        visits = materialize(visits)
        deep = visits.where("path IS NULL").select("root", F.lit(True).alias("deep")).distinct()
        visits = visits.join(deep, "root", "left").withColumn("path", F.when(F.col("deep").isNull(), F.col("path")))
        visits = materialize(visits.drop("deep"))
        inside = visits.where("path IS NULL").select(F.col("tid").alias("dst"))
        visits = visits.join(rank_messages(edges.join(inside, "dst", "left_semi")), "tid", "left")
        order = ["root", "level", "path", F.desc("rank"), "tid"]
    return visits.orderBy(*order).withColumn("pos", F.monotonically_increasing_id()).select(*_OUT)


def visit_threads(
    edges: DataFrame, roots: DataFrame, partitions: int = 1, max_levels: int = 10_000, group_edges: int = GROUP_EDGES,
    min_turns: int = 2,
) -> tuple[DataFrame, int]:
    """Stored visits of all qualified threads and the number of kept ones: trees by doubling, and a
    level walk for the roots that reach an irregular message."""
    shape = edge_shape(edges, roots)
    if shape.parents <= 1 and not shape.entered_roots:
        visits, counts = materialize_counted(tree_visits(edges, *find_tops(edges), roots, min_turns), kept=F.col("ok"))
        return visits, counts["kept"]
    regular, irregular = split_irregular(edges, roots)
    regular = materialize(regular)
    below, unordered = find_tops(regular)
    exits = irregular.select(F.col("src").alias("tid")).distinct()
    tops = exits.join(below.select("tid", "anc"), "tid", "left").select(F.coalesce("anc", "tid").alias("root")).distinct()
    tangled = materialize(roots.join(tops, "root", "left_semi"))
    clean = roots.join(tangled.select("root"), "root", "left_anti")
    visits, counts = materialize_counted(tree_visits(regular, below, unordered, clean, min_turns), kept=F.col("ok"))
    walked = walk(edges, tangled, shape, partitions, max_levels, group_edges)
    walked = walked.join(qualified_roots(walked, min_turns), "root", "left_semi")
    walked, more = materialize_counted(walked, kept=F.col("ok"))
    return visits.unionByName(walked), counts["kept"] + more["kept"]


# --- level walk -----------------------------------------------------------------------------

def _split_hot_sources(edges: DataFrame, group_edges: int, partitions: int) -> tuple[DataFrame, DataFrame]:
    """Spread the children of very popular messages over salts; ``fan`` tells a visit how many
    salted groups its own children have. The table of such messages has at most
    ``edges / group_edges`` rows."""
    sizes = edges.groupBy("src").agg(F.count("*").alias("n")).where(F.col("n") > group_edges)
    hot = materialize(sizes.select("src", F.ceil(F.col("n") / group_edges).cast("int").alias("groups")))
    salt = F.pmod(F.xxhash64("dst"), F.coalesce("groups", F.lit(1))).cast("int")
    salted = edges.join(hot, "src", "left").withColumn("salt", salt).drop("groups")
    onward = hot.withColumnRenamed("src", "dst")
    fanned = salted.drop("fan").join(onward, "dst", "left").withColumn("fan", F.coalesce("groups", F.lit(1))).drop("groups")
    return materialize(fanned.repartition(partitions, "src", "salt")), hot


def walk(
    edges: DataFrame, roots: DataFrame, shape: Shape, partitions: int = 1, max_levels: int = 10_000,
    group_edges: int = GROUP_EDGES,
) -> DataFrame:
    """Visits ``(root, tid, level, pos, ok, is_brand)``; ``pos`` orders the visits of a level.

    ``edges`` as made by :func:`walk_edges`; ``roots(root, is_brand)`` holds kept messages only.
    More levels than ``max_levels`` raise an error, nothing is cut off.
    """
    repeated, salted = shape.parents > 1, shape.children > group_edges
    frontier = roots.select(
        "root", F.col("root").alias("tid"), F.lit(0).alias("level"), F.lit(0).cast("bigint").alias("pos"),
        F.lit(True).alias("ok"), "is_brand", F.lit(False).alias("multi"), F.lit(1).alias("fan"),
    )
    shared = edges.groupBy("dst").agg((F.count("*") > 1).alias("multi"))
    edges = edges.join(shared, "dst") if repeated else edges.withColumn("multi", F.lit(False))
    edges = edges.withColumn("fan", F.lit(1))
    if not salted:
        edges = materialize(edges.repartition(partitions, "src"))
    else:
        edges, hot = _split_hot_sources(edges, group_edges, partitions)
        frontier = frontier.join(hot.withColumnRenamed("src", "tid"), "tid", "left")
        frontier = frontier.withColumn("fan", F.coalesce("groups", F.lit(1))).select(*_VISIT)
    done, levels, level, size = [], [frontier], 0, None
    while size != 0:
        level += 1
        if level > max_levels:
            raise RuntimeError(f"thread walk is deeper than {max_levels} levels")
        reached = _expand(frontier, edges, size, salted)
        if repeated:
            seen = reduce(DataFrame.unionByName, done + levels).where("multi").select("root", "tid")
            reached = _first_visits(reached, seen)
        ordered = reached.orderBy("root", "ppos", "ord", "tid")
        ordered = ordered.withColumn("pos", F.monotonically_increasing_id()).withColumn("level", F.lit(level))
        frontier, counts = materialize_counted(ordered.select(*_VISIT), expanding=F.col("ok"))
        size = counts["expanding"]
        if counts["rows"]:
            levels.append(frontier)
        if len(levels) == MERGE_LEVELS:
            done, levels = done + [materialize(reduce(DataFrame.unionByName, levels))], []
    return reduce(DataFrame.unionByName, done + levels).select(*_OUT)


def _expand(frontier: DataFrame, edges: DataFrame, size: int | None, salted: bool) -> DataFrame:
    """Children of the frontier. A step back to the own root is no visit."""
    parents = frontier.where("ok").select("root", F.col("tid").alias("src"), F.col("pos").alias("ppos"), "fan")
    keys = ["src"]
    if salted:
        parents = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("fan") - 1)))
        keys = ["src", "salt"]
    parents = parents.drop("fan")
    if size is not None and size <= BROADCAST_ROWS and not salted:
        parents = F.broadcast(parents)
    reached = edges.join(parents, keys).where("dst <> root")
    return reached.select("root", F.col("dst").alias("tid"), "ppos", "ord", "ok", "is_brand", "multi", "fan")


def _first_visits(reached: DataFrame, seen: DataFrame) -> DataFrame:
    """Only a message with several parents can be met twice; those keep their first meeting."""
    single = reached.where("NOT multi")
    several = reached.where("multi").groupBy("root", "tid").agg(
        F.min(F.struct("ppos", "ord", "ok", "is_brand", "multi", "fan")).alias("first")
    )
    several = several.join(seen, ["root", "tid"], "left_anti").select("root", "tid", "first.*")
    return single.unionByName(several)


def number_turns(visits: DataFrame) -> DataFrame:
    """Kept visits numbered from 0 inside their thread.

    Rows are numbered inside chunks (thread, level, sort partition). The offsets of the chunks come
    from their counts, so a huge thread costs one small row per chunk, not one big group.
    """
    chunk = ["root", "level", "chunk"]
    kept = visits.where("ok").withColumn("chunk", F.shiftright("pos", 33))
    counts = kept.groupBy(*chunk).agg(F.count("*").alias("n"))
    before = Window.partitionBy("root").orderBy("level", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*chunk, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy(*chunk).orderBy("pos", "tid"))
    seq = (F.col("offset") + F.col("place") - 1).alias("seq")
    return kept.withColumn("place", place).join(offsets, chunk).select("root", "tid", seq, "is_brand")


def build_threads(
    tweets: DataFrame,
    brand: str,
    *,
    exact_brand: bool = False,
    orphan_roots: bool = False,
    unique_ids: bool = False,
    max_levels: int = 10_000,
    group_edges: int = GROUP_EDGES,
    sample: tuple[int, int] | None = None,
) -> DataFrame:
    """Turns of all threads that involve ``brand``, or of a sample (size, seed) of them. Threads are
    sampled by their root ids, before their turns are numbered and any text is moved.

    ``thread_id`` is a short hash and may collide on very large data; group by ``root_id`` there.
    """
    nodes = graph.message_nodes(tweets, unique_ids)
    flagged = graph.flag_brand(nodes, graph.brand_authors(tweets, brand, exact_brand))
    slim, counts = materialize_counted(
        flagged.select("tweet_id", "ok", "is_brand", "is_inbound", "parent_id", "response_ids", "position")
    )
    partitions = max(1, math.ceil(counts["rows"] / PARTITION_EDGES))
    roots = graph.thread_roots(slim, orphan_roots).where("ok").select(F.col("tweet_id").alias("root"), "is_brand")
    visits, n_turns = visit_threads(walk_edges(slim), roots, partitions, max_levels, group_edges)
    if sample is not None:
        chosen = sample_rows(visits.where("ok").select("root").distinct(), "root", *sample)
        chosen = F.broadcast(chosen) if sample[0] <= BROADCAST_SAMPLE else chosen
        visits, kept = materialize_counted(visits.join(chosen, "root", "left_semi"), turns=F.col("ok"))
        n_turns = kept["turns"]
    # Other messages go before texts are cleaned: where they are read if the wanted ones are few, else
    # in a join by message id, whose partitioning the removal of repeated ids uses again.
    wanted = visits.where("ok").select(F.col("tid").alias("tweet_id")).distinct()
    wanted = F.broadcast(wanted) if n_turns <= BROADCAST_ROWS else wanted
    nodes = graph.message_nodes(tweets.join(wanted, "tweet_id", "left_semi"), unique_ids)
    turns = number_turns(visits).join(nodes.select(F.col("tweet_id").alias("tid"), "author_id", "text"), "tid")
    return turns.select(
        thread_key(F.col("root")).alias("thread_id"),
        F.col("root").alias("root_id"),
        F.lit(brand).alias("brand"),
        F.col("seq").cast("bigint").alias("seq"),
        F.when(F.col("is_brand"), "brand").otherwise("customer").alias("role"),
        "author_id",
        "text",
        F.col("tid").alias("tweet_id"),
    )


def thread_sizes(turns: DataFrame, key: str = "thread_id") -> DataFrame:
    return turns.groupBy(key).agg(
        F.count("*").alias("n_turns"),
        F.count_if(F.col("role") == "customer").alias("n_customer"),
        F.count_if(F.col("role") == "brand").alias("n_brand"),
    )


def thread_summary(turns: DataFrame, key: str = "thread_id") -> DataFrame:
    """One row of data set totals and turn statistics."""
    return thread_sizes(turns, key).agg(
        F.count("*").alias("n_threads"),
        F.sum("n_customer").alias("customer_messages"),
        F.sum("n_brand").alias("brand_messages"),
        F.round(F.avg("n_turns"), 4).alias("avg_turns"),
        F.median("n_turns").alias("median_turns"),
        F.max("n_turns").alias("max_turns"),
        F.min("n_turns").alias("min_turns"),
    )
