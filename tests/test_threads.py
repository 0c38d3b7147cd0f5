import random
from collections import deque
from functools import partial

import pytest

from threadloom.functions.text import thread_key
from threadloom.operators import graph, threads, tours
from threadloom.schemas import TWEETS
from pyspark.sql import functions as F


def tweet(i, parent="", responses="", author=None, inbound="True", text="hello there"):
    return (str(i), author or f"u{i}", inbound, "", text, responses, str(parent))


def frame(spark, rows):
    return spark.createDataFrame(rows, TWEETS)


def queue_walk(rows, brand):
    """Plain queue walk over the same messages: {root: [message ids in visit order]}."""
    last = {r[0]: r for r in rows}
    messages = sorted(last.values(), key=lambda r: int(r[0]))
    missing = ("", "nan", "None", "NaN")
    children = {}
    for r in messages:
        if r[6] not in missing:
            children.setdefault(r[6], []).append(r[0])
    inbound = {r[0]: r[2].lower() in ("true", "1", "yes") for r in messages}
    team = {r[1] for r in messages if not inbound[r[0]] and (brand in r[1].lower() or r[1].lower() in brand)}
    result = {}
    for r in messages:
        if not inbound[r[0]] or r[6] not in missing:
            continue
        waiting, met, kept, involved = deque([r[0]]), set(), [], False
        while waiting:
            current = waiting.popleft()
            if current in met or current not in last:
                met.add(current)
                continue
            met.add(current)
            row = last[current]
            involved |= row[1] in team
            text = " ".join(row[4].split())
            if not text or sum(ord(ch) < 128 for ch in text) / len(text) <= 0.8:
                continue
            kept.append(current)
            waiting.extend(children.get(current, []))
            if row[5] not in missing:
                waiting.extend(p.strip() for p in row[5].split(",") if p.strip())
        if involved and len(kept) >= 2:
            result[r[0]] = kept
    return result


def rebuilt(turns):
    found = {}
    for r in turns.orderBy("root_id", "seq").collect():
        found.setdefault(r["root_id"], []).append((r["seq"], r["tweet_id"]))
    for visits in found.values():
        assert [s for s, _ in visits] == list(range(len(visits)))
    return {root: [t for _, t in visits] for root, visits in found.items()}


def random_messages(seed, size, tangled):
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        parent = "" if i == 0 or rng.random() < 0.12 else rng.choice([str(rng.randrange(max(0, i - 25), i)), "nan", "99999"])
        listed = []
        if tangled and rng.random() < 0.3:
            listed = [str(rng.randrange(size)) for _ in range(rng.randrange(1, 4))]
        brand = rng.random() < 0.3
        text = rng.choice(["fine words"] * 9 + ["", "ééééé", "@only"])
        text = " ".join(text.replace("@only", "").split())
        rows.append(tweet(i, parent, ",".join(listed), f"Brand{rng.randrange(3)}" if brand else None,
                          "False" if brand else "True", text))
    return rows


@pytest.mark.parametrize("seed,size,tangled,group", [
    (1, 200, False, 1_000_000), (2, 200, True, 1_000_000), (3, 150, True, 3), (4, 100, True, 1),
])
def test_random_graphs_match_a_queue_walk(spark, seed, size, tangled, group):
    rows = random_messages(seed, size, tangled)
    turns = threads.build_threads(frame(spark, rows).repartition(3), "brand1", group_edges=group)
    assert rebuilt(turns) == queue_walk(rows, "brand1")


@pytest.mark.parametrize("seed,size,tangled,levels", [(5, 200, False, 0), (6, 200, False, 1), (8, 150, True, 0)])
def test_trees_ranked_along_their_tours_match_a_queue_walk(spark, monkeypatch, seed, size, tangled, levels):
    monkeypatch.setattr(threads, "find_tops", partial(threads.find_tops, path_levels=levels))
    rows = random_messages(seed, size, tangled)
    assert rebuilt(threads.build_threads(frame(spark, rows).repartition(3), "brand1")) == queue_walk(rows, "brand1")


def test_a_very_deep_tree_that_branches_everywhere(spark):
    depth = 10_000
    rows = [tweet(0)]
    for i in range(1, depth + 1):  # the even child goes on, the odd one has one reply
        rows.append(tweet(4 * i, 4 * (i - 1), author="Brand" if i % 2 else None, inbound="no" if i % 2 else "yes"))
        rows += [tweet(4 * i + 1, 4 * (i - 1)), tweet(4 * i + 3, 4 * i + 1)]
    turns = threads.build_threads(frame(spark, rows), "brand")
    assert rebuilt(turns) == queue_walk(rows, "brand")


def test_no_row_of_the_walk_grows_with_the_depth(spark):
    links = [(str(i), str(i + 1), 2 * i) for i in range(300)] + [(str(i), f"x{i}", 2 * i + 1) for i in range(300)]
    edges = spark.createDataFrame(links, "src string, dst string, ord bigint")
    below, unordered = threads.find_tops(edges.withColumn("ok", F.lit(True)).withColumn("is_brand", F.lit(False)))
    assert below.agg(F.max(F.size("path"))).first()[0] == threads.PATH_LEVELS
    assert unordered == below.where("path IS NULL").count() == 2 * (300 - threads.PATH_LEVELS)


def test_ranks_of_tours(spark):
    rng = random.Random(11)
    links = [(rng.randrange(i), i, rng.randrange(5)) for i in range(1, 120)] + [(1000, i, 7) for i in range(1001, 1101)]
    edges = spark.createDataFrame(links, "src bigint, dst bigint, ord bigint").repartition(5)
    children = {}
    for src, dst, order in sorted(links, key=lambda r: (r[2], r[1])):
        children.setdefault(src, []).append(dst)

    def down(node):
        return [node] + [x for child in children.get(node, []) for x in down(child)]

    found = {r["tid"]: r["rank"] for r in tours.rank_messages(edges).collect()}
    assert len(found) == len(links)
    for top in (0, 1000):
        tour = down(top)[1:]
        assert [found[x] for x in tour] == list(range(len(tour), 0, -1))
    assert tours.rank_messages(edges.limit(0)).count() == 0


def test_small_shapes(spark):
    rows = [
        # A circle behind a root, a self reply, a dangling id and a message listed twice.
        tweet(1, responses="2, 2, 77"), tweet(2, 1, responses="3"), tweet(3, 2, responses="2,3", author="Brand", inbound="no"),
        # An empty brand answer still makes the thread the brand's; its own replies are lost.
        tweet(10), tweet(11, 10, author="Brand", inbound="no", text=" "), tweet(12, 11), tweet(13, 10),
        # One message below two roots, one root below another.
        tweet(20, responses="22"), tweet(21, responses="22,20"), tweet(22, author="Brand", inbound="no", parent="20"),
        # No brand; too short; a repeated row.
        tweet(30), tweet(31, 30), tweet(40, author="Brand"), tweet(50, text="old"), tweet(50, text="new"), tweet(51, 50, author="Brand"),
    ]
    assert rebuilt(threads.build_threads(frame(spark, rows), "brand")) == queue_walk(rows, "brand")


def test_deep_chain_and_wide_star(spark):
    chain = [tweet(0)] + [tweet(i, i - 1, author="Brand" if i % 2 else None, inbound="no" if i % 2 else "yes") for i in range(1, 120)]
    star = [tweet(1000)] + [tweet(1000 + i, 1000, author="Brand", inbound="no") for i in range(1, 200)]
    found = rebuilt(threads.build_threads(frame(spark, chain + star), "brand", group_edges=50))
    assert found == queue_walk(chain + star, "brand")
    assert len(found["0"]) == 120 and len(found["1000"]) == 200


def test_a_walk_that_is_too_deep_fails_loudly(spark):
    rows = [tweet(0, responses="5")] + [tweet(i, i - 1, responses="0") for i in range(1, 12)]
    with pytest.raises(RuntimeError, match="deeper"):
        threads.build_threads(frame(spark, rows), "u1", max_levels=3).count()


def test_brand_rules(spark):
    rows = [tweet(1, author="Plum", inbound="no"), tweet(2, author="PlumSupport_UK", inbound="no"),
            tweet(3, author="Other", inbound="no"), tweet(4, author="Other", inbound="no"), tweet(5, author="plumsupport")]
    df = frame(spark, rows)

    def names(brand, **options):
        return sorted(r["author_id"] for r in graph.brand_authors(df, brand, **options).collect())

    assert names("PlumSupport") == ["Plum", "PlumSupport_UK"]
    assert names("plum", exact=True) == ["Plum"]
    assert names("nobody") == ["Other"]


def test_orphans_and_missing_flag_column(spark):
    nodes = graph.message_nodes(frame(spark, [tweet(1, 99), tweet(2), tweet(3, 2)]))
    assert {r["tweet_id"] for r in graph.thread_roots(nodes).collect()} == {"2"}
    assert {r["tweet_id"] for r in graph.thread_roots(nodes, orphan_roots=True).collect()} == {"1", "2"}
    unflagged = frame(spark, [tweet(1, inbound="no")]).drop("inbound")
    assert graph.message_nodes(unflagged).first()["is_inbound"]


def test_result_does_not_depend_on_partitioning(spark):
    rows = random_messages(7, 90, True)
    one = rebuilt(threads.build_threads(frame(spark, rows).coalesce(1), "brand2"))
    many = rebuilt(threads.build_threads(frame(spark, rows[::-1]).repartition(7), "brand2", unique_ids=True))
    assert one == many


def test_thread_key_and_empty_input(spark):
    assert spark.range(1).select(thread_key(F.lit("12345"))).first()[0] == "827ccb0eea8a"
    assert threads.build_threads(frame(spark, []), "brand").count() == 0
