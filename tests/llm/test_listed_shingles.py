"""op7 and the pipeline's join: what classes list, and how lists are compared, on tables of many documents."""

import random
from contextlib import contextmanager

import brute as B
import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm import jaccard, kernels as K


def test_documents_without_a_partner_post_nothing(spark, monkeypatch):
    """Where counters are full, every document posted a fifth of its shingles as rows before."""
    for name in ("COUNTER_BITS", "MOST_COUNTER_BITS"):
        monkeypatch.setattr(jaccard, name, 18, raising=False)
    picked, rows = random.Random(3), {}
    texts = [" ".join(str(picked.randrange(10**9)) for _ in range(1000)) for _ in range(600)]
    texts += [texts[7], texts[8].replace(texts[8].split()[500], "other"), texts[8] + " more words"]

    @contextmanager
    def watched(session, temporary=jaccard.temporary):
        with temporary(session) as keep:
            def stored(df, name):
                out = keep(df, name)
                rows[name] = out.count()
                return out

            stored.drop = keep.drop
            yield stored

    monkeypatch.setattr(jaccard, "temporary", watched)
    got = jaccard.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i for i in range(600)} | {600: 7, 601: 8, 602: 8}
    # Four documents have a partner; the copy in another task counts as one.
    assert 0 < rows["postings"] < 5 * 250


def test_linked_sets_share_enough_of_what_they_list():
    for percent in (50, 80, 93, 100):
        n = np.arange(1, 5000)
        most, least = jaccard.listed(n, percent)
        assert (most <= n).all() and (least >= 1).all()
        assert (np.diff(n - most) >= 0).all() and (np.diff(least) >= 0).all()
        assert (jaccard.least_overlap(n, percent) - (n - most) >= least).all()
    # Random orders of two sets that just link.
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        shared = int(jaccard.least_overlap(np.array(n), 80))
        m = shared + int(rng.integers(0, 100 * shared // 80 - n + 1))
        order = rng.permutation(n + m - shared)
        a, b = np.sort(order[:n]), np.sort(np.concatenate([order[:shared], order[n:]]))
        (most_a, least_a), (most_b, least_b) = jaccard.listed(np.array(n), 80), jaccard.listed(np.array(m), 80)
        both = np.intersect1d(a[:most_a], b[:most_b])
        assert len(both) >= max(least_a, least_b)


@pytest.mark.parametrize("searched", [1, 7, 1 << 18])
def test_members_are_looked_up_in_many_lists_at_once(monkeypatch, searched):
    monkeypatch.setattr(jaccard, "SEARCHED", searched)
    picked = random.Random(4)
    sets = [np.unique(np.array(picked.choices(range(50), k=picked.randint(1, 60)), np.uint64)) for _ in range(60)]
    for query, found in zip(sets, jaccard.t_occurrence(sets, sets, 60)):
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(query, s)) >= 60 * len(np.union1d(query, s))]
        assert found.tolist() == want


@pytest.mark.parametrize("rows", [3, 50, 1000])
def test_small_blocks_together_give_the_families_of_each(rows):
    rng = np.random.default_rng(rows)
    sets, columns = [], {x: [] for x in ("list", "i", "j", "cls", "n", "query", "component")}
    for block in range(60):
        base = rng.integers(0, 2**63, int(rng.choice([3, 20, 47, 48, 49, 300])), dtype=np.int64)
        for member in range(int(rng.choice([1, 2, 3, 9, 150]))):
            own = base.copy()
            own[: int(len(own) * rng.choice([0.02, 0.1, 0.3]))] = rng.integers(0, 2**63, 1)
            sets.append(np.unique(K.mix(own.astype(np.uint64))))
            values = (block // 4, block % 4, 0, len(sets), len(sets[-1]), bool(rng.random() < 0.7), str(rng.integers(3)))
            for name, value in zip(columns, values):
                columns[name].append(value)
    n = np.array(columns["n"])
    sketches, sizes, beyond = jaccard._sketches(np.concatenate(sets), n)
    table = pa.table(columns | {"sketch": K.binary_column(sketches, sizes), "beyond": beyond})

    def families(small):
        found = jaccard._pairs_of_blocks(jaccard._candidates, 80, small)(iter(table.to_batches(max_chunksize=rows)))
        pairs = [pair for batch in found for pair in zip(batch["cls_a"].to_pylist(), batch["cls_b"].to_pylist())]
        return B.components(columns["cls"], pairs)

    assert families(jaccard._near_rows) == families(None) != {x: x for x in columns["cls"]}
