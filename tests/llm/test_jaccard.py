import random
import re

import numpy as np
import pytest

from namepulse.llm import jaccard, tables
from tests.llm.conftest import ODD


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())


def brute(texts, size, percent):
    sets = [shingles(t, size) for t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
    return {i: (len(s), group[i]) for i, s in enumerate(sets)}


def texts():
    random.seed(9)
    words = [f"w{i}" for i in range(40)]
    base = [[random.choice(words) for _ in range(random.choice([3, 8, 30, 200]))] for _ in range(12)]
    out = [*ODD, "x y", "X Y", "x y z"]
    for _ in range(110):
        copy = list(random.choice(base))
        for _ in range(random.randrange(4)):
            copy[random.randrange(len(copy))] = random.choice(words)
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize(("size", "percent", "factor"), [(4, 85, 4), (5, 80, 4), (2, 60, 0), (1, 50, 0)])
def test_components_against_brute_force(table, clashing, size, percent, factor):
    """``factor`` 0 makes every shingle frequent: pairs only."""
    given = texts()
    found = jaccard.link_groups(clashing(table(given)), size=size, percent=percent, factor=factor).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(given, size, percent)


def test_linked_sets_always_share_an_entry():
    rng = np.random.default_rng(2)
    frequent = rng.random(1 << jaccard.SKETCH_BITS) < 0.5
    for n in (7, 20, 150, 900):
        for _ in range(20):
            tokens = np.unique(rng.integers(0, 2**49, n, np.uint64))
            gone = rng.choice(len(tokens), int(0.075 * len(tokens)), replace=False)
            other = np.unique(np.concatenate([np.delete(tokens, gone), rng.integers(0, 2**49, len(gone), np.uint64)]))
            if 100 * len(np.intersect1d(tokens, other)) >= 85 * len(np.union1d(tokens, other)):
                assert len(np.intersect1d(jaccard.entries(tokens, frequent, 85), jaccard.entries(other, frequent, 85)))


def test_nulls_repeats_and_empty_tables(table):
    docs = table(["a b c d e f g"], [(0, "a b c d e f g", None, None, None), (None, "a b c d e f g", None, None, None)])
    assert sorted(map(tuple, jaccard.link_groups(docs).collect()), key=str) == sorted([(0, 4, 0), (0, 4, 0), (None, 4, 0)], key=str)
    assert jaccard.link_groups(table([])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3)]
    found = {r.id: r.component for r in tables.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}


def test_parities_of_any_two_sizes_bound_the_difference(spark):
    rng = np.random.default_rng(8)
    sets = []
    for n in (0, 5, 900, 1020, 1030, 2040, 2060, 5000, 9000):
        base = np.unique(rng.integers(1, 1 << 49, n, np.uint64))
        for share in (1.0, 0.97, 0.9):
            kept = base[rng.random(len(base)) < share]
            sets.append(np.unique(np.concatenate([kept, rng.integers(1, 1 << 49, int(n * (1 - share) / 2), np.uint64)])))
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    bits = jaccard._parities(np.concatenate(sets), bounds).to_pylist()
    assert all(len(b) * 64 >= len(s) for b, s in zip(bits, sets, strict=True))
    rows = [(i, j, len(x), len(y), bits[i], bits[j]) for i, x in enumerate(sets) for j, y in enumerate(sets) if i < j]
    frame = spark.createDataFrame(rows, "i int, j int, n long, n2 long, bits array<long>, bits2 array<long>")
    close = {(r.i, r.j) for r in frame.where(jaccard._close(85)).collect()}
    for i, x in enumerate(sets):
        for j in range(i + 1, len(sets)):
            shared = len(np.intersect1d(x, sets[j]))
            union = len(x) + len(sets[j]) - shared
            if union and 100 * shared >= 85 * union:
                assert (i, j) in close
            if union > 100 and 100 * shared < 40 * union:
                assert (i, j) not in close


def test_shared_entries_shuffle_the_index_once(spark):
    rows = [(e, f, 10 + f) for e in range(40) for f in range(e % 4)] + [(7, 2, 12), (7, 2, 12), (50, 9, 19), (50, 9, 19)]
    index = spark.createDataFrame(rows * 2, "entry long, f long, n long").repartition(5)
    shared = jaccard.shared_entries(index)
    want = {(e, f, n) for e, f, n in rows if len({g for x, g, _ in rows if x == e}) > 1}
    assert sorted(map(tuple, shared.collect())) == sorted(want)
    shared.collect()
    plan = shared._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # One pass of the index by entry: not a second and third one to join and to make rows distinct.
    assert plan.count("Exchange hashpartitioning") == 1, plan
