import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from namepulse.llm import ranked
from tests.llm.conftest import ODD

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, queries, k):
    texts = [(i, read(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in texts), sum(len(t) for _, t in texts)
    df = Counter(x for _, t in texts for x in set(t))
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(read(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, words in texts:
            tf = Counter(words)
            m = 100 - 50 + 50 * len(words) * n_docs // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 20 * m)) for t in terms if tf[t])
            if score > 0:
                scored.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["é", "Straße", "naïve", "\U0001f600"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return ["".join(w.upper() * (rng.random() < 0.1) or w for w in (x + rng.choice([" ", ", ", "\n", "-", "_"]) for x in rng.choices(words, weights, k=rng.randint(1, 80)))) for _ in range(n)]


@pytest.mark.parametrize("block, group", [(8192, 200_000), (7, 12)])
def test_ranks_equal_brute_force(spark, clashing, monkeypatch, block, group):
    monkeypatch.setattr(ranked, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranked, "GROUP", group)
    texts = [*corpus(1, 150), *ODD, "w1 " * 20_000]
    docs = [*enumerate(texts), (3, texts[3]), (3, texts[4]), (None, texts[5]), (500, texts[6])]
    queries = [(i, t) for i, t in enumerate(corpus(2, 12))] + [(3, "w59 é"), (None, "w2 w3"), (90, None), (91, ""), (92, "nowhere"), (93, "w1 w1 W1")]
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    asked = clashing(spark.createDataFrame(queries, "item_id int, text string"))
    for k in (1, 5, 400):
        got = ranked.rank(df, asked, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, queries, k)


def made_block(seed, n=400, n_terms=12):
    rng = np.random.default_rng(seed)
    places = {t: np.flatnonzero(rng.random(n) < (t + 1) / n_terms / 1.5) for t in range(n_terms)}
    impacts = {t: rng.integers(1, 100 * (n_terms - t), len(p)) for t, p in places.items()}
    pairs = [(0, 1), (2, 5), (3, 4), (6, 7), (10, 11)]
    both, joint = {}, {}
    for i, (a, b) in enumerate(pairs):
        both[i], x, y = np.intersect1d(places[a], places[b], return_indices=True)
        joint[i] = int((impacts[a][x] + impacts[b][y]).max()) if len(x) else 0
    pair_of = {t: (p[1 - p.index(t)], i) for i, p in enumerate(pairs) for t in p}
    return ranked.Block(n, places, impacts, {t: int(v.max()) for t, v in impacts.items() if len(v)}, both, joint), pair_of


def test_bounds_of_pairs_skip_more_and_lose_nothing():
    entered = {True: 0, False: 0}
    for seed in range(30):
        block, pair_of = made_block(seed)
        query = np.array([0, 1, 2, 3, 4, 5, 6, 7, 9, 10, 11], np.int32)
        scores = np.zeros(block.n, np.int64)
        for t in query.tolist():
            scores[block.places[t]] += block.impacts[t]
        threshold = int(np.sort(scores)[-10])
        for known in (True, False):
            found, got, n = ranked.best_in(query, block, pair_of if known else {}, threshold, np.zeros(block.n, np.int64))
            assert dict(zip(found.tolist(), got.tolist(), strict=True)) == {i: s for i, s in enumerate(scores.tolist()) if s >= threshold}
            entered[known] += n
    assert entered[True] < entered[False]


def test_what_is_skipped_is_below_the_threshold():
    for seed in range(20):
        block, pair_of = made_block(seed)
        units = ranked.units_of(np.arange(12, dtype=np.int32), block, pair_of)
        total = sum(u.high for u in units)
        for threshold in (1, total // 4, total // 2, total, total + 1):
            ways = ranked.plan(units, block, threshold)
            skipped = sum((u.high, u.low, 0)[w] for u, w in zip(units, ways, strict=True))
            assert skipped < threshold or all(w == 2 for w in ways)


def test_empty_tables(table, spark):
    asked = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert ranked.rank(table([]), asked).count() == 0
    assert ranked.rank(table(["w1"]), asked.limit(0)).count() == 0
    assert ranked.rank(table([None, ""]), asked).count() == 0
    assert ranked.rank(table([None, ""]), asked).columns == ["item_id", "rank", "doc_id", "score"]
