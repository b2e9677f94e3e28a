import random
import re
from collections import Counter

import numpy as np
import pytest

from namepulse.llm import collocations as co
from tests.llm.conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest, most):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and a >= candidates[p[i:j]]}
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def texts(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "a", "en", "de", "new", "york", "é", "big", "x1", "(b)", "\U0001f600", *(f"w{i}" for i in range(40))]
    fixed = ["new york city hall", "of the", "big é", "in the year of our lord"]
    out = []
    for _ in range(n):
        words = [rng.choice(fixed) if rng.random() < 0.2 else rng.choices(vocabulary, [20, 15, 10, 9, 9, 5, 5, 5, 5, 2, 2, 2] + [1] * 40)[0] for _ in range(rng.randint(1, 60))]
        out.append("".join(w + rng.choice(["  ", " ", " ", "\t", ". ", ",", "\n", "\x0b"]) for w in words))
    return out


@pytest.mark.parametrize("head, tile, bits, chunk", [(1 << 16, 1 << 10, 27, 2 << 20), (6, 4, 16, 300), (0, 4, 15, 50)])
def test_phrases_equal_brute_force(spark, clashing, monkeypatch, head, tile, bits, chunk):
    for name, value in (("HEAD", head), ("TILE", tile), ("BITS", bits)):
        monkeypatch.setattr(co, name, value)
    monkeypatch.setattr(co.tx, "CHUNK", chunk)
    rng = random.Random(head)
    langs = ["en", "en", "en", "de", None, "und", ""]
    rows = [(rng.choice(langs), t) for t in [*texts(1), *ODD, "a b " * 300, "a b c d e f. " * 40]]
    rows += rows[:20]
    df = spark.createDataFrame([(i % 50, lang, t) for i, (lang, t) in enumerate(rows)], "doc_id int, lang string, text string").repartition(3)
    got = co.collocations(clashing(df), least=5, longest=5, most=60)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 5, 60)


def test_tiles_count_by_address_and_as_lists(monkeypatch):
    monkeypatch.setattr(co, "TILE", 8)
    monkeypatch.setattr(co, "TILES", 2)
    rng = np.random.default_rng(3)
    tiles, total = co._Tiles(), Counter()
    want = Counter()
    for _ in range(20):
        tile, cell = rng.choice([0, 0, 0, 1, 2, 7], 50), rng.integers(0, 64, 50)
        want.update(zip(tile.tolist(), cell.tolist(), strict=True))
        for a, b, n in tiles.add(tile, cell):
            for x in zip(a.tolist(), b.tolist(), n.tolist(), strict=True):
                total[x[:2]] += x[2]
    assert 0 < len(tiles.dense) <= 2
    for a, b, n in tiles.counted():
        for x in zip(a.tolist(), b.tolist(), n.tolist(), strict=True):
            total[x[:2]] += x[2]
    assert total == want


def test_scores_pass_64_bits(spark):
    rows = [("en", "p q " * 60_000)] * 2
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, co.collocations(df, least=100, longest=3, most=9).collect())) == brute(rows, 100, 3, 9)


def test_empty_and_wordless_tables(table):
    assert co.collocations(table([])).count() == 0
    assert co.collocations(table([None, "", " .,"])).count() == 0
