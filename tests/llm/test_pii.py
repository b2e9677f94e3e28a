import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from namepulse.llm import pii
from namepulse.llm import text as tx
from tests.llm.conftest import ODD

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        odd, even = digits[::-1][::2], digits[::-1][1::2]
        return 12 <= len(digits) <= 19 and (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def by_pattern(text):
    text = text or ""
    found = [(m.start(), list(PATTERNS).index(k), k, m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text, re.ASCII) if passes(k, m.group())]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def pieces(seed, n):
    rng = random.Random(seed)
    parts = ["a.b@c.de", "@", "x@y", "x@y.z", "_d@e.f.", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "..", "+1 (743) 555-3824", "+49", "+1", "4381893557741609", "4381 8935-5774 1609", "5774", " ", "\n", "é", "-", ".", "the", "0" * 20, "+", "(", "\U0001f600", "@a.b@c.d"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", ","]) for _ in range(rng.randint(1, 14))) for _ in range(n)]
    return texts + [pii.card_number(rng, k) + rng.choice("a. \n") for k in range(11, 21)]


@pytest.fixture(scope="module")
def model():
    return pii.fit(pii.sentences(1000, 11), rounds=60, rate=0.2, shrink=0.02)


def test_patterns_equal_plain_searches():
    texts = [*ODD, *pieces(1, 3000), "A" * 50_000 + "@b.c", "1" * 40_000, "1." * 20_000, "+" * 9999]
    for limit in (1 << 21, 100):
        found = [[] for _ in texts]
        for chunk in tx.chunks(pa.array(texts), limit):
            for row, kind, a, b in pii.base_spans(chunk):
                lead = len(chunk.data[chunk.offsets[row] : a].tobytes().decode())
                found[chunk.first + row].append((lead, kind, lead + b - a))
        assert [[f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(f)] for f in found] == [by_pattern(t) for t in texts]


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(5)
    steps = rng.normal(size=(3, 3))
    scores = rng.normal(size=(20, 4, 3))
    for chain, got in zip(scores, pii.viterbi(scores, steps), strict=True):
        worth = lambda p: steps[0, p[0]] + sum(chain[i, y] for i, y in enumerate(p)) + sum(steps[a, b] for a, b in itertools.pairwise(p)) + steps[p[-1], 0]
        assert tuple(got) == max(itertools.product(range(3), repeat=4), key=worth)


def test_settled_words_leave_the_best_path_as_it_is():
    rng = np.random.default_rng(6)
    steps = rng.normal(size=(5, 5))
    scores = rng.normal(size=(4000, 5)) * 2
    scores[rng.random(4000) < 0.8, 0] += 9
    joined = rng.random(4000) < 0.97
    joined[0] = False
    got = pii.decode(scores, joined, steps)
    cuts = [*np.flatnonzero(~joined), 4000]
    for a, b in itertools.pairwise(cuts):
        assert list(got[a:b]) == list(pii.viterbi(scores[None, a:b], steps)[0])


def test_chances_are_those_of_all_paths():
    rng = np.random.default_rng(7)
    steps, scores = rng.normal(size=(2, 2)), rng.normal(size=(1, 3, 2))
    paths = list(itertools.product(range(2), repeat=3))
    worth = np.exp([steps[0, p[0]] + sum(scores[0, i, y] for i, y in enumerate(p)) + steps[p[0], p[1]] + steps[p[1], p[2]] + steps[p[2], 0] for p in paths])
    chances, pairs = pii._expected(scores, steps, np.ones((1, 3), bool), np.array([3]))
    for place in range(3):
        assert np.isclose(chances[0, place, 1], sum(w for w, p in zip(worth, paths, strict=True) if p[place]) / worth.sum())
    ones = sum(w * ((p[0] == p[1] == 1) + (p[1] == p[2] == 1)) for w, p in zip(worth, paths, strict=True)) / worth.sum()
    assert np.isclose(pairs[1, 1], ones)


def spans_of(model, texts):
    out = []
    for chunk in tx.chunks(pa.array(texts)):
        base = pii.base_spans(chunk)
        out += [(chunk.first + r, pii.KINDS[k], chunk.data[a:b].tobytes().decode()) for r, k, a, b in base + pii._added(chunk, model, base)]
    return sorted(out)


def test_held_out_sentences(model):
    held = pii.sentences(1500, 99)
    texts = [" ".join(w for w, _ in s) for s in held]
    wanted = []
    for i, s in enumerate(held):
        for y, part in itertools.groupby(s, key=lambda e: e[1]):
            if y:
                words = " ".join(w for w, _ in part)
                wanted.append((i, pii.KINDS[y - 1], words.rstrip(".,#!")))
    found = set(spans_of(model, texts))
    wanted = set(wanted)
    assert len(found & wanted) >= 0.95 * len(wanted)
    assert len(found & wanted) >= 0.95 * len(found)


def test_clean_text_has_no_spans(model):
    rng = random.Random(4)
    text = "\n".join(" ".join(pii._word(rng) + rng.choice(["", ",", ".", "***", "&&&"]) for _ in range(12)) for _ in range(2000))
    notes = "Licensed under CC BY-NC 4.0. On 12.05.2023 at 12:30 version 2.10.3 cost $1,299.00 (pages 113-127, No. 44718). token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\""
    assert spans_of(model, [text, notes, "", "at dot at"]) == []


def test_other_spellings_are_added(model):
    texts = ["write to ann.7 at mail3.example.org soon", "call (743) 555-0199 now", "host 10[.]0[.]23[.]1 is up", "é card 4381.8935.5774.1609.", "mail ann.7@x.org or (743) 555-0199"]
    assert spans_of(model, texts) == [
        (0, "email", "ann.7 at mail3.example.org"),
        (1, "phone", "(743) 555-0199"),
        (2, "ip", "10[.]0[.]23[.]1"),
        (3, "card", "4381.8935.5774.1609"),
        (4, "email", "ann.7@x.org"),
        (4, "phone", "(743) 555-0199"),
    ]


def test_rows_of_a_table(table, clashing, spark, model):
    texts = [*ODD, "é a@b.cd +1 (743) 555-3824", "1.2.3.4 1.2.3.4", "1.2.3.4 1.2.3.4"]
    more = [(None, "x@y.zz", None, None, None), (3, "x@y.zz", "en", "s", 1)]
    rows = {r.doc_id: r for r in pii.find(clashing(table(texts, more[:1])), model).collect()}
    assert len(rows) == len(texts) + 1
    for i, t in [*enumerate(texts), (None, "x@y.zz")]:
        base = by_pattern(t)
        row = rows[i]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(b.startswith(k) for b in base) for k in PATTERNS]
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert row.spans == ",".join(base)
    assert pii.find(table(texts, more), model).where("doc_id = 3").count() == 2
    assert pii.find(table([]), model).count() == 0


def test_the_labelled_table(spark, model):
    got = pii.train(pii.example_table(spark, 300), rounds=10)
    assert np.allclose(got.weights, pii.fit(pii.sentences(300, 11), rounds=10, rate=0.2, shrink=0.02).weights)
    empty = pii.train(pii.example_table(spark, 1).limit(0), rounds=2)
    assert spans_of(empty, ["call (743) 555-0199 now or a@b.cd"]) == [(0, "email", "a@b.cd")]
