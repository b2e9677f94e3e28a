import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from namepulse.llm import suffixes
from tests.llm.conftest import ODD


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = {}
    for k, b in enumerate(data):
        edges = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                edges[i] += 1
                edges[i + length] -= 1
        gone = np.cumsum(edges[:-1]) > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes() if b else b""
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[:1].sum())
        out[k] = len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()
    return out


def texts():
    random.seed(1)
    words = ["ab", "cdé", "f", "ghij", "k"]
    make = lambda n: " ".join(random.choice(words) for _ in range(random.randint(0, n)))
    base = [make(60) for _ in range(20)]
    mixed = [random.choice(base)[:40] + make(40) + random.choice(base)[5:50] for _ in range(30)]
    return [*(t for t in ODD if t is None or len(t) < 1000), *base, *mixed, "aaaa" * 30, "x" + "aaaa" * 25, base[3], base[3], base[4] + "." + base[4]]


@pytest.mark.parametrize("length", [20, 41, 100])
def test_against_brute_force(table, clashing, length):
    given = texts()
    found = suffixes.drop_repeats(clashing(table(given)), length=length).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute(given, length)


def test_empty_table(table):
    assert suffixes.drop_repeats(table([])).count() == 0
