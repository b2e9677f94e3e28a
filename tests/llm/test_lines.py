import hashlib
import re
from collections import Counter

import numpy as np

from namepulse.llm import linededup
from namepulse.llm.cuckoo import CuckooFilter
from tests.llm.conftest import ODD

LINES = [f"Line {i}" for i in range(12)]
TEXTS = [*ODD, *("\n".join(LINES[j] for j in range(12) if i % (j + 1) == 0) + f"\n own {i} \n\tLINE 3\x0c" for i in range(24)), "line 3\nline 3"]


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute(texts, least):
    count = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    out = {}
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or count[key(x)] < least]
        out[i] = len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return out


def result(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect()}


def test_both_ways_against_brute_force(table, clashing):
    docs = clashing(table(TEXTS))
    index = linededup.build(docs, least=6)
    for ship in (None, False):
        assert result(linededup.drop_frequent(index, docs, ["doc_id"], ship=ship)) == brute(TEXTS, 6)


def test_insertion_and_deletion_can_be_undone(table):
    docs = table(TEXTS)
    even, odd = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    half = linededup.build(even, least=6)
    full = linededup.insert(half, odd)
    assert result(linededup.drop_frequent(full, docs, ["doc_id"])) == brute(TEXTS, 6)
    back = linededup.delete(full, odd)
    assert result(linededup.drop_frequent(back, even, ["doc_id"])) == result(linededup.drop_frequent(half, even, ["doc_id"]))


def test_empty_table(table):
    empty = table([])
    index = linededup.build(empty)
    assert linededup.drop_frequent(index, empty, ["doc_id"]).count() == 0
    assert result(linededup.drop_frequent(linededup.insert(index, table(TEXTS)), table(TEXTS), ["doc_id"])) == brute(TEXTS, 10)


def test_filter_holds_what_was_put_in_and_not_what_was_taken_out():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63, 5000)
    made = CuckooFilter.of(keys, load=0.95)
    assert made.contains(keys).all()
    made.delete(keys[:2500])
    again = CuckooFilter.load(made.dump())
    assert again.contains(keys[2500:]).all() and again.contains(keys[:2500]).sum() < 3
    assert again.insert(keys[:100]) and again.contains(keys[:100]).all()
