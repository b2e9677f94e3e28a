import math
import zlib
from collections import Counter

from namepulse.llm import ppm
from tests.llm.conftest import ODD

TEXTS = [*ODD[:6], "A" * 3000, "the cat sat on the mat", "the dog sat on the log", "The cat ate the dog", "zzz unseen ÿ", *(f"the cat {i}" for i in range(30))]
ORDER = 3


def symbols(text):
    return [ppm.END] * ORDER + list((text or "").encode().lower()) + [ppm.END]


def learn(held):
    trie = {}
    for i, text in enumerate(TEXTS):
        s = symbols(text)
        for at in range(ORDER, len(s)) if not held[i] else ():
            for k in range(ORDER + 1):
                node = trie.setdefault(tuple(s[at - k : at]), {})
                node[s[at]] = node.get(s[at], 0) + 1
    return trie


def log_probability(trie, context, symbol):
    gone, total = set(), 0.0
    for k in range(len(context) + 1):
        left = {s: n for s, n in trie.get(context[k:], {}).items() if s not in gone}
        if left:
            total += math.log10(left.get(symbol, len(left)) / (sum(left.values()) + len(left)))
            if symbol in left:
                return total
            gone |= left.keys()
    return total - math.log10(ppm.ALPHABET - len(gone))


def test_scores_against_a_plain_trie_with_and_without_joins(table, clashing):
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(TEXTS))]
    trie = learn(held)
    for context in ((ppm.END,) * ORDER, tuple(b"the"), tuple(b"qqq")):
        assert math.isclose(sum(10 ** log_probability(trie, context, s) for s in range(ppm.ALPHABET)), 1)
    tokens = Counter(w for t, h in zip(TEXTS, held, strict=True) if not h for w in [*(t or "").encode().lower().split(), "end"])
    total, kinds = sum(tokens.values()), len(tokens)
    for shipped in (1 << 20, 3, 0):
        found = {r.doc_id: r for r in ppm.score(clashing(table(TEXTS)), order=ORDER, shipped=shipped).collect()}
        for i, text in enumerate(TEXTS):
            words, s = [*(text or "").encode().lower().split(), "end"], symbols(text)
            want = sum(log_probability(trie, tuple(s[at - ORDER : at]), s[at]) for at in range(ORDER, len(s)))
            base = sum(math.log10((tokens[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
            r = found[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(words), sum(tokens[w] > 0 for w in words), total)
            assert math.isclose(r.score, want, rel_tol=1e-9) and math.isclose(r.base_score, base, rel_tol=1e-9)


def test_adaptive_scores_learn(table):
    assert ppm.adaptive_score(b"") == -math.log10(ppm.ALPHABET)
    assert ppm.adaptive_score(b"abcabcabcabc") > ppm.adaptive_score(b"abcdefghijkl")
    found = {r.doc_id: r.score for r in ppm.score_adaptive(table(["abab", None])).collect()}
    assert found == {0: ppm.adaptive_score(b"abab"), 1: ppm.adaptive_score(b"")}


def test_empty_table_and_null_ids(table):
    assert ppm.score(table([])).count() == 0
    assert ppm.score(table(["a"], [(None, "b", None, None, None)])).count() == 2
