import itertools
import random
import re
from collections import Counter

import numpy as np

from namepulse.llm import quality
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def texts():
    random.seed(5)
    plain = [" ".join(random.choice(["sun", "river", "walks", "under", "stone,", "the"]) for _ in range(random.randint(40, 90))) for _ in range(150)]
    junk = ["|".join(["a", "#%", "&&"] * 60) + " " + " ".join(f"$${i}##" for i in range(50))]
    return [*ODD, "a b c d e f g h i a b c d e f g h j", "l one\nl one\n \nl one \nl one", *plain, *junk]


def test_counts_and_verdicts(table, clashing):
    given = texts()
    found = {r.doc_id: r for r in quality.judge(clashing(table(given))).collect()}
    assert len(found) == len(given)
    for i, text in enumerate(given):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert all(found[i].kept for i in range(10, len(given) - 1) if not found[i].base_failed)
    assert not found[len(given) - 1].kept and not found[len(given) - 1].base_failed


def test_kept_rows_come_back_whole(table, clashing):
    docs = clashing(table(texts(), [(None, "x", None, None, None)] * 2))
    kept = quality.keep_rows(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == ids
    assert kept.exceptAll(docs).isEmpty()


def test_empty_table(table):
    assert quality.judge(table([])).count() == 0
    assert quality.keep_rows(table([])).count() == 0


def test_a_small_source_is_judged_by_its_own(spark):
    """99 documents of code among prose of their language, each source in its own way."""
    rng = random.Random(6)
    prose = [" ".join(rng.choice(["sun", "river", "walks", "under", "stone,", "the"]) for _ in range(rng.randint(40, 90))) for _ in range(300)]
    code = [" ".join(rng.choice(["a<b", "if(x)", "call(y)", "&ref", "x=1;", "ptr*", "return", "value"]) for _ in range(rng.randint(40, 90))) for _ in range(99)]
    junk = ["|".join(["a", "#%", "&&"] * 60) + " " + " ".join(f"$${i}##" for i in range(50))]
    made = [(i, t, "en", s) for i, (t, s) in enumerate([(t, "web") for t in prose] + [(t, "code") for t in code] + [(junk[0], "few")])]
    found = {r.doc_id: r for r in quality.judge(spark.createDataFrame(made, "doc_id long, text string, lang string, source string")).collect()}
    assert all(found[i].kept or found[i].base_failed for i in range(399)) and not found[399].kept
    assert sum(found[i].kept for i in range(300, 399)) > 90


def test_the_half_of_least_determinant_is_found(spark):
    """All halves of twelve vectors by brute force: the same determinant, distances and verdicts."""
    rng = np.random.default_rng(3)
    floors = np.array(list(quality.FLOORS.values()))
    vectors = np.array([4.0, 1.5, 0.2, 0.7, 0.4]) + rng.normal(size=(12, 5)) * floors
    vectors[9:] += np.array([[3.0, 0.9, 0.6, 3.0, 0.0], [-3.0, 0.9, 0.6, 0.0, 1.2], [0.0, -0.9, 0.9, 4.0, 1.2]])
    vectors = np.round(vectors / quality.GRID) * quality.GRID
    made = [(i, None, None, False, *map(float, v)) for i, v in enumerate(vectors)]
    names = ", ".join(f"{s} double" for s in quality.STATS)
    stats = spark.createDataFrame(made, f"doc_id long, lang string, source string, base_failed boolean, {names}")

    def of(half):
        own = vectors[list(half)]
        spread = 1.9 * np.cov(own.T, bias=True) + np.diag(floors**2)
        return np.linalg.slogdet(spread)[1], own.mean(0), np.linalg.inv(spread)

    det, mean, inverse = min((of(h) for h in itertools.combinations(range(12), 6)), key=lambda x: x[0])
    estimate = quality.estimates(stats)
    found = estimate.collect()
    assert len(found) == 3 and {r.start for r in found} <= set(quality.STARTS)
    for r in found:
        assert abs(r.det - det) < 1e-6
        assert np.allclose(r.mean, mean) and np.allclose(r.inverse, inverse)
    far = np.einsum("ni,ij,nj->n", vectors - mean, inverse, vectors - mean)
    judged = {r.doc_id: r for r in quality._judged(stats, estimate, 12.0).collect()}
    assert np.allclose([judged[i].distance for i in range(12)], far)
    assert [judged[i].kept for i in range(12)] == (far <= 12.0).tolist() and not any(judged[i].kept for i in (9, 10, 11))
