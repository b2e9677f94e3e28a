import random

from namepulse.llm import suffixes
from tests.llm.test_suffixes import brute


def planted():
    """Texts of random words; the first 24 hold one of 8 passages of 55 to 90 words, so each passage is in three."""
    random.seed(7)
    vocab = ["".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(random.randint(2, 9))) for _ in range(3000)]
    words = lambda n: " ".join(random.choice(vocab) for _ in range(n))
    passages = [words(random.randint(55, 90)) for _ in range(8)]
    texts = []
    for i in range(120):
        body = words(random.randint(80, 300))
        if i < 24:
            cut = random.randint(0, len(body))
            body = body[:cut] + " " + passages[i % 8] + " " + body[cut:]
        texts.append(body)
    return texts


def test_planted_passages_are_removed_by_n_removed(table):
    """At the query's length of 400 bytes: as brute force, and clean texts lose nothing."""
    given = planted()
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.drop_repeats(table(given), length=400, with_text=False).collect()}
    want = brute(given, 400)
    assert found == want
    assert all(found[i][1] == 0 for i in range(24, 120))
    assert sum(found[i][1] > 0 for i in range(24)) == sum(len(given[i].encode()) > 0 and want[i][1] > 0 for i in range(24)) > 0
