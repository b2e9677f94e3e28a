import random
import re

import numpy as np

from namepulse.llm import decontam
from tests.llm.conftest import ODD

random.seed(4)
WORDS = [f"{a}{b}" for a in ("tri", "mo", "spa", "lent", "gra") for b in ("do", "ck", "ver", "mil", "un", "ster")]


def some(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


ITEMS = [some(30), some(24).capitalize() + ".", "Short item here", "One", None, "", " !? "]


def changed(text, n):
    words = text.split()
    for at in random.sample(range(len(words)), min(n, len(words))):
        words[at] = "other"
    return " ".join(words)


TEXTS = [*ODD, some(200), some(50) + " " + ITEMS[0].upper() + "! " + some(20), changed(ITEMS[0], 3), some(9) + "\n" + changed(ITEMS[1], 2), "a short, ITEM (here) b", changed(ITEMS[0], 20)]


def normal(text):
    return re.sub("[" + re.escape(decontam._PUNCTUATION.decode()) + r"\x20\x09-\x0D]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")).strip()


def plain_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        before, row = row, [i]
        for j, y in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return min(row)


def test_least_edits_is_the_plain_distance():
    pairs = [(some(random.randint(1, 5)), some(random.randint(0, 8))) for _ in range(60)]
    pairs += [(item, text + " " + changed(item, 2)) for item, text in ((some(30), some(9)), (some(12), some(40)))]
    pairs += [("\u00e9\U0001f600x" * 30, "\u00e9\U0001f600y" * 31), ("a" * 64, "a" * 63), ("a" * 128, "b" * 700), ("x", "")]
    found = decontam.least_edits(*map(list, zip(*pairs)), at_once=7)
    assert found.tolist() == [plain_edits(item, text) for item, text in pairs]


def test_far_pairs_are_told_from_close_ones():
    pairs = [(item, some(9) + " " + changed(item, n) + " " + some(9)) for n in range(12) for item in (some(40), some(11), some(3) + "x" * n)]
    found = decontam.least_edits(*map(list, zip(*pairs)), 80)
    for (item, text), edits in zip(pairs, found.tolist()):
        want = plain_edits(item, text)
        assert edits == want if 100 * want <= 20 * len(item) else 100 * edits > 20 * len(item)


def test_long_texts_in_pieces():
    for at in range(0, 400, 37):
        item = some(10)
        text = some(400).split()
        text[at:at] = changed(item, 1).split()
        assert decontam.least_edits([item], [" ".join(text)], 80)[0] == plain_edits(item, " ".join(text))


def test_leaks_against_brute_force(spark, table, clashing):
    items = clashing(spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string"))
    found = {(r.doc_id, r.item_id): r.edits for r in decontam.leaks(clashing(table(TEXTS)), items).collect()}
    want = {}
    for d, text in enumerate(TEXTS):
        for i, item in enumerate(ITEMS):
            if normal(item) and len(normal(text)) < 5000:
                edits = plain_edits(normal(item), normal(text))
                if 100 * edits <= 20 * len(normal(item)):
                    want[d, i] = edits
    # A one-word item is looked for by its word: other spellings of it are not nominated.
    assert {k: v for k, v in want.items() if k[1] != 3 or v == 0} == found


def test_empty_tables(spark, table):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(table(TEXTS), items).count() == 0
    assert decontam.leaks(table([]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def points(text):
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def test_embeddings_grow_with_the_recall():
    walks = [decontam.chosen(points(some(24)), 80, recall) for recall in (0.5, 0.999)]
    assert (decontam.LADDER.index(walks[0]._replace(embeddings=5)), walks[0].embeddings) == (0, 1)
    assert walks[1].embeddings > 1 or walks[1].steps < walks[0].steps


def test_walks_alone_find_what_they_were_chosen_for():
    """The nominations of edited items by length and kind of edit, without the exact check."""
    rng = random.Random(5)
    for words in (2, 3, 5, 8, 12, 16, 24, 40):
        shares = []
        for _ in range(6):
            item = some(words)
            walk = decontam.chosen(points(item))
            own = [np.unique(decontam.item_signatures(points(item), walk, e)[0]) for e in range(walk.embeddings)]
            for made in [scattered(item, 20, rng) for _ in range(25)] + [changed(item, max(1, words // 8)) if words > 7 else item]:
                codes = points("at " + made + " the end")
                starts = np.arange(len(codes)) if walk.everywhere else np.flatnonzero(decontam.starts_of(codes))
                shares.append(any(np.isin(decontam.signatures(decontam.mixed(codes), starts, walk, e)[0], own[e]).any() for e in range(walk.embeddings)))
        assert np.mean(shares) >= 0.96, words


def test_every_item_has_walks():
    texts = ["aaa " * 30, "a b " * 9, "x", "ab", "\u6f22\u5b57" * 40, "\u00e9" * 400, "q" * 90]
    for text in texts:
        codes = points(text.strip())
        walk = decontam.chosen(codes)
        hashes, places = decontam.item_signatures(codes, walk, 0)
        assert hashes.size and 0 <= places.min() and places.max() < len(codes)
        same, _ = decontam.signatures(decontam.mixed(np.append(points("no "), codes)), places + 3, walk, 0)
        assert (same == hashes).all()


def test_unspaced_scripts_repeated_rows_and_null_ids(spark, table):
    rng = random.Random(9)
    item = "".join(chr(rng.randint(0x4E00, 0x5E00)) for _ in range(60))
    near = item[:20] + "\u3042" + item[24:]
    text = "".join(chr(rng.randint(0x4E00, 0x5E00)) for _ in range(9000))
    rows = [(1, text[:500] + near + text[500:]), (1, text[:500] + near + text[500:]), (None, text + item), (2, text), (None, text + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(5, item), (5, item), (None, "unlike anything in there")], "item_id long, text string")
    found = sorted(((r.doc_id, r.item_id, r.edits) for r in decontam.leaks(docs, items).collect()), key=str)
    assert found == [(1, 5, 4), (None, 5, 0)]


def test_pieces_hold_the_windows_of_long_texts(spark, table):
    item = some(30)
    text = some(3000) + " " + changed(item, 3) + " " + some(3000) + " " + item
    found = decontam.leaks(table([text]), spark.createDataFrame([(0, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.edits) for r in found] == [(0, 0)]


def scattered(item, share, rng):
    """The item with a share of its characters replaced, left out or preceded by another."""
    out = list(item)
    for at in rng.sample(range(len(out)), len(out) * share // 100):
        out[at] = rng.choice(["x", "", "q" + out[at]])
    return "".join(out)


def test_edits_up_to_the_bound_are_found_at_all_lengths(spark, table):
    rng = random.Random(8)
    letters = "abcdefghijklmnoprstuvwyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))
    items = [" ".join(word() for _ in range(n)) for n in (2, 3, 4, 6, 8, 10, 12, 13, 14, 15, 18, 23, 24, 40) for _ in range(8)]
    words = lambda item: [w if i % 5 else "zz" for i, w in enumerate(item.split())]
    texts = [" ".join([word(), word(), made, word()]) for item in items for made in (scattered(item, 20, rng), scattered(item, 14, rng), " ".join(words(item)))]
    found = {(r.doc_id, r.item_id): r.edits for r in decontam.leaks(table(texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    want = {(d, d // 3): decontam.least_edits([items[d // 3]], [text])[0] for d, text in enumerate(texts)}
    want = {k: v for k, v in want.items() if 100 * v <= 20 * len(items[k[1]])}
    same = sum(found.get(k) == v for k, v in want.items())
    assert len(want) > 250 and same >= 0.98 * len(want)
