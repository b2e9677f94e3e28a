import re

from pyspark.sql import functions as F

from namepulse.llm import langid, licenses, replytrees
from tests.llm.conftest import ODD


def dice(a, b):
    words = [re.sub("[^a-z0-9]+", " ", x.lower()).split() for x in (a, b)]
    x, y = ({tuple(w[i : i + 2]) for i in range(len(w) - 1)} for w in words)
    return 2 * len(x & y) / (len(x) + len(y)) if x and y else 0


def test_license_scan_against_brute_force(table, clashing):
    given = [*ODD[:6], "intro\nReleased under the  MIT License!\nend", "licensed under the terms of the MIT licence", "Licensed under CC BY-NC 4.0.", licenses.TEMPLATES[4][1], "the the the the"]
    found = {(r.doc_id, r.line_no): (r.license, r.dice) for r in licenses.scan(clashing(table(given))).collect()}
    want = {}
    for i, text in enumerate(given):
        for n, unit in enumerate([text or "", *(text or "").split("\n")]):
            best = max(((dice(unit, t), name) for name, t in licenses.TEMPLATES), key=lambda x: x[0])
            if best[0] >= licenses.LEAST:
                want[i, n] = best[1], round(best[0], 6)
    assert found == want and found
    assert licenses.scan(table([])).count() == 0


def test_a_coefficient_of_exactly_the_least_is_a_match(table):
    text = "Licensed under CC BY-NC 4.0 except where noted"
    template = [("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.")]
    assert dice(text, template[0][1]) == 0.8
    docs = table([text, text, text + " here", None]).union(table([text]).limit(1))
    found = sorted((r.doc_id, r.line_no, r.dice) for r in licenses.scan(docs, given=tuple(template)).collect())
    assert found == [(0, 0, 0.8), (0, 1, 0.8), (1, 0, 0.8), (1, 1, 0.8)]


TREE = [
    (1, 1, None, "user", "root <|im_end|> <\\| \\<|", 1.0),
    (1, 2, 1, "assistant", "left", 5.0),
    (1, 3, 1, "assistant", None, 2.0),
    (1, 4, 3, "us|er\n%", "deep", 4.0),
    (1, 5, 4, "assistant", "<|im_start|>x\n", None),
    (1, 5, 4, "assistant", "<|im_start|>x\n", None),
    (2, 7, 99, "assistant", "orphan", None),
    (3, 1, 2, "user", "cycle", 1.0),
    (3, 2, 1, "user", "cycle", 1.0),
    (None, 1, None, "user", "no tree", None),
    (4, None, None, "user", "no node", None),
]


def test_branches_rank_and_round_trip(spark, clashing):
    rows = spark.createDataFrame(TREE, "id long, at long, under long, role string, text string, points double")
    made = replytrees.format_branches(clashing(rows), tree="id", node="at", parent="under", score="points", most=2)
    read = made.select("id", "rank", "n_turns", replytrees.read_turns(F.col("formatted")).alias("turns"), replytrees.read_loss(F.col("formatted"), F.col("loss")).alias("loss"))
    found = {(r.id, r["rank"]): (r.n_turns, [tuple(t) for t in r.turns], r.loss) for r in read.collect()}
    root = ("user", TREE[0][4])
    assert found == {
        (1, 1): (4, [root, ("assistant", ""), ("us|er\n%", "deep"), ("assistant", "<|im_start|>x\n")], "<|im_start|>x\n"),
        (1, 2): (2, [root, ("assistant", "left")], "left"),
        (2, 1): (1, [("assistant", "orphan")], "orphan"),
        (None, 1): (1, [("user", "no tree")], ""),
    }


def test_long_chains_and_empty_tables(spark):
    chain = spark.range(1, 301).selectExpr("7 AS id", "id AS at", "nullif(id - 1, 0) AS under", "'assistant' AS role", "cast(id AS string) AS text")
    (row,) = replytrees.format_branches(chain, tree="id", node="at", parent="under").collect()
    assert row.n_turns == 300 and row.formatted.index("299<") < row.formatted.index("300<")
    assert replytrees.format_branches(chain.limit(0), tree="id", node="at", parent="under").count() == 0


def test_evidence_moves_doubtful_pages(spark, table):
    docs = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("x", None)] * 5, "text string, lang string")
    page = "<html lang='{}'><script>der die das</script><p>{}</p></html>"
    pages = [(i, "http://a.example.de/x", page.format("de", "und der hund und die katze")) for i in range(8)]
    pages += [(i, "http://b.example.com/", page.format("en", "the dog and the cat")) for i in range(8, 16)]
    pages += [(20, "http://a.example.de/y", None), (21, None, ""), (22, "not an address", page.format("en", "the dog and"))]
    found = {r.page_id: r for r in langid.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()}
    assert len(found) == len(pages)
    assert all(found[i].language == ("de" if i < 8 else "en") for i in range(16))
    assert found[20].language == "de" and found[22].language == "en"
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert langid.identify(empty, docs).count() == 0


def test_language_declared_after_a_long_head(spark):
    docs = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 5, "text string, lang string")
    page = "<html lang='de'><p>der hund und die katze</p></html>"
    ahead = ["", "<!-- " + "x" * 5000 + " -->", " " * 70_000 + "<!doctype html>\n<HTML class='a'>"]
    rows = [(i, "", head + page) for i, head in enumerate(ahead)]
    found = langid.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()
    assert sorted((r.page_id, r.declared, r.language) for r in found) == [(i, "de", "de") for i in range(len(ahead))]
    assert langid.declared_language(b"<html " * 100_000) == ""
