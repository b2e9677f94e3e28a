"""Language ID by Bayesian evidence fusion.

Text evidence: hashed byte trigrams of a page's visible text under counts per
language of all labelled documents, weighed as at most ``EVIDENCE`` of them.
Other evidence: the language that the markup declares, wherever, and the suffix of the
address, with the chance of each given the language, and the host's languages
as a prior. A host's prior is smoothed towards its domain's, that towards the
whole table's; all are sums of the pages' text probabilities, without the page
that is judged, by grouped aggregation. A page's language has the greatest
product.

Null and empty pages are judged by address and host; a null address has an
empty host. Rows without language are not learned from. Repeated pages count as
often as they occur. Without labelled documents there are no languages and no
rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namepulse.llm import text as tx
from namepulse.llm.tables import settle, workers

BUCKETS = 1 << 16
EVIDENCE = 60
#: Weight of the wider prior, in pages.
SMOOTH = 5.0
#: The model is one row of BUCKETS values per language and goes to every task.
MOST_LANGUAGES = 1000
_HIDDEN = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_ROOT = re.compile(rb"(?i)<html\b")
_LANG = re.compile(rb"(?i)\slang\s*=\s*[\"']?([a-z]+)")


def visible(html: bytes) -> bytes:
    return _HIDDEN.sub(b" ", html)


def declared_language(html: bytes) -> str:
    """The language of the first ``html`` tag that has one, wherever in the page; each byte is passed once."""
    at = 0
    while tag := _ROOT.search(html, at):
        at = html.find(b">", tag.end())
        at = len(html) if at < 0 else at
        if found := _LANG.search(html, tag.end(), at):
            return found[1].lower().decode()
    return ""


def trigrams(chunk: tx.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of all texts, and the text of each."""
    data = tx.LOWER[chunk.data].astype(np.int64)
    doc = np.repeat(np.arange(len(chunk.offsets) - 1), np.diff(chunk.offsets))
    codes = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:] if len(data) > 2 else data[:0]
    same = doc[:-2] == doc[2:] if len(data) > 2 else doc[:0].astype(bool)
    return (tx.mix(codes[same].astype(np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.int64), doc[:-2][same] if len(data) > 2 else doc[:0]


def _count(batches):
    for batch in batches:
        langs = np.array([x.as_py() for x in batch.column(0)], object)
        sums: dict[str, np.ndarray] = {}
        for chunk in tx.chunks(batch.column(1)):
            buckets, doc = trigrams(chunk)
            own = langs[chunk.first : chunk.first + len(chunk.offsets) - 1][doc]
            for lang in set(own):
                sums[lang] = sums.get(lang, 0) + np.bincount(buckets[own == lang], minlength=BUCKETS)
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], ["lang", "bucket", "n"])


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and log probabilities of the buckets in each, from all labelled documents."""
    workers()
    labelled = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang IS NOT NULL")
    counts = labelled.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = settle(counts, "trigrams")
    langs = sorted(r.lang for r in counts.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table = np.full((len(langs), BUCKETS), 0.1)
    rows = counts.toArrow()
    place = {x: i for i, x in enumerate(langs)}
    at = np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64)
    table[at, rows.column("bucket").to_numpy()] += rows.column("n").to_numpy()
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _evidence(table: np.ndarray):
    def run(batches):
        for batch in batches:
            html = [(x.as_py() or "").encode() for x in batch.column("html")]
            declared = [declared_language(x) for x in html]
            shown = pa.array([visible(x).decode("utf-8", "ignore") for x in html], pa.string())
            logs = []
            for chunk in tx.chunks(shown):
                buckets, doc = trigrams(chunk)
                size = len(chunk.offsets) - 1
                n = np.maximum(np.bincount(doc, minlength=size), 1)
                sums = np.array([np.bincount(doc, row[buckets], size) for row in table])
                logs.append((sums / n * np.minimum(n, EVIDENCE)).T)
            logs = np.concatenate(logs) if logs else np.zeros((0, len(table)))
            logs -= logs.max(axis=1, keepdims=True) if len(logs) else 0
            columns = [batch.column(0), batch.column(1), pa.array(declared, pa.string()), pa.array(logs.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "declared", "logs"])

    return run


def identify(pages: DataFrame, docs: DataFrame, *, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: ``language``, its probability, the text's own best and the other evidence."""
    langs, table = fit(docs)
    named = pages.select(F.col(page).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    if not langs:
        named = named.limit(0)
    seen = named.mapInArrow(_evidence(table), "page_id long, url string, declared string, logs array<double>")
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))
    seen = seen.withColumn("host", host).withColumn("domain", F.substring_index("host", ".", -2)).withColumn("suffix", F.substring_index("host", ".", -1))
    total = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x))
    seen = settle(seen.withColumn("total", total).withColumn("row", F.monotonically_increasing_id()), "evidence")
    names = F.array(*map(F.lit, langs)) if langs else F.array().cast("array<string>")
    pair = F.explode(F.arrays_zip(names.alias("lang"), F.col("logs").alias("log"))).alias("pair")
    long = seen.select("row", "host", "domain", "suffix", "declared", "total", pair).select("*", "pair.lang", "pair.log").drop("pair")
    soft = long.withColumn("p", F.exp("log") / F.col("total"))
    sums = lambda *keys: soft.groupBy(*keys).agg(F.sum("p").alias("_".join(keys) + "_n"))
    out = soft
    for keys in (["host"], ["domain"], ["suffix"], ["declared"]):
        out = out.join(sums(*keys, "lang"), [*keys, "lang"])
    both = {}
    for key in ("host", "domain", "suffix", "declared"):
        both[key] = soft.groupBy(key).agg(F.sum("p").alias(f"{key}_all"))
        out = out.join(both[key], key)
    out = out.join(sums("lang"), "lang")
    everyone = float(seen.count())
    size = len(langs) or 1
    # Each count without the page itself.
    less = lambda c: F.greatest(F.col(c) - F.col("p"), F.lit(0.0))
    fewer = lambda c: F.greatest(F.col(c) - 1, F.lit(0.0))
    world = (less("lang_n") + 1) / (max(everyone - 1, 0) + size)
    domain = (less("domain_lang_n") + SMOOTH * world) / (fewer("domain_all") + SMOOTH)
    prior = (less("host_lang_n") + SMOOTH * domain) / (fewer("host_all") + SMOOTH)

    def given(key: str):
        """The chance of the page's value of ``key`` in this language."""
        share = F.col(f"{key}_all") / max(everyone, 1)
        return (less(f"{key}_lang_n") + SMOOTH * share) / (less("lang_n") + SMOOTH)

    score = F.col("log") + F.log(prior) + F.log(given("declared")) + F.log(given("suffix"))
    best = out.groupBy("row").agg(
        F.min(F.struct((-F.round(score, 9)).alias("s"), "lang")).alias("best"),
        F.min(F.struct((-F.col("log")).alias("s"), "lang")).alias("text_best"),
        F.collect_list(score).alias("scores"),
    )
    norm = F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.exp(x + F.col("best.s")))
    best = best.select("row", F.col("best.lang").alias("language"), (1 / norm).alias("probability"), F.col("text_best.lang").alias("text_language"))
    return seen.join(best, "row").select(F.col("page_id").alias(page), "language", F.round("probability", 6).alias("probability"), "text_language", "declared", "suffix", "host")
