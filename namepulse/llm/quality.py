"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Every document gets a vector of transformed statistics. Each group (language
and source), each language and the whole table has an estimate of its mean and
covariance: that of a half of its documents whose covariance has the least
determinant. It is sought by concentration steps over all documents, each of
which takes the half nearest to the last estimate, until the determinant stands
still; from three starts (``STARTS``), of whose ends the least one stays. A
document far from its group's estimate by Mahalanobis distance is rejected.

Medians and the half's radius come from counts over a fine fixed grid, so a
group is never gathered, however large; means and products are partial sums.
The mean and covariance of a group of ``n`` documents that pass the base rule
are drawn towards its language's by ``n / (n + SHRINK)``, and so are a
language's towards the whole table's; there is no least size. The whole table
is estimated first, then languages, then groups, so that what an estimate is
drawn towards stands still and determinants of a key can be compared.
Null languages and sources form groups of their own. Null
and empty texts have zero statistics and fail the base rule. Repeated rows are
judged one by one. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namepulse.llm import text as tx
from namepulse.llm.tables import settle, workers

SYMBOLS = tx.table(b"#*$%&|<>")
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Least spread of each statistic: smaller differences say nothing.
FLOORS = {"length": 0.5, "word_length": 0.08, "symbols": 0.05, "dup_lines": 0.5, "repeats": 0.15}
STATS = tuple(FLOORS)
GRID = 0.01
#: Documents that weigh as much as the wider estimate does.
SHRINK = 20
#: Where the search for the least determinant starts: the medians with the scaled median deviations, the mean
#: and covariance of all documents, and the medians with ``FLOORS`` as the unit of every statistic.
STARTS = ("medians", "all", "units")
#: A logarithm of a determinant that falls by less stands still.
STILL = 1e-3
#: 5 degrees of freedom, upper tail 1e-5.
LIMIT = 30.9


def _repeated(words: tx.Words) -> np.ndarray:
    """For each text: words within windows that occur twice or more in it."""
    flags = np.zeros(len(words.starts) + 1, np.int64)
    hashes, doc = tx.windows(words, WINDOW)
    keys = tx.mix(hashes + doc.astype(np.uint64) * tx._BASE)
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice):
        at, _ = tx.window_starts(words, WINDOW)
        place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
        at = at[twice[place] == keys]
        np.add.at(flags, at, 1)
        np.add.at(flags, at + WINDOW, -1)
    return tx.per_text(np.cumsum(flags[:-1]) > 0, words.bounds)


def _dup_lines(chunk: tx.Chunk, words: tx.Words) -> np.ndarray:
    starts, ends, bounds = tx.lines(chunk)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    written = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    hashes, doc = tx.range_hash(chunk.data, starts[written], ends[written]), doc[written]
    keys = tx.mix(hashes + doc.astype(np.uint64) * tx._BASE)
    _, first = np.unique(keys, return_index=True)
    n = len(bounds) - 1
    return np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)


def measure(texts: pa.Array) -> list[np.ndarray]:
    """The counts named in ``COUNTS`` for each text of a column."""
    parts = []
    for chunk in tx.chunks(texts):
        words = tx.words(chunk)
        point = ~(tx.IS_SPACE | tx.IS_TAIL)
        parts.append(
            [
                np.diff(words.bounds),
                tx.per_text(point[chunk.data], chunk.offsets),
                tx.per_text(SYMBOLS[chunk.data], chunk.offsets),
                _dup_lines(chunk, words),
                _repeated(words),
            ]
        )
    return [np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 5


def _measured(batches):
    for batch in batches:
        counts = measure(batch.column("_text"))
        rest = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*rest, *map(tx.column, counts)], [*batch.schema.names[:-1], *COUNTS])


def statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of each document and its counts."""
    workers()
    columns = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema.fields[:-1])
    return columns.mapInArrow(_measured, ", ".join([schema, *(f"{c} long" for c in COUNTS)]))


def base_failed(least_words: int = 20, repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def vector() -> dict[str, Column]:
    """Transformed statistics: logarithms of sizes, square roots of rates."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "length": F.log(words),
        "word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "symbols": F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "dup_lines": F.log1p(F.col("n_dup_lines").cast("double")),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
    }


def _levels(rows: DataFrame) -> DataFrame:
    """Each row once for its group, once for its language and once for the whole table."""
    keys = F.array(
        F.struct(F.lit(0).alias("level"), F.col("lang"), F.col("source")),
        F.struct(F.lit(1).alias("level"), F.col("lang"), F.lit(None).cast("string").alias("source")),
        F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")),
    )
    return rows.withColumn("key", F.explode(keys))


def _weighted_median(counts: DataFrame, keys: list[str], value: str, share: float = 0.5) -> DataFrame:
    """The least grid value at which ``share`` of a key's weight ``n`` is reached; a key has few grid values."""
    from pyspark.sql import Window

    by = Window.partitionBy(*keys)
    summed = counts.select(
        "*", F.sum("n").over(by.orderBy(value)).alias("upto"), F.sum("n").over(by).alias("all")
    )
    return summed.where(F.col("upto") >= F.col("all") * share).groupBy(*keys).agg(F.min(value).alias("at"))


def _starts(rows: DataFrame) -> DataFrame:
    """``key, start, mean, spread`` of each key and each of ``STARTS``."""
    names = F.create_map(*(x for s in STATS for x in (F.lit(s), F.round(F.col(s) / GRID).cast("long"))))
    counted = rows.groupBy("key", *STATS).agg(F.sum("n").alias("n"))
    cells = counted.select("key", "n", F.explode(names).alias("stat", "cell"))
    cells = cells.groupBy("key", "stat", "cell").agg(F.sum("n").alias("n"))
    middle = _weighted_median(cells, ["key", "stat"], "cell").withColumnRenamed("at", "middle")
    off = cells.join(middle, ["key", "stat"]).withColumn("off", F.abs(F.col("cell") - F.col("middle")))
    off = off.groupBy("key", "stat", "off").agg(F.sum("n").alias("n"))
    spread = _weighted_median(off, ["key", "stat"], "off")
    both = middle.join(spread, ["key", "stat"]).groupBy("key")
    pick = lambda s, c: F.max(F.when(F.col("stat") == s, F.col(c))) * GRID
    means = [pick(s, "middle").alias(f"mean_{s}") for s in STATS]
    spreads = [F.greatest(1.4826 * pick(s, "at"), F.lit(FLOORS[s])).alias(f"sd_{s}") for s in STATS]
    table = both.agg(*means, *spreads)
    diagonal = lambda of: F.array(*(F.array(*(of(s) if s == t else F.lit(0.0) for t in STATS)) for s in STATS))
    kinds = {"medians": diagonal(lambda s: F.col(f"sd_{s}") ** 2), "units": diagonal(lambda s: F.lit(FLOORS[s] ** 2))}
    own = F.explode(F.array(*(F.struct(F.lit(k).alias("start"), v.alias("spread")) for k, v in kinds.items()))).alias("own")
    middles = table.select("key", F.array(*(f"mean_{s}" for s in STATS)).alias("mean"), own)
    every = _moments(rows.withColumn("start", F.lit("all")))
    return middles.select("key", "own.start", "mean", "own.spread").unionByName(every)


def _moments(rows: DataFrame) -> DataFrame:
    """``key, start, mean, spread`` of the given rows; floors keep the covariance regular."""
    sums = [F.sum(F.col("n") * F.col(s)) for s in STATS]
    products = [F.sum(F.col("n") * F.col(s) * F.col(t)) for s in STATS for t in STATS]
    moments = rows.groupBy("key", "start").agg(F.sum("n").cast("double").alias("n"), F.array(*sums).alias("sums"), F.array(*products).alias("products"))
    mean = [F.col("sums")[i] / F.col("n") for i in range(len(STATS))]

    def spread(i: int, j: int) -> Column:
        """The nearest half spreads less than all: the consistency factor for 5 statistics."""
        own = 1.9 * (F.col("products")[i * len(STATS) + j] / F.col("n") - mean[i] * mean[j])
        return own + FLOORS[STATS[i]] ** 2 if i == j else own

    spreads = F.array(*(F.array(*(spread(i, j) for j in range(len(STATS)))) for i in range(len(STATS))))
    return moments.select("key", "start", F.array(*mean).alias("mean"), spreads.alias("spread"))


def _drawn(raw: DataFrame, sizes: DataFrame, wide: DataFrame | None, shrink: float) -> DataFrame:
    """``key, start, mean, spread, inverse, det`` from what each key gives alone, drawn towards ``wide``.

    ``wide`` holds the estimates one level up: one row, or one a language.
    """
    if wide is not None:
        above = wide.select(F.col("key.level").alias("up"), F.col("key.lang").alias("up_lang"), F.col("mean").alias("up_mean"), F.col("spread").alias("up_spread"))
        same = (F.col("key.level") + 1 == F.col("up")) & ((F.col("up") == 2) | F.col("key.lang").eqNullSafe(F.col("up_lang")))
        raw = raw.join(sizes, "key").withColumn("own", F.col("all") / (F.col("all") + shrink)).join(above, same)
        blend = lambda a, b: F.zip_with(a, b, lambda x, y: F.col("own") * x + (1 - F.col("own")) * y)
        spread = F.zip_with("spread", "up_spread", lambda a, b: blend(a, b))
        raw = raw.select("key", "start", blend("mean", "up_mean").alias("mean"), spread.alias("spread"))
    schema = raw.withColumns({"inverse": F.col("spread"), "det": F.lit(0.0)}).schema
    return raw.mapInArrow(_inverses, schema)


def distance() -> Column:
    """Squared Mahalanobis distance of the statistics from ``mean`` under ``inverse``."""
    off = [F.col(s) - F.col("mean")[i] for i, s in enumerate(STATS)]
    terms = [off[i] * off[j] * F.col("inverse")[i][j] for i in range(len(STATS)) for j in range(len(STATS))]
    return reduce(lambda a, b: a + b, terms)


def _inverses(batches):
    for batch in batches:
        spread = np.array(batch.column("spread").to_pylist()).reshape(-1, len(STATS), len(STATS))
        inverse, det = (np.linalg.inv(spread), np.linalg.slogdet(spread)[1]) if len(spread) else (spread, np.zeros(0))
        kind = pa.list_(pa.list_(pa.float64()))
        columns = [*(batch.column(c) for c in ("key", "start", "mean", "spread")), pa.array(inverse.tolist(), kind), pa.array(det, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["key", "start", "mean", "spread", "inverse", "det"])


def _nearest(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """The half of each key's documents nearest to each of its estimates, whole rings of equal distance."""
    far = rows.join(estimate.select("key", "start", "mean", "inverse"), "key")
    far = far.withColumn("ring", F.floor(F.least(F.log1p(distance()), F.lit(20.0)) / GRID)).drop("mean", "inverse")
    counts = far.groupBy("key", "start", "ring").agg(F.sum("n").alias("n"))
    radius = _weighted_median(counts, ["key", "start"], "ring")
    return far.join(radius, ["key", "start"]).where("ring <= at")


def _least(rows: DataFrame, sizes: DataFrame, wide: DataFrame | None, shrink: float) -> DataFrame:
    """Each key's estimate of least determinant: ``key, start, mean, spread, inverse, det``.

    A key's start is done with when a step no longer lowers its determinant;
    only the others go on. Determinants fall by ``STILL`` at least, so steps end.
    """
    columns = ["key", "start", "mean", "spread", "inverse", "det", "falls"]
    step = lambda estimate: _drawn(_moments(_nearest(rows, estimate)), sizes, wide, shrink)
    first = settle(_drawn(_starts(rows), sizes, wide, shrink), "quality-start")
    now = settle(step(first).withColumn("falls", F.lit(True)).select(columns), "quality-step")
    fallen = [now]
    while not fallen[-1].isEmpty():
        before = fallen[-1].select("key", "start", F.col("det").alias("before"))
        later = step(fallen[-1]).join(before, ["key", "start"])
        now = settle(later.withColumn("falls", F.col("det") < F.col("before") - STILL).select(columns), "quality-step")
        fallen.append(now.where("falls"))
    # Of a start's estimates the last that fell has the least determinant.
    every = reduce(DataFrame.union, fallen)
    least = every.groupBy("key").agg(F.min_by(F.struct("start", "mean", "spread", "inverse", "det"), F.struct("det", "start")).alias("least"))
    return settle(least.select("key", "least.*"), "quality-least")


def estimates(stats: DataFrame, shrink: float = SHRINK) -> DataFrame:
    """``key``, ``mean``, ``inverse``, ``det`` (its logarithm) and ``start`` of every group, language and the whole table.

    ``stats`` has ``lang``, ``source`` and the transformed statistics, which are
    rounded to the grid, so that equal vectors become one row with a weight.
    """
    cells = [(F.round(F.col(s) / GRID) * GRID).alias(s) for s in STATS]
    grid = stats.select("lang", "source", *cells).groupBy("lang", "source", *STATS).agg(F.count("*").alias("n"))
    rows = _levels(settle(grid, "quality-grid"))
    rows = settle(rows.groupBy("key", *STATS).agg(F.sum("n").alias("n")), "quality-rows")
    sizes = settle(rows.groupBy("key").agg(F.sum("n").alias("all")), "quality-sizes")
    level = lambda i: rows.where(F.col("key.level") == i)
    whole = _least(level(2), sizes, None, shrink)
    langs = _least(level(1), sizes, whole, shrink)
    groups = _least(level(0), sizes, langs, shrink)
    return groups.union(langs).union(whole).select("key", "mean", "inverse", "det", "start")


def judge(
    docs: DataFrame, *, doc: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", limit: float = LIMIT
) -> DataFrame:
    """Each document's counts, ``base_failed``, ``distance`` (squared) and ``kept``.

    The estimates are made from the documents that pass the base rule.
    """
    named = docs.select(F.col(doc).alias("doc_id"), *_grouped(lang, source), F.col(text).alias("text"))
    stats = settle(_with_vector(statistics(named, ["doc_id", "lang", "source"])), "quality-stats")
    far = _judged(stats, estimates(stats.where("NOT base_failed")), limit)
    return far.select(F.col("doc_id").alias(doc), *COUNTS, "base_failed", "kept", "distance")


def keep_rows(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", limit: float = LIMIT
) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, unchanged. Texts are read twice and never shuffled."""
    carried = [F.col(c).alias(f"_{i}") for i, c in enumerate(docs.columns)]
    named = docs.select(*carried, *_grouped(lang, source), F.col(text).alias("text"))
    stats = _with_vector(statistics(named.select("lang", "source", "text"), ["lang", "source"]))
    estimate = estimates(stats.where("NOT base_failed"))
    again = _with_vector(statistics(named, [c for c in named.columns if c != "text"]))
    kept = _judged(again, estimate, limit).where("kept")
    return kept.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)))


def _grouped(lang: str, source: str) -> list[Column]:
    return [F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source")]


def _with_vector(counts: DataFrame) -> DataFrame:
    return counts.withColumns(vector() | {"base_failed": base_failed()})


def _judged(stats: DataFrame, estimate: DataFrame, limit: float) -> DataFrame:
    """With the distance from the closest estimate there is: group, language or whole table."""
    far = stats
    for level, on in enumerate((["lang", "source"], ["lang"], [])):
        own = estimate.where(F.col("key.level") == level)
        own = own.select(
            *(F.col(f"key.{c}").alias(f"own_{c}") for c in on), F.struct("mean", "inverse").alias(f"level_{level}")
        )
        match = [F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in on]
        if on:
            far = far.join(own, match, "left").drop(*(f"own_{c}" for c in on))
        else:
            # One row, or none where no document passed the base rule.
            far = far.join(F.broadcast(own.limit(1)), F.lit(True), "left")
    chosen = F.coalesce("level_0", "level_1", "level_2")
    far = far.withColumns({"mean": chosen["mean"], "inverse": chosen["inverse"]}).withColumn("distance", distance())
    return far.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit))
