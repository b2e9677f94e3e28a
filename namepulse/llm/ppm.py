"""Prediction by partial matching over bytes, escape method C with symbol exclusion.

Texts are bytes with A-Z in lower case, then one end symbol; before a text
stand end symbols. A context of ``order`` symbols predicts the next. A symbol
not seen after a context costs an escape, with the probability of the
context's distinct symbols over its count plus them, and the next shorter
context predicts it without the symbols that the longer one has seen. Below
order 0 the symbols left are equally likely.

Pretrained: all training texts' counts make the trie, and texts are scored by
it as it stands. Then a symbol's probability depends on the last ``order``
symbols alone: the symbols seen after a context are among those seen after its
shorter ones, so what is excluded at an order is what the next longer context
has seen. So every distinct run of ``order + 1`` symbols gets its probability
once. Runs are worked out in subtrees of the trie, by their last two context
symbols, one subtree group to a task at a time.

Scoring looks up frequent runs and words in tables of bounded size and joins
the others, so nothing grows in a task with the corpus. Adaptive: a text is
scored by a trie that starts empty and learns as it goes.

Null and empty texts are one end. Rows are scored one by one, repeated ones
too; a null id is scored and, as training, counts by its missing checksum: it
is not learned from. Without training texts the model is the uniform one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namepulse.llm import text as tx
from namepulse.llm.tables import settle, workers

ORDER = 5
BITS = 9
END = 256
ALPHABET = 257
WORD, RUN = 0, 1
#: Entries of each table that is shipped: 16 bytes each.
SHIPPED = 1 << 20
#: Groups of subtrees at least, and distinct runs to a group, about.
SUBTREES, GROUP_RUNS = 128, 400_000
#: Bytes of text whose words and runs are counted at once.
COUNTED = 1 << 20
#: The end token's key among the words' hashes.
END_TOKEN = np.uint64(1)


def _mask(order: int) -> int:
    return (1 << BITS * (order + 1)) - 1


def runs(chunk: tx.Chunk, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Every position's symbol with its context, packed, and the bounds of each text's positions."""
    n = len(chunk.offsets) - 1
    bounds = chunk.offsets + np.arange(n + 1)
    symbols = np.full(int(bounds[-1]) + order, END, np.int64)
    inside = np.ones(int(bounds[-1]), bool)
    inside[bounds[1:] - 1] = False
    symbols[order:][inside] = tx.LOWER[chunk.data]
    codes = symbols[: len(symbols) - order].copy()
    for i in range(1, order + 1):
        codes = (codes << BITS) | symbols[i : len(symbols) - order + i]
    # Contexts must not reach into the text before: its symbols become ends.
    for i in range(order):
        at = bounds[:-1] + i
        at = at[at < bounds[1:]]
        low = (1 << BITS * (i + 1)) - 1
        pad = sum(END << BITS * j for j in range(i + 1, order + 1))
        codes[at] = (codes[at] & low) | pad
    return codes, bounds


def _merge(keys: list, counts: list) -> tuple[np.ndarray, ...]:
    """Sums of the counts (columns) of equal keys."""
    keys = np.concatenate(keys)
    ordered, at = np.unique(keys, return_inverse=True)
    return ordered, *(np.bincount(at, np.concatenate(c), len(ordered)).astype(np.int64) for c in counts)


def _counts(order: int):
    """Words and runs of each chunk: how often in training texts, how often in all.

    A chunk's arrays are put out before the next is read: what a task holds
    follows from the chunk's size, not the batch's.
    """

    def run(batches):
        for batch in batches:
            train = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for chunk in tx.chunks(batch.column(1), COUNTED):
                own = train[chunk.first : chunk.first + len(chunk.offsets) - 1]
                words = tx.words(chunk, tx.LOWER[chunk.data])
                yield _counted(WORD, words.hashes, np.diff(words.bounds), own)
                del words
                codes, bounds = runs(chunk, order)
                yield _counted(RUN, codes, np.diff(bounds), own)

    return run


def _counted(kind: int, keys: np.ndarray, sizes: np.ndarray, train: np.ndarray) -> pa.RecordBatch:
    flags = np.repeat(train, sizes)
    found = [np.unique(keys[flags == learned], return_counts=True) for learned in (True, False)]
    values = [v.astype(np.uint64) for v, _ in found]
    learned = [n * i for (_, n), i in zip(found, (1, 0), strict=True)]
    keys, learned, n = _merge(values, [learned, [n for _, n in found]])
    kinds = pa.array(np.full(len(keys), kind, np.int32))
    return pa.RecordBatch.from_arrays([kinds, *map(tx.column, (keys, learned, n))], ["kind", "key", "train", "n"])


class _Order:
    """Counts of one order: contexts with their symbols, sorted by key."""

    def __init__(self, codes: np.ndarray, train: np.ndarray, order: int):
        keys, at = np.unique(codes & _mask(order), return_inverse=True)
        self.keys, self.counts = keys, np.bincount(at, train, len(keys))
        self.contexts, first = np.unique(keys >> BITS, return_index=True)
        self.totals = np.add.reduceat(self.counts, first) if len(keys) else np.zeros(0)
        self.distinct = np.diff(np.append(first, len(keys)))
        self.first = first

    def count(self, keys: np.ndarray) -> np.ndarray:
        return _look(self.keys, self.counts, keys)

    def seen_below(self, shorter: "_Order", order: int) -> np.ndarray:
        """For each context: the shorter context's count of the symbols seen here."""
        counts = shorter.count(self.keys & _mask(order - 1))
        return np.add.reduceat(counts, self.first) if len(self.keys) else np.zeros(0)


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of the wanted keys, 0 where a key is missing."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def log_probabilities(codes: np.ndarray, train: np.ndarray, order: int, low: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """log10 of each run's probability. ``low``: runs of order 1 and their counts over the whole corpus."""
    learned = train > 0
    low_codes, low_counts = low if low is not None else (codes[learned] & _mask(1), train[learned])
    orders = {k: _Order(low_codes & _mask(k), low_counts, k) for k in (0, 1)}
    orders |= {k: _Order(codes[learned], train[learned], k) for k in range(2, order + 1)}
    out, open_ = np.zeros(len(codes)), np.ones(len(codes), bool)
    gone_count, gone_distinct = np.zeros(len(codes)), np.zeros(len(codes))
    for k in range(order, -1, -1):
        own = orders[k]
        keys = codes & _mask(k)
        count = own.count(keys)
        context = keys >> BITS
        total = _look(own.contexts, own.totals, context) - gone_count
        distinct = _look(own.contexts, own.distinct, context) - gone_distinct
        hit = open_ & (count > 0)
        out[hit] += np.log10(count[hit] / (total[hit] + distinct[hit]))
        open_ &= count == 0
        escape = open_ & (total + distinct > 0)
        out[escape] += np.log10(distinct[escape] / (total[escape] + distinct[escape]))
        if k:
            gone_count = _look(own.contexts, own.seen_below(orders[k - 1], k), context)
            gone_distinct = _look(own.contexts, own.distinct, context)
    seen = len(orders[0].keys)
    if open_.any():
        out[open_] -= math.log10(ALPHABET - seen)
    return out


def _subtree(order: int, low: tuple[np.ndarray, np.ndarray]):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        codes, train = rows.column("key").to_numpy(), rows.column("train").to_numpy()
        value = log_probabilities(codes, train, order, low)
        return pa.table({"key": tx.column(codes), "n": rows.column("n"), "value": pa.array(value)})

    return run


def _frequent(table: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` keys occur that often."""
    rows = table.where("n > 0").groupBy(F.floor(F.log2("n")).alias("power")).count().collect()
    kept, floor = 0, 1 << 62
    for row in sorted(rows, key=lambda r: -r.power):
        kept += row["count"]
        if kept > most:
            break
        floor = 1 << row.power
    return floor


def _shipped(table: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    floor = _frequent(table, most)
    rows = table.where(F.col("n") >= floor).select("key", "value").toArrow()
    keys, values = (rows.column(c).to_numpy() for c in ("key", "value"))
    order = np.argsort(keys)
    return floor, keys[order], values[order]


_SCORED = "row long, doc_id long, held_out boolean, tokens long, known long, base double, score double, kind int, key long, n long"


def _score(order: int, words_, runs_, missing: float):
    """Each text's sums over shipped entries, and its other words and runs as rows to be joined."""

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        tables = {WORD: words_.value, RUN: runs_.value}
        for batch in batches:
            for chunk in tx.chunks(batch.column(2)):
                size = len(chunk.offsets) - 1
                numbers = row + np.arange(size)
                row += size
                words = tx.words(chunk, tx.LOWER[chunk.data])
                # The end is one more word of every text.
                hashes = np.insert(words.hashes, words.bounds[1:], END_TOKEN).view(np.int64)
                codes, bounds = runs(chunk, order)
                sums, known, rest = {}, None, []
                for kind, keys, ends in ((WORD, hashes, words.bounds + np.arange(size + 1)), (RUN, codes, bounds)):
                    own, values = tables[kind]
                    at = np.minimum(np.searchsorted(own, keys), len(own) - 1) if len(own) else np.zeros(len(keys), np.int64)
                    hit = own[at] == keys if len(own) else np.zeros(len(keys), bool)
                    found = np.where(hit, values[at], 0.0) if len(own) else np.zeros(len(keys))
                    doc = np.repeat(np.arange(size), np.diff(ends))
                    total = np.bincount(doc, found, size)
                    sums[kind] = total
                    if kind == WORD:
                        known = np.bincount(doc, hit & (found > missing), size).astype(np.int64)
                    if not hit.all():
                        # One row for all occurrences of a key in a text.
                        who, key = doc[~hit], keys[~hit]
                        order_ = np.lexsort((key, who))
                        who, key = who[order_], key[order_]
                        new = np.ones(len(who), bool)
                        new[1:] = (who[1:] != who[:-1]) | (key[1:] != key[:-1])
                        at = np.flatnonzero(new)
                        rest.append((kind, numbers[who[at]], key[at], np.diff(np.append(at, len(who)))))
                slice_ = [batch.column(i).slice(chunk.first, size) for i in (0, 1)]
                tokens = np.diff(words.bounds) + 1
                none = [pa.nulls(size, t) for t in (pa.int32(), pa.int64(), pa.int64())]
                columns = [pa.array(numbers), *slice_, *map(tx.column, (tokens, known, sums[WORD], sums[RUN])), *none]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORED.split(", ")])
                for kind, who, keys, times in rest:
                    n = len(keys)
                    columns = [pa.array(who), *(pa.nulls(n, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
                    columns += [pa.array(np.full(n, kind, np.int32)), pa.array(keys), pa.array(times, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORED.split(", ")])

    return run


def held_out(doc: str, part: int = 1, parts: int = 5):
    return F.pmod(F.crc32(F.col(doc).cast("string")), F.lit(parts)) == part


def score(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", order: int = ORDER, shipped: int = SHIPPED) -> DataFrame:
    """Every text's model and base scores; texts that are not held out are learned from.

    ``base_score`` sums log10 of ``(c + 0.5) / (N + 0.5 * (V + 1))`` over the
    words and one end: ``c`` the token's count, ``N`` all, ``V`` distinct, in
    training texts. ``score`` is log10 of the model's probability of the text.
    """
    workers()
    spark = docs.sparkSession
    named = docs.select(F.col(doc).cast("long").alias("doc_id"), held_out(doc).alias("held_out"), F.col(text).cast("string").alias("text"))
    learned = F.coalesce(~F.col("held_out"), F.lit(False))
    counts = named.select(learned.alias("train"), "text").mapInArrow(_counts(order), "kind int, key long, train long, n long")
    counts = settle(counts.groupBy("kind", "key").agg(F.sum("train").alias("train"), F.sum("n").alias("n")), "ppm-counts")
    ends = named.agg(F.count_if(learned), F.count("*")).first()
    words, grams = (counts.where(F.col("kind") == k).drop("kind") for k in (WORD, RUN))
    sums = words.agg(F.sum("train"), F.count_if(F.col("train") > 0)).first()
    total, distinct = (sums[0] or 0) + ends[0], sums[1] + (ends[0] > 0)
    below = math.log10(total + 0.5 * (distinct + 1))
    missing = math.log10(0.5) - below
    value = F.log10(F.col("train") + 0.5) - below
    words = words.select("key", "n", value.alias("value"))
    end = spark.createDataFrame([(int(END_TOKEN), int(ends[1]), math.log10(ends[0] + 0.5) - below)], words.schema)
    words = words.union(end)
    low = grams.where("train > 0").groupBy(F.col("key").bitwiseAND(_mask(1)).alias("key")).agg(F.sum("train").alias("train")).toArrow()
    low = low.column("key").to_numpy(), low.column("train").to_numpy()
    # A subtree: contexts with the same last two symbols; a group holds some of them.
    groups = max(SUBTREES, -(-grams.count() // GROUP_RUNS))
    group = F.pmod(F.xxhash64(F.shiftrightunsigned("key", BITS).bitwiseAND(_mask(1))), F.lit(groups))
    grams = settle(grams.groupBy(group.alias("part")).applyInArrow(_subtree(order, low), "key long, n long, value double"), "ppm-runs")
    tables = []
    for table in (words, grams):
        _, keys, values = _shipped(table, shipped)
        tables.append(spark.sparkContext.broadcast((keys, values)))
    scored = settle(named.mapInArrow(_score(order, *tables, missing), _SCORED), "ppm-scored")
    sums = scored.where("kind IS NULL")
    rest = scored.where("kind IS NOT NULL").select("kind", "key", "row", F.col("n").alias("times"))
    entries = words.withColumn("kind", F.lit(WORD)).union(grams.withColumn("kind", F.lit(RUN))).drop("n")
    rest = rest.join(entries, ["kind", "key"], "left")
    part = F.col("times") * F.col("value")
    word = F.col("kind") == WORD
    rest = rest.groupBy("row").agg(
        F.sum(F.when(word, part)).alias("more_base"),
        F.sum(F.when(~word, part)).alias("more_score"),
        F.sum(F.when(word & (F.col("value") > missing), F.col("times"))).alias("more_known"),
    )
    out = sums.join(rest, "row", "left").na.fill(0, ["more_base", "more_score", "more_known"])
    return out.select(
        F.col("doc_id").alias(doc),
        "held_out",
        F.col("tokens").alias("n_tokens"),
        (F.col("known") + F.col("more_known")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more_base")).alias("base_score"),
        (F.col("score") + F.col("more_score")).alias("score"),
    )


def adaptive_score(text: bytes, order: int = ORDER) -> float:
    """log10 of the probability of one text by a trie that learns it symbol by symbol."""
    trie: dict[tuple, dict[int, int]] = {}
    symbols = [END] * order + list(text.lower()) + [END]
    total = 0.0
    for at in range(order, len(symbols)):
        symbol, gone = symbols[at], set()
        contexts = [tuple(symbols[at - k : at]) for k in range(order, -1, -1)]
        for context in contexts:
            left = {s: n for s, n in trie.get(context, {}).items() if s not in gone}
            if left:
                both = sum(left.values()) + len(left)
                total += math.log10(left.get(symbol, len(left)) / both)
                if symbol in left:
                    break
                gone |= left.keys()
        else:
            total -= math.log10(ALPHABET - len(gone))
        for context in contexts:
            node = trie.setdefault(context, {})
            node[symbol] = node.get(symbol, 0) + 1
    return total


def score_adaptive(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """Every text's score by a trie of its own: ``doc``, ``score``."""
    workers()

    def run(batches):
        for batch in batches:
            values = [adaptive_score((t.as_py() or "").encode(), order) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    named = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string"))
    return named.mapInArrow(run, "doc_id long, score double").withColumnRenamed("doc_id", doc)
