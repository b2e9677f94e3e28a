"""Frequent phrases and how firmly they hold together, counted by direct addresses.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
those into words ``[^\\x20\\x09]+``. Phrases of k + 1 words are pairs of
overlapping phrases of k words, so each length is one pass over the texts that
counts pairs of neighbouring ids:

* Phrases of the length before that are frequent enough are ranked. The
  ``HEAD`` most frequent of all get small ids, their rank within their
  language; a pair of two such ids falls into a tile of ``TILE`` x ``TILE``
  cells. A tile is counted where its address says (``bincount``) once it is
  crowded, and kept as sorted (pair, count) lists before that.
* Other frequent phrases go by their 64-bit hash and are counted as sorted
  lists. A bit table of ``2**BITS`` bits says which hashes may be frequent; a
  phrase that is not breaks the chain, as no longer one with it is frequent.
  The table is 16 MB whatever the input; false positives cost rows, not results.
* Frequent pairs are ranked in turn, and so on up to ``longest`` words.

Texts are read once a length; nothing as long as a text is shuffled.

Counts are added up by pair: both small ids in one number, or the hashes of the
first and of the last words. Hashes are 64 bits wide and begin from the
language, so a hot word or language is spread over all its phrases.

A null text is an empty one; a null language is ``und``. Ids are not read:
repeated rows count as often as they occur. Ties are ordered by phrase. An
empty table gives no rows. A long text is cut into parts between its pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namepulse.llm import text as tx
from namepulse.llm.tables import settle, workers

HEAD = 1 << 16
TILE = 1 << 10
#: Tiles that a task holds at once: 4 MB each.
TILES = 16
BITS = 27
UNKNOWN = "und"
_BUCKET = 1 << 15
_IS_CUT = tx.table(b".,;:!?\x0a\x0b\x0c\x0d")
_IS_BLANK = tx.table(b"\x20\x09")
#: A pair of small ids is one number, with no second part; another pair is two hashes.
_PAIRS = "part long, other long, a long"
_ID_BITS = 32


def _words(chunk: tx.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a chunk: starts, ends, hashes, texts, and whether the word before is in the same piece."""
    data = tx.LOWER[chunk.data]
    cut = _IS_CUT[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~(cut | _IS_BLANK[data])
    starts, ends = inside[1:] & ~inside[:-1], ~inside[1:] & inside[:-1]
    between = chunk.offsets[1:-1]
    starts[between] |= inside[between + 1]
    ends[between] |= inside[between]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    doc = np.searchsorted(chunk.offsets, starts, "right") - 1
    sums = np.zeros(len(data) + 1, np.int32)
    np.cumsum(cut, out=sums[1:])
    joined = np.zeros(len(starts), bool)
    joined[1:] = (doc[1:] == doc[:-1]) & (sums[starts[1:]] == sums[ends[:-1]])
    return starts, ends, tx.range_hash(data, starts, ends), doc, joined


def _lang_hash(lang: str) -> int:
    data = np.frombuffer(lang.encode() or b"\0", np.uint8)
    # Mixed once more: a word spelt like a language must not undo another's hash.
    return int(tx.mix(tx.range_hash(data, np.array([0]), np.array([len(data)])))[0])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tx.Chunk, np.ndarray, list[str], np.ndarray]]:
    """Chunks with each text's language as a number, the languages, and their hashes."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        names = langs.dictionary.to_pylist()
        salts = np.array([_lang_hash(n) for n in names], np.uint64)
        number = np.asarray(langs.indices)
        for chunk in tx.chunks(batch.column(1), tx.CHUNK):
            own = number[chunk.first : chunk.first + len(chunk.offsets) - 1]
            if len(own) > 1 or len(chunk.data) <= 2 * tx.CHUNK:
                yield chunk, own, names, salts
                continue
            # One long text: phrases end where pieces do, so it may be cut there.
            cuts = np.flatnonzero(_IS_CUT[chunk.data])
            at = 0
            while at < len(chunk.data):
                to = int(np.searchsorted(cuts, at + tx.CHUNK))
                end = int(cuts[to]) + 1 if to < len(cuts) else len(chunk.data)
                yield tx.Chunk(chunk.first, chunk.data[at:end], np.array([0, end - at])), own, names, salts
                at = end


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, word, occurrences) of every chunk."""
    for chunk, lang, names, salts in _chunks(batches):
        starts, ends, hashes, doc, _ = _words(chunk)
        if not len(starts):
            continue
        own = lang[doc]
        _, first, n = np.unique(tx.mix(hashes ^ salts[own]), return_index=True, return_counts=True)
        lengths = (ends - starts)[first]
        places = np.repeat(starts[first] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        text = tx.LOWER[chunk.data[places]]
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        word = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.tobytes()), pa.py_buffer(text.tobytes()))
        langs = pa.array(names, pa.string()).take(pa.array(own[first]))
        yield pa.RecordBatch.from_arrays([langs, word.cast(pa.string()), pa.array(n, pa.int64())], ["lang", "word", "a"])


def _name_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash that stands for each (language, word)."""
    for batch in batches:
        for chunk, lang, names, salts in _chunks(iter([batch])):
            grams = tx.mix(tx.range_hash(chunk.data, chunk.offsets[:-1], chunk.offsets[1:]) ^ salts[lang])
            yield pa.RecordBatch.from_arrays([tx.column(grams), *(c.slice(chunk.first, len(lang)) for c in batch.columns)], ["gram", *batch.schema.names])


def _name_pairs(tables):
    """Pairs as counted to (phrase, first words, last words, occurrences)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, heads = tables.value
        for batch in batches:
            small = np.asarray(batch.column(1).is_null())
            head = np.asarray(batch.column(0)).view(np.uint64).copy()
            tail = np.asarray(batch.column(1).fill_null(0)).view(np.uint64).copy()
            ids = head[small].astype(np.int64)
            head[small], tail[small] = heads.gram_of[ids >> _ID_BITS], heads.gram_of[ids & ((1 << _ID_BITS) - 1)]
            yield pa.RecordBatch.from_arrays([tx.column(join(head, tail)), tx.column(head), tx.column(tail), batch.column(2)], ["gram", "head", "tail", "a"])

    return run


class _Tiles:
    """Counts of pairs of small ids: dense where a tile is crowded, at most ``TILES`` of them at once."""

    def __init__(self):
        self.dense: dict[int, np.ndarray] = {}

    def add(self, tile: np.ndarray, cell: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Count pairs; those of tiles that are not dense come back as (tile, cell, count)."""
        order = np.argsort(tile, kind="stable")
        tile, cell = tile[order], cell[order]
        if not len(tile):
            return
        at = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
        sparse = np.ones(len(tile), bool)
        for start, end in zip(at.tolist(), [*at[1:].tolist(), len(tile)], strict=True):
            key = int(tile[start])
            if key not in self.dense and end - start >= TILE * TILE // 64 and len(self.dense) < TILES:
                self.dense[key] = np.zeros(TILE * TILE, np.int32)
            if key in self.dense:
                if end - start >= TILE * TILE // 16:
                    self.dense[key] += np.bincount(cell[start:end], minlength=TILE * TILE).astype(np.int32)
                else:
                    cells, n = np.unique(cell[start:end], return_counts=True)
                    self.dense[key][cells] += n.astype(np.int32)
                sparse[start:end] = False
        both = tile[sparse].astype(np.int64) * (TILE * TILE) + cell[sparse]
        both, n = np.unique(both, return_counts=True)
        yield both // (TILE * TILE), both % (TILE * TILE), n

    def counted(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for key, counts in self.dense.items():
            cell = np.flatnonzero(counts)
            yield np.full(len(cell), key), cell, counts[cell].astype(np.int64)


class Heads:
    """Small ids of the most frequent phrases: languages one after the other, in each by rank."""

    def __init__(self, langs: list[str], grams: np.ndarray):
        number = {name: i for i, name in enumerate(sorted(set(langs)))}
        own = np.array([number[name] for name in langs], np.int64)
        self.gram_of = grams[np.argsort(own, kind="stable")]
        self.ids = np.argsort(self.gram_of)
        self.grams = self.gram_of[self.ids]
        self.tiles = -(-len(grams) // TILE)

    def id_of(self, grams: np.ndarray) -> np.ndarray:
        """The small id of each hash, or -1."""
        if not len(self.grams):
            return np.full(len(grams), -1)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, self.ids[at], -1)


def _slots(grams: np.ndarray) -> np.ndarray:
    return (tx.mix(grams) >> np.uint64(64 - BITS)).astype(np.int64)


def join(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """The hash of the phrase whose first words are ``head`` and whose last are ``tail``."""
    return tx.mix(head * tx._BASE + tail)


def _count_pairs(size: int, tables):
    """Counts of phrases of ``size`` words whose two parts may be frequent.

    ``tables``: the bits of all shorter frequent phrases, and the ``Heads`` of those one word shorter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, heads = tables.value
        n_tiles = heads.tiles
        tiles = _Tiles()

        def by_address(tile: np.ndarray, cell: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            a, b = tile // n_tiles * TILE + cell // TILE, tile % n_tiles * TILE + cell % TILE
            return _rows((a << _ID_BITS) | b, None, n)

        for chunk, lang, names, salts in _chunks(batches):
            _, _, hashes, doc, joined = _words(chunk)
            grams = tx.mix(hashes ^ salts[lang[doc]]) if len(doc) else hashes
            place = np.arange(len(grams))
            for length in range(1, size):
                # Of the phrases of this length, those that may be frequent; then pairs of neighbours among them.
                slot = _slots(grams)
                maybe = (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1
                grams, place = grams[maybe > 0], place[maybe > 0]
                follows = place[1:] == place[:-1] + 1
                if length == 1:
                    follows &= joined[place[1:]]
                near = np.flatnonzero(follows)
                head, tail = grams[near], grams[near + 1]
                grams, place = join(head, tail), place[near]
            if not len(grams):
                continue
            a, b = heads.id_of(head), heads.id_of(tail)
            small = (a >= 0) & (b >= 0)
            tile = a[small] // TILE * n_tiles + b[small] // TILE
            for found in tiles.add(tile, a[small] % TILE * TILE + b[small] % TILE):
                yield by_address(*found)
            rest, first, n = np.unique(grams[~small], return_index=True, return_counts=True)
            if len(rest):
                yield _rows(head[~small][first], tail[~small][first], n)
        for found in tiles.counted():
            yield by_address(*found)

    return run


def _rows(part: np.ndarray, other: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    second = pa.nulls(len(part), pa.int64()) if other is None else tx.column(other)
    return pa.RecordBatch.from_arrays([tx.column(part), second, pa.array(n, pa.int64())], ["part", "other", "a"])


def _bit_table(frequent: DataFrame) -> np.ndarray:
    """Which hashes may be frequent, as packed bits: 16 MB, whatever the input."""

    def slots(batches):
        for batch in batches:
            slot = _slots(np.asarray(batch.column(0)).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(slot // _BUCKET), pa.array(slot % _BUCKET)], ["bucket", "place"])

    placed = frequent.select("gram").mapInArrow(slots, "bucket long, place long")
    # Bit i of a bitmap is bit i % 8, from the lowest, of byte i // 8.
    rows = placed.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits")).toArrow()
    bits = np.zeros((1 << BITS) // 8, np.uint8)
    for bucket, part in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
        at = bucket * _BUCKET // 8
        low_first = np.unpackbits(np.frombuffer(part, np.uint8)[: _BUCKET // 8], bitorder="little")
        bits[at : at + _BUCKET // 8] = np.packbits(low_first)
    return bits


def _heads(frequent: DataFrame) -> Heads:
    top = frequent.orderBy(F.desc("a"), "lang", "gram").limit(HEAD).select("lang", "gram").toArrow()
    return Heads(top.column(0).to_pylist(), np.asarray(top.column(1)).view(np.uint64))


def phrases(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = 100,
    longest: int = 5,
) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases by length, as settled tables, and the words of each language.

    Tables of (lang, gram, head, tail, a, phrase, heads, tails): hashes of the
    phrase and of its first and last words but one; its occurrences; its text;
    and the occurrences of its first and of its last words, shortest first.
    """
    workers()
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    words = texts.mapInArrow(_count_words, "lang string, word string, a long")
    words = settle(words.groupBy("lang", "word").agg(F.sum("a").alias("a")), "words")
    sizes = words.groupBy("lang").agg(F.sum("a").alias("n"))
    none = F.array().cast("array<long>")
    levels = [
        settle(
            words.where(F.col("a") >= least).mapInArrow(_name_words, "gram long, lang string, word string, a long").select(
                "lang", "gram", F.lit(None).cast("long").alias("head"), F.lit(None).cast("long").alias("tail"), "a",
                F.col("word").alias("phrase"), none.alias("heads"), none.alias("tails"),
            ),
            "phrases-1",
        )
    ]
    bits = np.zeros((1 << BITS) // 8, np.uint8)
    for size in range(2, longest + 1):
        before = levels[-1]
        bits |= _bit_table(before)
        tables = spark.sparkContext.broadcast((bits, _heads(before)))
        pairs = texts.mapInArrow(_count_pairs(size, tables), _PAIRS)
        pairs = pairs.groupBy("part", "other").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
        pairs = settle(pairs.mapInArrow(_name_pairs(tables), "gram long, head long, tail long, a long"), f"pairs-{size}")
        # A phrase's hash belongs to one language, that of its words.
        first = before.select("lang", F.col("gram").alias("head"), F.col("phrase").alias("start"), F.col("heads").alias("h"), F.col("a").alias("ha"))
        last = before.select(F.col("gram").alias("tail"), F.col("phrase").alias("end"), F.col("tails").alias("t"), F.col("a").alias("ta"))
        found = pairs.join(first, "head").join(last, "tail")
        levels.append(
            settle(
                found.select(
                    "lang", "gram", "head", "tail", "a",
                    F.concat_ws(" ", "start", F.substring_index("end", " ", -1)).alias("phrase"),
                    F.concat("h", F.array("ha")).alias("heads"), F.concat("t", F.array("ta")).alias("tails"),
                ),
                f"phrases-{size}",
            )
        )
        tables.unpersist()
    return levels, sizes


def collocations(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = 100,
    longest: int = 5,
    most: int = 2000,
) -> DataFrame:
    """The ``most`` firmest phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    A phrase is cut where its score is least; one that nearly always stands in
    a longer frequent phrase (as often as that) is left out.
    """
    levels, sizes = phrases(docs, text=text, lang=lang, least=least, longest=longest)
    kept = []
    for size in range(2, longest + 1):
        level = levels[size - 1]
        if size < longest:
            # A longer phrase is never more frequent: one of the same count one word longer decides.
            longer = levels[size].select("lang", "a", F.explode(F.array("head", "tail")).alias("gram")).distinct()
            level = level.join(longer, ["lang", "gram", "a"], "left_anti")
        kept.append(level.select("lang", "phrase", "a", "heads", "tails"))
    rows = kept[0]
    for more in kept[1:]:
        rows = rows.union(more)
    wide = lambda name: f"cast({name} as decimal(19, 0))"
    # Products pass 64 bits: 38 decimal digits hold them.
    whole = f"cast(cast(1000 as decimal(4, 0)) * cast({wide('a')} * {wide('n')} as decimal(34, 0)) as decimal(38, 0))"
    cuts = f"transform(heads, (l, i) -> struct(({whole}) div cast({wide('l')} * {wide('tails[size(tails) - 1 - i]')} as decimal(38, 0)) as score, i, l, tails[size(tails) - 1 - i] as r))"
    best = rows.join(sizes, "lang").select("lang", "phrase", "a", "n", F.expr(f"array_min({cuts})").alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
