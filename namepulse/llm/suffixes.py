"""Suffix-array dedup: repeated byte strings by a distributed difference cover.

A byte goes if a string of ``length`` bytes that covers it starts at another
place too. Texts are cut at anchors, chosen by content (least hash of a
window), so that every string of ``length`` bytes holds one and equal strings
hold equal ones. The blocks between anchors are the symbols of the suffix
array; anchors found once, which no repeat can hold, part its strings.

Difference cover: suffixes at block numbers 1 and 2 modulo 3 are named by
sorted triples, names are sorted again in pairs until equal ones cover
``length`` bytes, and suffixes at 0 are merged in: with those at 1 by their
block and the name behind it, with those at 2 by two blocks and the name behind
them. In each sorted list neighbours' prefixes are compared; this gives each
anchor its reach, the longest repeat in whole blocks.

An exact check brings the ends to the byte: of the strings of ``length`` bytes
whose anchors lie within reach, hashes are counted in buckets, packed, without
a row for each. Equal texts are one from the start and all their bytes go.

Null and empty texts have no bytes. Texts shorter than ``length`` lose
nothing. Repeated rows are copies of each other. Empty tables give no rows.
Hashes have 64 bits, those counted 48 and the bucket's. A suffix's names are compared
whole, never cut short below ``length`` bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namepulse.llm import text as tx
from namepulse.llm.tables import settle, workers

LENGTH = 400
BLOCK_BYTES = 4 << 20
BYTES_PER_BUCKET = 1 << 21
_BLOOM_BITS = 23
_LAST = np.uint64(2**64 - 1)


def _sizes(length: int) -> tuple[int, int]:
    """Bytes of an anchor's gram, and how many grams' least one is an anchor."""
    gram = max(1, length // 6)
    return gram, max(1, (length - gram + 1) * 3 // 4)


def _slide(values: np.ndarray, width: int, best: np.ufunc, fill: int) -> np.ndarray:
    """``best`` of each ``values[i : i + width]``."""
    padded = np.full(-(-(len(values) + width) // width) * width, fill, values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = best.accumulate(rows, axis=1).ravel()
    behind = best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: len(values)], ahead[width - 1 : len(values) + width - 1])


class Anchors:
    """Anchors of the texts of a chunk: place, text, number in the text, the gram's hash, the block's name and size."""

    def __init__(self, chunk: tx.Chunk, length: int):
        gram, width = _sizes(length)
        data, offsets = chunk.data, chunk.offsets
        size = len(data)
        up, down = tx.powers(size + 1)
        self.sums = np.zeros(size + 1, np.uint64)
        np.cumsum(tx._VALUES[data] * up[:-1], out=self.sums[1:])
        self.down = down
        place = np.arange(size)
        end = np.repeat(offsets[1:], np.diff(offsets))
        hashes = np.full(size, _LAST)
        if size >= gram:
            some = tx.mix((self.sums[gram:] - self.sums[:-gram]) * down[: size - gram + 1]) >> np.uint64(1)
            hashes[: size - gram + 1] = some
        hashes[place + gram > end] = _LAST
        least = _slide(hashes, width, np.minimum, int(_LAST)) if size else hashes
        least[place + gram + width - 1 > end] = 0
        self.least = least
        most = _slide(np.concatenate([np.zeros(width - 1, np.uint64), least]), width, np.maximum, 0)[:size] if size else least
        self.at = np.flatnonzero((most == hashes) & (hashes < _LAST))
        self.doc = np.searchsorted(offsets, self.at, "right") - 1
        self.bounds = np.searchsorted(self.at, offsets)
        self.number = np.arange(len(self.at)) - self.bounds[self.doc]
        self.gram = hashes[self.at]
        stop = offsets[self.doc + 1]
        follows = np.append(self.doc[1:] == self.doc[:-1], False) if len(self.at) else np.zeros(0, bool)
        after = np.append(self.at[1:], 0) + gram if len(self.at) else self.at
        self.ends = np.where(follows, after, stop)
        self.name = tx.mix((self.sums[self.ends] - self.sums[self.at]) * down[self.at] + (self.ends - self.at).astype(np.uint64))
        self.size = self.ends - self.at
        # How far the next block lies: sizes overlap by a gram.
        self.step = np.where(follows, self.size - gram, self.size)


_BLOCKS = "tid long, number int, gram long, name long, size int, step int"


def _blocks(length: int):
    def run(batches):
        for batch in batches:
            tids = batch.column(0).to_numpy()
            for chunk in tx.chunks(batch.column(1)):
                own = Anchors(chunk, length)
                columns = [pa.array(tids[chunk.first + own.doc]), pa.array(own.number, pa.int32()), tx.column(own.gram), tx.column(own.name)]
                columns += [pa.array(x, pa.int32()) for x in (own.size, own.step)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BLOCKS.split(", ")])

    return run


def _repeated(blocks: DataFrame, by: str) -> DataFrame:
    """Blocks of which ``by`` is found at two places at least."""
    place = F.struct("tid", "number")
    ends = blocks.groupBy(by).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").select(by)
    return blocks.join(ends, by)


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rank`` of each distinct key in sorted order, how often it occurs and the least bytes it covers."""
    distinct = rows.groupBy(*keys).agg(F.count("*").alias("times"), F.min("span").alias("least"))
    ordered = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return settle(ordered.withColumn("rank", F.monotonically_increasing_id() + 1), "suffix-ranks")


def _next(column: str, ahead: int, by: Window):
    """The column ``ahead`` rows on, if that is ``ahead`` blocks on; 0 where the string ends before."""
    return F.when(F.lead("number", ahead).over(by) == F.col("number") + ahead, F.lead(column, ahead).over(by)).otherwise(F.lit(0))


def _names(symbols: DataFrame, length: int) -> DataFrame:
    """Sampled suffixes with the rank of their name: ``tid, number, rank``."""
    keys = ["name", "name1", "name2"]
    whole = F.col("step") + F.col("step1") + F.col("step2")
    # Where the string ends, its name is complete.
    span = F.when(F.col("name2") == 0, F.lit(length)).otherwise(whole).cast("long")
    sample = symbols.where("number % 3 != 0").withColumn("span", span)
    ranks = _ranked(sample, keys)
    sample = settle(sample.join(ranks, keys).select("tid", "number", "rank", "span"), "suffix-names")
    hop = 3
    while not ranks.where((F.col("times") > 1) & (F.col("least") < length)).isEmpty():
        own = sample.withColumnRenamed("rank", "rank0")
        later = sample.select("tid", (F.col("number") - hop).alias("number"), F.col("rank").alias("rank1"), F.col("span").alias("more"))
        pairs = own.join(later, ["tid", "number"], "left").na.fill(0, ["rank1"])
        pairs = pairs.withColumn("span", F.col("span") + F.coalesce("more", F.lit(length)))
        ranks = _ranked(pairs, ["rank0", "rank1"])
        sample = settle(pairs.join(ranks, ["rank0", "rank1"]).select("tid", "number", "rank", "span"), "suffix-names")
        hop *= 2
    return sample.select("tid", "number", "rank")


def _shared(runs: pa.ListArray) -> np.ndarray:
    """How many names each run of a sorted list shares with the next one, from their start."""
    values, offsets = runs.values.to_numpy(), runs.offsets.to_numpy()
    sizes = np.diff(offsets)
    least = np.minimum(sizes[1:], sizes[:-1])
    out = np.zeros(len(least), np.int32)
    open_ = np.flatnonzero(least > 0)
    while len(open_):
        at = out[open_]
        open_ = open_[values[offsets[open_] + at] == values[offsets[open_ + 1] + at]]
        out[open_] += 1
        open_ = open_[out[open_] < least[open_]]
    return out


def _compare(batches):
    """What neighbours in a sorted list share. A task's first and last row come out as edges too, numbered 0 and 1."""
    first = last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if last is None else pa.concat_batches([last, batch])
        first = first or batch.slice(0, 1)
        last = pa.concat_batches([batch.slice(batch.num_rows - 1, 1)])
        blocks = _shared(rows.column("ahead"))
        # A row counts with the one before and with the one behind.
        near = np.zeros(rows.num_rows, np.int32)
        near[:-1] = blocks
        near[1:] = np.maximum(near[1:], blocks)
        yield _reach_batch(rows, near, False)
    if last is not None:
        yield _reach_batch(first, np.array([0], np.int32), True)
        yield _reach_batch(last, np.array([1], np.int32), True)


def _reach_batch(rows: pa.RecordBatch, blocks: np.ndarray, edge: bool) -> pa.RecordBatch:
    kind = pa.list_(pa.int64())
    ahead = rows.column("ahead").cast(kind) if edge else pa.nulls(rows.num_rows, kind)
    return pa.RecordBatch.from_arrays([rows.column("tid"), rows.column("number"), pa.array(blocks), ahead], ["tid", "number", "blocks", "edge"])


def _list_reach(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks that each suffix of a list shares with a neighbour: ``tid, number, blocks``."""
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    found = ordered.select("tid", "number", "ahead").mapInArrow(_compare, "tid long, number int, blocks int, edge array<long>")
    found = settle(found.withColumn("part", F.spark_partition_id()), "suffix-reach")
    # Two rows per task: neighbours across the borders of tasks.
    edges = found.where("edge IS NOT NULL").orderBy("part", "blocks").collect()
    more = []
    for a, b in zip(edges[1::2], edges[2::2], strict=False):
        blocks = int(_shared(pa.array([a.edge, b.edge], pa.list_(pa.int64())))[0])
        more += [(a.tid, a.number, blocks), (b.tid, b.number, blocks)]
    inner = found.where("edge IS NULL").select("tid", "number", "blocks")
    return inner.union(rows.sparkSession.createDataFrame(more, inner.schema))


def reaches(symbols: DataFrame, length: int) -> DataFrame:
    """For each suffix the blocks it shares with another one at most, up to ``length`` bytes."""
    by = Window.partitionBy("tid").orderBy("number")
    wide = symbols.withColumns({f"{c}{i}": _next(c, i, by) for c in ("name", "step") for i in (1, 2)})
    # Names of the blocks that the next ``length`` bytes touch, up to the string's end.
    near = Window.partitionBy("tid").orderBy("start").rangeBetween(0, length)
    wide = wide.withColumn("start", F.sum("step").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    wide = wide.na.fill(0, ["start"]).withColumn("near", F.collect_list(F.struct("number", "name")).over(near))
    run = F.filter("near", lambda x, i: x["number"] == F.col("number") + i)
    # A gap ends the run: what lies behind it has a number too large for its place.
    wide = wide.withColumn("ahead", F.transform(run, lambda x: x["name"])).drop("near")
    wide = settle(wide, "suffix-symbols")
    names = _names(wide, length)
    ranked = lambda i: names.select("tid", (F.col("number") - i).alias("number"), F.col("rank").alias(f"rank{i}"))
    join = lambda rows, i: rows.join(ranked(i), ["tid", "number"], "left").na.fill(0, [f"rank{i}"])
    third = F.col("number") % 3
    lists = [
        (join(wide.where(third != 0), 0), ["rank0"]),
        (join(wide.where(third != 2), 1), ["name", "rank1"]),
        (join(wide.where(third != 1), 2), ["name", "name1", "rank2"]),
    ]
    found = [_list_reach(rows, keys) for rows, keys in lists]
    return found[0].union(found[1]).union(found[2]).groupBy("tid", "number").agg(F.max("blocks").alias("blocks"))


def _spots() -> list:
    return [F.pmod(F.xxhash64("tid", F.lit(s)), F.lit(1 << _BLOOM_BITS)).alias(f"spot_{s}") for s in (1, 2)]


def _bloom(ids: DataFrame) -> np.ndarray:
    """Fixed-size bit table of text numbers; it only spares work."""
    cells = ids.select(F.explode(F.array(*_spots())).alias("at")).groupBy(F.expr("at div 32").alias("word"))
    bits = np.zeros((1 << _BLOOM_BITS) // 32, np.uint32)
    for row in cells.agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 AS int))")).alias("bits")).collect():
        bits[row.word] = row.bits
    return bits


def _sift(bits: np.ndarray):
    def run(batches):
        for batch in batches:
            hit = np.ones(batch.num_rows, bool)
            for i in (0, 1):
                at = batch.column(i).to_numpy()
                hit &= (bits[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1
            yield batch.select(["tid", "text"]).filter(pa.array(hit))

    return run


def _gather(batches):
    """Texts with their reaches in blocks of a few MB, and their bytes."""
    from pyspark import TaskContext

    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for row in batch.to_pylist():
            text = row["text"].encode()
            reach = np.zeros(1 + max(r["number"] for r in row["reach"]), np.int32)
            for r in row["reach"]:
                reach[r["number"]] = r["blocks"] + 1
            held.append((row["tid"], text, reach.tobytes()))
            size += len(text)
            if size >= BLOCK_BYTES:
                yield _block(number, held)
                number, held, size = number + 1, [], 0
    if held:
        yield _block(number, held)


def _block(number: int, held: list) -> pa.RecordBatch:
    tids, texts, reach = zip(*held, strict=True)
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.int64())
    values = (number, list(tids), list(texts), list(reach), sum(map(len, texts)))
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["block", "tids", "texts", "reach", "size"])


def _strings(texts, reach, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, hash) of the strings of ``length`` bytes whose anchors all lie within their first one's reach."""
    gram, width = _sizes(length)
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    column = pa.array(texts, pa.binary()).cast(pa.string())
    for chunk in tx.chunks(column):
        own = Anchors(chunk, length)
        blocks = np.zeros(len(own.at), np.int64)
        for doc in range(len(chunk.offsets) - 1):
            low, high = own.bounds[doc], own.bounds[doc + 1]
            known = np.frombuffer(reach[chunk.first + doc], np.int32)[: high - low]
            blocks[low : low + len(known)] = known
        # Reach in blocks plus one: 0 an anchor found once, 1 its gram alone, n + 1 that many blocks.
        places = np.arange(len(own.at))
        last = np.minimum(places + np.maximum(blocks - 1, 0), own.bounds[own.doc + 1] - 1) if len(own.at) else places
        starts = np.concatenate([np.arange(a, max(a, b - length + 1)) for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:], strict=True)])
        if not len(starts) or not len(own.at):
            continue
        # Anchors by grams outside the string are not those of its other occurrences: they may stand before the
        # least of the string's first grams and behind the least of its last ones, never between.
        first = _step_to(own, np.searchsorted(own.at, starts), own.least[starts], 1)
        tail = starts + length - gram - width + 1
        final = _step_to(own, np.searchsorted(own.at, tail + width - 1, "right") - 1, own.least[tail], -1)
        keep = (blocks[first] > 0) & (last[first] >= final)
        starts = starts[keep]
        hashes = tx.mix((own.sums[starts + length] - own.sums[starts]) * own.down[starts])
        doc = np.searchsorted(chunk.offsets, starts, "right") - 1
        parts.append((doc + chunk.first, starts - chunk.offsets[doc], hashes))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _step_to(own: Anchors, at: np.ndarray, wanted: np.ndarray, step: int) -> np.ndarray:
    """The nearest anchor from ``at`` on whose gram is the wanted one."""
    open_ = np.flatnonzero(own.gram[at] != wanted)
    while len(open_):
        at[open_] += step
        open_ = open_[own.gram[at[open_]] != wanted[open_]]
    return at


def _buckets(hashes: np.ndarray, count: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def _send(length: int, count: int):
    """A block's distinct hashes by bucket, and which of them it has twice."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, _, hashes = _strings(row["texts"], row["reach"], length)
                distinct, times = np.unique(hashes, return_counts=True)
                cuts = np.searchsorted(_buckets(distinct, count), np.arange(count + 1))
                out = [
                    (b, row["block"], _six(distinct[x:y]), np.packbits(times[x:y] > 1).tobytes())
                    for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                    if y > x
                ]
                columns = zip(*out, strict=True) if out else [[]] * 4
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "block", "hashes", "twice"])

    return run


def _six(values: np.ndarray) -> bytes:
    """Sorted values within a bucket, by their low 48 bits."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _wide(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view("<u8")[:, 0]


def _meet(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Of each block's hashes in a bucket, those found elsewhere too, as bits in the block's order."""
    blobs, twice = rows.column("hashes").to_pylist(), rows.column("twice").to_pylist()
    values = [_wide(b) for b in blobs]
    ordered = np.sort(np.concatenate(values))
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    bits = []
    for own, flags in zip(values, twice, strict=True):
        found = np.unpackbits(np.frombuffer(flags, np.uint8))[: len(own)].astype(bool)
        if len(shared):
            at = np.minimum(np.searchsorted(shared, own), len(shared) - 1)
            found |= shared[at] == own
        bits.append(np.packbits(found).tobytes())
    return pa.table({"block": rows.column("block"), "bucket": rows.column("bucket"), "bits": pa.array(bits, pa.binary())})


_CUT = "tid long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(length: int, count: int, with_text: bool):
    """Texts of a block without the bytes under repeated strings."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                texts, starts, hashes = _strings(row["texts"], row["reach"], length)
                distinct, at = np.unique(hashes, return_inverse=True)
                buckets = _buckets(distinct, count)
                found = np.zeros(len(distinct), bool)
                for part in row["found"] or ():
                    low, high = np.searchsorted(buckets, [part["bucket"], part["bucket"] + 1])
                    found[low:high] = np.unpackbits(np.frombuffer(part["bits"], np.uint8))[: high - low]
                hit = found[at]
                out = []
                for text in np.unique(texts[hit]):
                    data = np.frombuffer(row["texts"][text], np.uint8)
                    edges = np.zeros(len(data) + 1, np.int64)
                    own = starts[hit & (texts == text)]
                    np.add.at(edges, own, 1)
                    np.add.at(edges, own + length, -1)
                    gone = np.cumsum(edges[:-1]) > 0
                    kept = data[~gone].tobytes()
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    out.append((row["tids"][text], int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
                columns = zip(*out, strict=True) if out else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in _CUT.split(", ")])

    return run


def drop_repeats(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """Per document: ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, where bytes went, ``kept`` (not without ``with_text``)."""
    workers()
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.col(doc).alias("doc_id"), body.alias("text")).withColumn("tid", F.xxhash64("text"))
    long = texts.where(F.octet_length("text") >= length)
    blocks = settle(long.select("tid", "text").mapInArrow(_blocks(length), _BLOCKS), "suffix-blocks")
    grams = settle(_repeated(blocks, "gram").distinct(), "suffix-grams")
    symbols = settle(_repeated(grams.drop("gram"), "name"), "suffix-repeats")
    far = reaches(symbols, length)
    reach = grams.select("tid", "number").join(far, ["tid", "number"], "left").na.fill(0, ["blocks"])
    reach = settle(reach.groupBy("tid").agg(F.collect_list(F.struct("number", "blocks")).alias("reach")), "suffix-reaches")
    sifted = long.select(*_spots(), "tid", "text").mapInArrow(_sift(_bloom(reach)), "tid long, text string")
    held = sifted.dropDuplicates(["tid"]).join(reach, "tid")
    held = held.mapInArrow(_gather, "block long, tids array<long>, texts array<binary>, reach array<binary>, size long")
    held = settle(held, "suffix-held")
    count = 1 + (held.agg(F.sum("size")).first()[0] or 0) // BYTES_PER_BUCKET
    sent = held.mapInArrow(_send(length, count), "bucket long, block long, hashes binary, twice binary")
    met = sent.groupBy("bucket").applyInArrow(_meet, "block long, bucket long, bits binary")
    met = met.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("found"))
    cut = settle(held.drop("size").join(met, "block", "left").mapInArrow(_cut(length, count, with_text), _CUT), "suffix-cut")
    rows = texts.select("doc_id", "tid", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    copies = rows.groupBy("tid").agg(F.count("*").alias("copies")).where("copies > 1")
    out = rows.join(cut, "tid", "left").join(copies, "tid", "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return out.select(
        F.col("doc_id").alias(doc),
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(gone, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"),
    )
