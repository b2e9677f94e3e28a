"""N-gram Jaccard join by token-combination prefixes.

A document's set is its distinct word shingles (lower-cased A-Z). All sets use
one global order of shingles, rare ones first. A prefix of a set is indexed:
each rare shingle by itself, frequent ones by pairs of the same class, so the
prefix goes on until no ``n - t`` differences can break all that it indexes
(``t``: least overlap for the threshold). Two sets that link then share an
entry: of the two prefixes, take the one that ends first in the global order;
at most ``n - t`` of its shingles are missing in the other set, and what is
left still holds a rare shingle or a pair, which the other prefix holds too.

Frequent shingles fall into ``2**level`` classes, where the level grows with
the set's size, so that pairs stay in proportion to the prefix; sets near a
change of level are indexed at both. Whether a shingle is frequent comes from
a count sketch of fixed size over all documents; any answer of the sketch
keeps the result exact.

Equal sets are one set from the start. The sets of an entry are first compared
with one of them only, another in each round, and links joined to components,
until few pairs of an entry are in different components; those come last. Every
pair first meets a bound: parity bits of two sets, as many as shingles, differ in
no more places than the sets do. What is left is verified on the whole sets, so no link
between different components is lost, and a group of copies never gives all its
pairs. Shingles are 64-bit
hashes, compared by 48 bits; a set's number is 64 bits wide.

Null, empty and wordless texts have empty sets and are linked with nothing. A
text of fewer words than a shingle is one shingle. Repeated rows of a document
are one document if they are equal; an id with different texts counts each of
them. Empty tables give no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namepulse.llm import text as tx
from namepulse.llm.tables import components, settle, workers

SKETCH_BITS = 20
_SLABS = 16
_SLAB = (1 << SKETCH_BITS) // _SLABS
#: Rare shingles to a class of frequent ones in the prefix.
_PER_CLASS = 8
_BLOOM_BITS = 23
#: Rounds of comparing an entry's sets with one of them, at most; none further at so few open pairs to a row.
ROUNDS, PAIRS_PER_ROW = 6, 4
#: Entries of a set before a row's own that the row knows.
EARLIER = 8


def shingle_sets(chunk: tx.Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, sorted within it, and the bounds of each text's set."""
    words = tx.words(chunk, tx.LOWER[chunk.data])
    hashes, doc = tx.windows(words, size)
    counts = np.diff(words.bounds)
    parts, owners = [hashes], [doc]
    for n in range(1, size):
        own = np.flatnonzero(counts == n)
        at = words.bounds[own]
        whole = np.zeros(len(own), np.uint64)
        for i in range(n):
            whole = whole * tx._BASE + words.hashes[at + i]
        parts.append(tx.mix(whole + np.uint64(n)))
        owners.append(own)
    hashes, doc = np.concatenate(parts), np.concatenate(owners)
    if len(words.bounds) < 1 << 15:
        # The text's number on top of 49 bits of hash: one sort for all texts, then the hash bits back.
        shift = np.uint64(49)
        packed = np.unique((doc.astype(np.uint64) << shift) | (hashes >> np.uint64(15)))
        return packed & ((np.uint64(1) << shift) - np.uint64(1)), np.searchsorted(packed >> shift, np.arange(len(words.bounds)))
    order = np.lexsort((hashes >> np.uint64(15), doc))
    hashes, doc = hashes[order] >> np.uint64(15), doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.searchsorted(doc[new], np.arange(len(words.bounds)))


def _set_numbers(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of every set."""
    out = []
    for salt in (0x51ED270B, 0x7A3F8E19D5):
        sums = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(tx.mix(tokens ^ np.uint64(salt)), out=sums[1:])
        out.append(tx.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))
    return out[0], out[1]


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tx.mix(tokens) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


_SETS = "doc_id long, n long, f1 long, f2 long, bits array<long>, slab int, counts binary"
_PARITY = 1024


def _parities(tokens: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """For each set, bits that say whether an odd number of its shingles fall on a place.

    A set has as many places as shingles or more, a power of two: unlike sets
    then differ in half of them, however long they are.
    """
    sizes = np.diff(bounds)
    places = np.maximum(_PARITY, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(places)])
    at = (tx.mix(tokens ^ np.uint64(0x2545F491)) & np.repeat(places - 1, sizes).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(np.repeat(first[:-1], sizes) + at, minlength=int(first[-1])) & 1
    longs = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(first // 64, pa.int32()), pa.array(longs))


def _measure(size: int):
    """Set sizes and numbers of all documents; at the end, the task's part of the sketch."""

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            ids = batch.column(0)
            for chunk in tx.chunks(batch.column(1)):
                tokens, bounds = shingle_sets(chunk, size)
                counts += np.bincount(_slots(tokens), minlength=len(counts))
                f1, f2 = _set_numbers(tokens, bounds)
                n = len(f1)
                rows = [ids.slice(chunk.first, n), *map(tx.column, (np.diff(bounds), f1, f2)), _parities(tokens, bounds), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
                yield _batch(rows, _SETS)
        blobs = [zlib.compress(counts[i * _SLAB : (i + 1) * _SLAB].astype(np.int64).tobytes(), 1) for i in range(_SLABS)]
        empty = [pa.nulls(_SLABS, pa.int64())] * 4
        yield _batch([*empty, pa.nulls(_SLABS, pa.list_(pa.int64())), pa.array(range(_SLABS), pa.int32()), pa.array(blobs, pa.binary())], _SETS)

    return run


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in schema.split(", ")])


def _add_slabs(key: tuple[pa.Scalar, ...], slabs: pa.Table) -> pa.Table:
    total = np.zeros(_SLAB, np.int64)
    for blob in slabs.column("counts"):
        total += np.frombuffer(zlib.decompress(blob.as_py()), np.int64)
    return pa.table({"slab": pa.array([key[0].as_py()], pa.int32()), "total": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def _frequent_slots(measured: DataFrame, factor: int) -> np.ndarray:
    """Packed flags of the sketch's crowded slots: 128 kB, whatever the input."""
    slabs = measured.where("slab IS NOT NULL").select("slab", "counts")
    rows = slabs.groupBy("slab").applyInArrow(_add_slabs, "slab int, total binary").collect()
    totals = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in rows:
        totals[row.slab * _SLAB : (row.slab + 1) * _SLAB] = np.frombuffer(zlib.decompress(bytes(row.total)), np.int64)
    return np.packbits(totals > factor * (totals.mean() + 4))


def least_overlap(n, percent: int):
    """The least overlap of a set of ``n`` with any set it links to: ``percent * n / 100`` rounded up."""
    return -(-percent * n // 100)


def _level(n: int, percent: int) -> int:
    return max(0, int(math.log2(max(1.0, n * (100 - percent) / 100 / _PER_CLASS))))


def entries(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """What a set is indexed by: hashes of rare shingles, and of pairs of frequent ones for each of its levels."""
    n = len(tokens)
    slack = n - int(least_overlap(n, percent))
    often = frequent[_slots(tokens)]
    order = np.concatenate([np.flatnonzero(~often), np.flatnonzero(often)])
    rare = n - int(often.sum())
    if rare > slack:
        return tx.mix(tokens[order[: slack + 1]])
    out = [tx.mix(tokens[order[:rare]])]
    for level in range(_level(int(least_overlap(n, percent)), percent), _level(n, percent) + 1):
        salt = np.uint64(level + 1)
        kinds: dict[int, list] = {}
        covered = rare
        for token in tokens[order[rare:]]:
            own = kinds.setdefault(int(token) & ((1 << level) - 1), [])
            covered += bool(own)
            own.append(token)
            if covered > slack:
                break
        for own in kinds.values():
            if len(own) > 1:
                a, b = np.triu_indices(len(own), 1)
                own = np.array(own, np.uint64)
                out.append(tx.mix(tx.mix(own[a]) * tx._BASE + own[b] + salt))
    return np.concatenate(out)


def _index(size: int, percent: int, packed: np.ndarray):
    least = max(2, math.ceil(percent / (100 - percent)))  # smaller sets link to equal ones only

    def run(batches):
        frequent = np.unpackbits(packed).astype(bool)
        for batch in batches:
            for chunk in tx.chunks(batch.column(0)):
                tokens, bounds = shingle_sets(chunk, size)
                numbers, _ = _set_numbers(tokens, bounds)
                found, owner, sizes = [np.zeros(0, np.uint64)], [], []
                # Copies within a chunk are one set.
                distinct = np.sort(np.unique(numbers, return_index=True)[1])
                for i in distinct[np.diff(bounds)[distinct] >= least]:
                    found.append(entries(tokens[bounds[i] : bounds[i + 1]], frequent, percent))
                    owner.append(i)
                    sizes.append(len(found[-1]))
                who = np.repeat(np.array(owner, np.int64), sizes)
                yield _batch([tx.column(np.concatenate(found)), tx.column(numbers[who]), tx.column(np.diff(bounds)[who])], "entry, f, n")

    return run


def _spots() -> list:
    return [F.pmod(F.xxhash64("doc_id", F.lit(s)), F.lit(1 << _BLOOM_BITS)).alias(f"spot_{s}") for s in (1, 2)]


def _bloom(docs: DataFrame) -> np.ndarray:
    """Fixed-size bit table of document ids; it only spares work: a set too many joins no pair."""
    cells = docs.select(F.explode(F.array(*_spots())).alias("at")).groupBy(F.expr("at div 32").alias("word"))
    rows = cells.agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 AS int))")).alias("bits")).collect()
    bits = np.zeros((1 << _BLOOM_BITS) // 32, np.uint32)
    for row in rows:
        bits[row.word] = row.bits
    return bits


def _sets_of(size: int, bits: np.ndarray):
    def marked(spots: pa.Array) -> np.ndarray:
        at = spots.to_numpy()
        return (bits[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1

    def run(batches):
        for batch in batches:
            hit = marked(batch.column(0)) & marked(batch.column(1))
            for chunk in tx.chunks(batch.column(2).filter(pa.array(hit))):
                tokens, bounds = shingle_sets(chunk, size)
                numbers, _ = _set_numbers(tokens, bounds)
                low = tokens.view(np.uint8).reshape(-1, 8)[:, :6]  # little-endian: 48 of the 49 bits
                blobs = [low[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield _batch([tx.column(numbers), pa.array(blobs, pa.binary())], "f, tokens")

    return run


def _tokens(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64)[:, 0]


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            links = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = a.as_py(), b.as_py()
                both = np.sort(np.concatenate([np.unique(_tokens(x)), np.unique(_tokens(y))]))
                shared = int((both[1:] == both[:-1]).sum())
                links.append(100 * shared >= percent * (len(x) // 6 + len(y) // 6 - shared))
            yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    return run


def _close(percent: int):
    """What linked sets ``(n, bits)`` and ``(n2, bits2)`` must satisfy: close sizes, and parities that differ in few places."""
    sizes = 100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")
    # Close sizes have as many places, or one twice as many: that one is folded.
    fold = lambda c: F.expr(f"zip_with(slice({c}, 1, size({c}) div 2), slice({c}, 1 + size({c}) div 2, size({c}) div 2), (x, y) -> x ^ y)")
    short = F.least(F.size("bits"), F.size("bits2"))
    one, two = (F.when(F.size(c) > short, fold(c)).otherwise(F.col(c)) for c in ("bits", "bits2"))
    differ = F.aggregate(F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    bound = differ * (100 + percent) <= (100 - percent) * (F.col("n") + F.col("n2"))
    # Below one half, sizes may be further apart than one fold: then nothing is said.
    return sizes & F.coalesce(bound, F.lit(True))


def _verified(pairs: DataFrame, texts: DataFrame, members: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link; whole sets are made for these only."""
    pairs = settle(pairs, "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("f1")).union(pairs.select(F.col("b").alias("f1"))).distinct()
    firsts = members.join(wanted, "f1").groupBy("f1").agg(F.min("doc_id").alias("doc_id"))
    made = texts.select(*_spots(), "text").mapInArrow(_sets_of(size, _bloom(firsts)), "f long, tokens binary")
    sets = settle(made, "jaccard-tokens")
    both = pairs.join(sets.select(F.col("f").alias("a"), F.col("tokens").alias("set_a")), "a")
    both = both.join(sets.select(F.col("f").alias("b"), F.col("tokens").alias("set_b")), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(_verify(percent), "a long, b long")


def _star_pairs(own: DataFrame, parities: DataFrame, round_no: int, percent: int) -> DataFrame:
    """Each entry's sets with one of them, where components differ."""
    one = F.min_by(F.struct("f", "n", "component"), F.xxhash64("f", F.lit(round_no))).alias("one")
    ends = own.groupBy("entry").agg(one, F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    met = own.join(ends.select("entry", "one"), "entry").where("component != one.component")
    met = met.where(100 * F.least("n", "one.n") >= percent * F.greatest("n", "one.n"))
    pairs = met.select(F.least("f", "one.f").alias("a"), F.greatest("f", "one.f").alias("b")).distinct()
    named = lambda c, i: parities.select(F.col("f").alias(c), F.col("n").alias(f"n{i}"), F.col("bits").alias(f"bits{i}"))
    return pairs.join(named("a", ""), "a").join(named("b", "2"), "b").where(_close(percent)).select("a", "b")


def _rest_pairs(own: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """All pairs of an entry whose components differ.

    Each row knows the few entries of its set just before its own. A pair that has
    one of them in common comes out there, and at the least entry in common always.
    """
    split = own.groupBy("entry").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    rest = own.join(split.select("entry"), "entry", "left_semi").join(parities.select("f", "bits"), "f")
    before = Window.partitionBy("f").orderBy("entry").rowsBetween(-EARLIER, -1)
    rest = rest.withColumn("earlier", F.collect_list("entry").over(before))
    other = rest.select("entry", *(F.col(c).alias(f"{c}2") for c in ("f", "n", "component", "bits", "earlier")))
    differ = (rest["entry"] == other["entry"]) & (F.col("f") < F.col("f2")) & (F.col("component") != F.col("component2"))
    differ &= ~F.arrays_overlap("earlier", "earlier2")
    return rest.join(other, differ & _close(percent)).select(F.col("f").alias("a"), F.col("f2").alias("b")).distinct()


def shared_entries(index: DataFrame) -> DataFrame:
    """Distinct rows ``(entry, f, n)`` of the entries held by two sets or more.

    The index goes through one shuffle by entry; the distinct rows and the
    entry's least and greatest set are found in place, not by joining it again.
    """
    by_entry = Window.partitionBy("entry")
    rows = index.repartition("entry").distinct()
    rows = rows.withColumn("x", F.min("f").over(by_entry)).withColumn("y", F.max("f").over(by_entry))
    return rows.where("x < y").select("entry", "f", "n")


def _open_pairs(own: DataFrame) -> tuple[int, int]:
    """How many pairs of an entry are in different components, and how many rows there are."""
    sizes = own.groupBy("entry", "component").agg(F.count("*").cast("double").alias("n"))
    sums = sizes.groupBy("entry").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"))
    row = sums.agg(F.sum((F.col("n") * F.col("n") - F.col("same")) / 2), F.sum("n")).first()
    return int(row[0] or 0), int(row[1] or 0)


def link_groups(
    docs: DataFrame, *, doc: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85, factor: int = 4
) -> DataFrame:
    """Per document: ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Sets link when ``100 * overlap >= percent * union``. ``factor`` times the
    sketch's mean load makes a shingle frequent.
    """
    workers()
    texts = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    measured = settle(texts.mapInArrow(_measure(size), _SETS), "jaccard-sets")
    packed = _frequent_slots(measured, factor)
    members = measured.where("slab IS NULL").select("doc_id", "n", "f1", "f2", "bits")
    index = texts.select("text").mapInArrow(_index(size, percent, packed), "entry long, f long, n long")
    shared = settle(shared_entries(settle(index, "jaccard-index")), "jaccard-shared")
    parities = members.groupBy("f1").agg(F.first("n").alias("n"), F.first("bits").alias("bits")).withColumnRenamed("f1", "f")
    parities = settle(parities.join(shared.select("f").distinct(), "f"), "jaccard-parities")
    own, links, open_pairs = shared.withColumn("component", F.col("f")), None, None
    for round_no in range(ROUNDS):
        pairs = _star_pairs(own, parities, round_no, percent)
        found = settle(_verified(pairs, texts, members, size, percent), "jaccard-stars")
        links = found if links is None else links.union(found)
        # Stars are shallow: two steps join nearly all, and what they leave apart is only compared again.
        groups = components(links, "jaccard", steps=2).withColumnRenamed("id", "f")
        own = shared.join(groups, "f", "left").select("entry", "f", "n", F.coalesce("component", "f").alias("component"))
        own = settle(own, "jaccard-grouped")
        before, (open_pairs, rows) = open_pairs, _open_pairs(own)
        # Go on while it pays: many pairs are open, and the last round closed a good part of them.
        if open_pairs <= PAIRS_PER_ROW * rows or (before and open_pairs > 0.9 * before):
            break
    rest = _verified(_rest_pairs(own, parities, percent), texts, members, size, percent)
    links = links.union(settle(rest, "jaccard-rest"))
    groups = components(links, "jaccard-all").select(F.col("id").alias("f1"), "component")
    named = members.drop("bits").join(groups, "f1", "left")
    named = named.withColumn("group", F.when(F.col("n") > 0, F.coalesce("component", "f1")))
    least = named.where("n > 0").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "group", "left")
    return out.select(F.col("doc_id").alias(doc), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
