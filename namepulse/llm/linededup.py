"""Line dedup that can be undone: cuckoo filters in shards over exact reference counts.

The index is a folder of tables. ``counts`` has every line key and the number
of documents that hold it. ``filters`` has, for each shard of the keys, a
cuckoo filter of the keys that reach the threshold. ``exceptions`` lists the
counted keys that a filter takes for frequent and that are not, so that filter
and exceptions together answer exactly for all documents in the index.

``insert`` and ``delete`` make the next version of the index from a batch of
documents: counts go up or down, keys that cross the threshold enter or leave
their shard's filter. Deleting what was inserted gives back the former answers.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z in
lower case; keys are 128-bit hashes. Empty keys are never counted. Null and
empty texts are one empty line. A document's repeated lines count once; repeated
rows of a document count as documents of their own. Empty tables give an empty
index and no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namepulse.llm.cuckoo import CuckooFilter
from namepulse.llm.tables import workers
from namepulse.session import new_folder

KEYS_PER_SHARD = 1 << 18
#: Filters and exceptions up to this size go to every task; larger ones are joined.
SHIPPED_BYTES = 64 << 20
_COUNT_SCHEMA = "k1 long, k2 long, docs long"
_FILTER_SCHEMA = "shard int, keys long, blob binary"


class Index(NamedTuple):
    """A version of the index: its tables, the threshold and the number of shards."""

    counts: DataFrame
    filters: DataFrame
    exceptions: DataFrame
    least: int
    shards: int


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def _hash(key: bytes) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(key)
    return (value >> 64) - (1 << 63), (value & ((1 << 64) - 1)) - (1 << 63)


def _count(batches):
    """Each batch's keys with the number of its documents that hold them."""
    for batch in batches:
        found = Counter()
        for text in batch.column(0):
            found.update(set(map(line_key, (text.as_py() or "").encode().split(b"\n"))))
        found.pop(b"", None)
        hashes = [_hash(k) for k in found] or [(0, 0)][:0]
        k1, k2 = zip(*hashes, strict=True) if hashes else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k1, k2, list(found.values()))], ["k1", "k2", "docs"])


def count_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    workers()
    return docs.select(F.col(text).cast("string")).mapInArrow(_count, _COUNT_SCHEMA)


def shard(shards: int) -> Column:
    return F.pmod(F.col("k1"), F.lit(shards)).cast("int")


def _write(df: DataFrame, label: str) -> DataFrame:
    path = new_folder(df.sparkSession, f"lines-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build(docs: DataFrame, *, text: str = "text", least: int = 10) -> Index:
    """The index of a first batch of documents."""
    counts = _write(count_lines(docs, text).groupBy("k1", "k2").agg(F.sum("docs").alias("docs")), "counts")
    frequent = counts.where(F.col("docs") >= least)
    shards = 1 + frequent.count() // KEYS_PER_SHARD
    filters = frequent.groupBy(shard(shards).alias("shard")).applyInArrow(_new_filter(shards), _FILTER_SCHEMA)
    return _with_exceptions(counts, _write(filters, "filters"), least, shards)


def insert(index: Index, docs: DataFrame, text: str = "text") -> Index:
    return _update(index, count_lines(docs, text))


def delete(index: Index, docs: DataFrame, text: str = "text") -> Index:
    """Take documents out again. Only documents that are in the index may be taken out."""
    return _update(index, count_lines(docs, text).withColumn("docs", -F.col("docs")))


def _update(index: Index, changes: DataFrame) -> Index:
    changes = changes.groupBy("k1", "k2").agg(F.sum("docs").alias("change"))
    both = index.counts.join(changes, ["k1", "k2"], "full").na.fill(0, ["docs", "change"])
    both = _write(both.select("k1", "k2", (F.col("docs") + F.col("change")).alias("docs"), F.col("docs").alias("before")), "counts")
    crossed = both.withColumn(
        "step", (F.col("docs") >= index.least).cast("int") - (F.col("before") >= index.least).cast("int")
    ).where("step != 0")
    crossed = crossed.select(shard(index.shards).alias("shard"), "k1", "step")
    filters = (
        crossed.groupBy("shard").cogroup(index.filters.groupBy("shard")).applyInArrow(_next_filter, _FILTER_SCHEMA)
    )
    counts = both.where("docs > 0").select("k1", "k2", "docs")
    return _with_exceptions(counts, _write(filters, "filters"), index.least, index.shards)


def _new_filter(shards: int):
    def run(key: tuple[pa.Scalar, ...], keys: pa.Table) -> pa.Table:
        made = CuckooFilter.of(keys.column("k1").to_numpy())
        return _filter_row(key[0].as_py(), keys.num_rows, made)

    return run


def _filter_row(number: int, keys: int, made: CuckooFilter) -> pa.Table:
    return pa.table({"shard": pa.array([number], pa.int32()), "keys": pa.array([keys], pa.int64()), "blob": pa.array([made.dump()], pa.binary())})


def _next_filter(key: tuple[pa.Scalar, ...], crossed: pa.Table, old: pa.Table) -> pa.Table:
    """Deletions first, then insertions; a filter that is too full grows by its overflowing keys' shard."""
    number = key[0].as_py()
    k1, step = (crossed.column(c).to_numpy() for c in ("k1", "step"))
    held = old.column("keys")[0].as_py() if old.num_rows else 0
    made = [CuckooFilter.load(b.as_py()) for b in old.column("blob")]
    for one in made:
        gone = k1[step < 0]
        one.delete(gone[one.contains(gone)])
    new = k1[step > 0]
    room = sum(one.table.size for one in made) * 0.9 - held
    if not made or len(new) > room or not made[-1].insert(new):
        # An entry cannot be moved to a larger table without its key: new keys get a table of their own.
        made = [CuckooFilter.load(b.as_py()) for b in old.column("blob")] if made else []
        for one in made:
            gone = k1[step < 0]
            one.delete(gone[one.contains(gone)])
        made.append(CuckooFilter.of(new))
    held += len(new) - int((step < 0).sum())
    rows = [_filter_row(number, held if i == 0 else 0, one) for i, one in enumerate(made)]
    return pa.concat_tables(rows)


class Filters:
    """All shards' filters, as shipped to a task."""

    def __init__(self, blobs: list[tuple[int, bytes]], exceptions: list[tuple[int, int]], shards: int):
        self.shards, self.tables = shards, {}
        for number, blob in blobs:
            self.tables.setdefault(number, []).append(CuckooFilter.load(blob))
        self.exceptions = set(exceptions)

    def contains(self, k1: np.ndarray) -> np.ndarray:
        out = np.zeros(len(k1), bool)
        own = k1 % self.shards
        for number, tables in self.tables.items():
            mine = np.flatnonzero(own == number)
            for one in tables:
                out[mine] |= one.contains(k1[mine])
        return out


def _with_exceptions(counts: DataFrame, filters: DataFrame, least: int, shards: int) -> Index:
    """Send the rare keys through the filters: those that one takes for frequent are the exceptions."""
    spark = counts.sparkSession
    rare = counts.where(F.col("docs") < least).select("k1", "k2")
    shipped = _ship(spark, filters, None, shards)
    if shipped is None:
        empty = spark.createDataFrame([], rare.schema)
        return Index(counts, filters, empty, least, shards)

    def probe(batches):
        for batch in batches:
            yield batch.filter(pa.array(shipped.value.contains(batch.column("k1").to_numpy())))

    return Index(counts, filters, _write(rare.mapInArrow(probe, rare.schema), "exceptions"), least, shards)


def _ship(spark: SparkSession, filters: DataFrame, exceptions: DataFrame | None, shards: int):
    """A broadcast of filters and exceptions if they are small enough, or None."""
    size = filters.agg(F.sum(F.length("blob"))).first()[0] or 0
    if exceptions is not None:
        size += 64 * exceptions.count()
    if size > SHIPPED_BYTES:
        return None
    blobs = [(r.shard, bytes(r.blob)) for r in filters.select("shard", "blob").collect()]
    odd = [tuple(r) for r in exceptions.collect()] if exceptions is not None else []
    return spark.sparkContext.broadcast(Filters(blobs, odd, shards))


def _kept(rest: list[str], decide):
    """Texts without the lines that ``decide`` names, and how many went."""

    def run(batches):
        for batch in batches:
            texts = [(t.as_py() or "").encode().split(b"\n") for t in batch.column("_text")]
            drops = decide(batch, texts)
            out = [b"\n".join([x for x, d in zip(t, f, strict=True) if not d]) for t, f in zip(texts, drops, strict=True)]
            columns = [batch.column(c) for c in rest]
            columns += [pa.array(list(map(len, texts)), pa.int64()), pa.array([int(sum(f)) for f in drops], pa.int64())]
            columns += [pa.array([t.decode() for t in out], pa.string())]
            columns += [pa.array([hashlib.sha256(t).hexdigest() for t in out], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "n_lines", "n_dropped", "kept_text", "kept_sha256"])

    return run


def _by_filter(shipped):
    def decide(_, texts: list[list[bytes]]) -> list:
        known: dict[bytes, bool] = {}
        keys = [[line_key(x) for x in t] for t in texts]
        new = list({k for ks in keys for k in ks} - {b""})
        hashes = [_hash(k) for k in new]
        hit = shipped.value.contains(np.array([h[0] for h in hashes], np.int64))
        known = {k: bool(x) and h not in shipped.value.exceptions for k, h, x in zip(new, hashes, hit, strict=True)}
        known[b""] = False
        return [[known[k] for k in ks] for ks in keys]

    return decide


def _by_list(batch, texts: list[list[bytes]]) -> list:
    drops = []
    for text, numbers in zip(texts, batch.column("_drops").to_pylist(), strict=True):
        gone = set(numbers or ())
        drops.append([i in gone for i in range(len(text))])
    return drops


def _positions(batches):
    for batch in batches:
        rows = []
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for at, line in enumerate((text.as_py() or "").encode().split(b"\n")):
                if key := line_key(line):
                    rows.append((row, at, *_hash(key)))
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["_row", "at", "k1", "k2"])


def drop_frequent(index: Index, docs: DataFrame, keep: list[str], *, text: str = "text", ship: bool | None = None) -> DataFrame:
    """Documents of the index without their frequent lines.

    The columns ``keep``, then ``n_lines``, ``n_dropped``, ``kept_text`` and
    ``kept_sha256``. Filters small enough go to the tasks, which then need no
    shuffle; larger ones give way to a join of the lines with the counts.
    ``ship`` forces one way, for tests.
    """
    workers()
    rows = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    shipped = None if ship is False else _ship(docs.sparkSession, index.filters, index.exceptions, index.shards)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = ", ".join(filter(None, [schema, "n_lines long, n_dropped long, kept_text string, kept_sha256 string"]))
    if shipped is not None:
        return rows.mapInArrow(_kept(keep, _by_filter(shipped)), schema)
    # A row's own hash names it: equal rows have equal lines.
    rows = rows.withColumn("_row", F.sha2(F.to_json(F.struct(F.struct("*"))), 256))
    frequent = index.counts.where(F.col("docs") >= index.least).select("k1", "k2")
    found = rows.select("_row", "_text").mapInArrow(_positions, "_row string, at int, k1 long, k2 long")
    drops = found.join(frequent, ["k1", "k2"], "left_semi").groupBy("_row").agg(F.collect_set("at").alias("_drops"))
    return rows.join(drops, "_row", "left").select(*keep, "_drops", "_text").mapInArrow(_kept(keep, _by_list), schema)
