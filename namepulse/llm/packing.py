"""Packing token sequences: bounded-space online best fit, leftovers merged at the end.

Each partition keeps ``open_windows`` windows. What is left of a document after
its full windows goes to the open window that it fits best. When it fits none
and no more may be opened, the fullest is filled up with the document's next
ids and emitted, and the rest of the document is placed again. At the end of a
partition its open windows are joined, and the one short window that remains
goes to the merge: groups of ``merge_ways`` short windows are joined in rounds
until one group is left. Only the last window of all is padded.

Null and empty texts have only the end id. Repeated rows and ids are packed as
often as they occur; a null id stays null. An empty table gives no rows. Very
long texts are tokenised word by word and cut at window borders.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namepulse.llm import text as tx
from namepulse.llm.tables import settle, workers

WINDOW = 4096
ID = np.dtype("<u4")
#: Bytes of words, ids and overhead that a worker keeps, and the longest word kept.
CACHED_BYTES, CACHED_WORD, ENTRY_BYTES = 256 << 20, 256, 250
PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
_encoders: dict[str, "WordIds"] = {}


class WordIds:
    """Packed ids of words; a cache of bounded size before the tokenizer.

    The tokenizer drops white space and never joins what white space parts, so
    a text's ids are its words' ids in order. A full cache becomes the old one,
    from which words in use move back, so frequent words stay.
    """

    def __init__(self, path: str, most: int = CACHED_BYTES):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most, self.size = most, 0
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def __call__(self, words: list[bytes]) -> list[bytes]:
        out = [self.known.get(w) for w in words]
        missing = [i for i, ids in enumerate(out) if ids is None]
        new = []
        for i in missing:
            out[i] = self.old.get(words[i])
            if out[i] is None:
                new.append(i)
        for at in range(0, len(new), 10_000):
            some = new[at : at + 10_000]
            coded = self.tokenizer.encode_batch_fast([words[i].decode() for i in some], add_special_tokens=False)
            for i, c in zip(some, coded, strict=True):
                out[i] = np.array(c.ids, ID).tobytes()
        for i in missing:
            if len(words[i]) <= CACHED_WORD:
                self.known[words[i]] = out[i]
                self.size += len(words[i]) + len(out[i]) + ENTRY_BYTES
        if self.size > self.most // 2:
            self.old, self.known, self.size = self.known, {}, 0
        return out

    def texts(self, chunk: tx.Chunk, end: bytes) -> Iterator[bytes]:
        """Each text's packed ids and the end: distinct words are looked up once a chunk."""
        words = tx.words(chunk)
        raw = chunk.data.tobytes()
        _, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        coded = self([raw[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)])
        ids = np.frombuffer(b"".join(coded), ID)
        counts = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        starts = np.cumsum(counts) - counts
        counts, starts = counts[which], starts[which]
        after = np.concatenate([[0], np.cumsum(counts)])
        placed = ids[np.repeat(starts - after[:-1], counts) + np.arange(after[-1])]
        bounds = after[words.bounds].tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield placed[a:b].tobytes() + end


class Window:
    """An open sequence: pieces of documents and how many ids they have."""

    def __init__(self):
        self.pieces: list[tuple] = []
        self.size = 0

    def put(self, doc: tuple, start: int, length: int) -> None:
        self.pieces.append((doc, start, length))
        self.size += length


def pack(docs: Iterator[tuple], width: int, open_windows: int) -> Iterator[Window]:
    """Full windows as they fill up and, last, at most one short one. ``docs``: (key, ids as bytes, first id, all ids)."""
    opened: list[Window] = []
    for doc in docs:
        start, left = 0, len(doc[1]) // 4
        while left >= width:
            window = Window()
            window.put(doc, start, width)
            yield window
            start, left = start + width, left - width
        while left:
            fitting = [w for w in opened if width - w.size >= left]
            if fitting:
                window = max(fitting, key=lambda w: w.size)
            elif len(opened) < open_windows:
                opened.append(window := Window())
            else:
                window = max(opened, key=lambda w: w.size)
            some = min(left, width - window.size)
            window.put(doc, start, some)
            start, left = start + some, left - some
            if window.size == width:
                opened.remove(window)
                yield window
    yield from _join(opened, width)


def _join(opened: list[Window], width: int) -> Iterator[Window]:
    """The open windows' pieces one after the other, cut where a window is full."""
    window = Window()
    for doc, start, length in (piece for w in opened for piece in w.pieces):
        while length:
            some = min(length, width - window.size)
            window.put(doc, start, some)
            start, length = start + some, length - some
            if window.size == width:
                yield window
                window = Window()
    if window.size:
        yield window


def _rows(windows: Iterator[Window], width: int, first: int) -> Iterator[pa.RecordBatch]:
    """Rows of pieces; ids are kept only for a short window, which is still to be merged."""
    out: list[tuple] = []
    for number, window in enumerate(windows):
        at = 0
        for (key, ids, before, total), start, length in window.pieces:
            piece = ids[4 * start : 4 * (start + length)]
            kept = piece if window.size < width else None
            out.append((key, before + start, length, zlib.crc32(piece), total, first + number, at, kept))
            at += length
        if len(out) >= 10_000:
            yield _batch(out)
            out = []
    yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(PIECES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES, strict=True)], schema=PIECES)


def _first_stage(encoder: Callable[[bytes], bytes] | str, end_id: int, width: int, open_windows: int):
    def run(batches):
        from pyspark import TaskContext

        end = np.array([end_id], ID).tobytes()
        if isinstance(encoder, str):
            known = _encoders.get(encoder) or _encoders.setdefault(encoder, WordIds(encoder))

        def texts(chunk):
            if isinstance(encoder, str):
                return known.texts(chunk, end)
            raw, bounds = chunk.data.tobytes(), chunk.offsets.tolist()
            return (encoder(raw[a:b]) + end for a, b in zip(bounds[:-1], bounds[1:], strict=True))

        def docs():
            for batch in batches:
                for chunk in tx.chunks(batch.column(1)):
                    keys = batch.column(0).slice(chunk.first, len(chunk.offsets) - 1).to_pylist()
                    for key, ids in zip(keys, texts(chunk), strict=True):
                        yield key, ids, 0, len(ids) // 4

        yield from _rows(pack(docs(), width, open_windows), width, TaskContext.get().partitionId() << 32)

    return run


def _merge(width: int, open_windows: int, round_no: int):
    def run(key: tuple[pa.Scalar, ...], batch: pa.Table) -> pa.Table:
        batch = batch.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        names = ("doc_id", "ids", "start", "doc_tokens")
        docs = zip(*(batch.column(n).to_pylist() for n in names), strict=True)
        # Ids above those of any partition, apart for each round and group.
        first = (1 << 62) + (round_no << 55) + (key[0].as_py() << 24)
        return pa.Table.from_batches(_rows(pack(docs, width, open_windows), width, first), PIECES)

    return run


def pack_tokens(
    docs: DataFrame,
    tokenizer: str | Callable[[bytes], bytes],
    *,
    doc: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    width: int = WINDOW,
    open_windows: int = 32,
    merge_ways: int = 256,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``width`` ids.

    ``tokenizer`` is the path of a word tokenizer's file, or a function from a
    text's bytes to its packed little-endian 32-bit ids. Columns: the document,
    ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and
    ``offset``. Sequence ids are unique; offsets have no gaps.
    """
    workers()
    texts = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    packed = settle(texts.mapInArrow(_first_stage(tokenizer, end_id, width, open_windows), _SCHEMA), "packed")
    done, short = packed.where("ids IS NULL"), packed.where("ids IS NOT NULL")
    group = F.expr("sequence_id >> 32")
    for round_no in range(8):
        # A partition leaves one short window, so a group has at most merge_ways of them.
        short = short.withColumn("group", (group / merge_ways).cast("long"))
        groups = short.groupBy("group")
        merged = groups.applyInArrow(_merge(width, open_windows, round_no), _SCHEMA)
        merged = settle(merged, "merged")
        done = done.union(merged.where("ids IS NULL"))
        short = merged.where("ids IS NOT NULL")
        group = F.expr("(sequence_id & ((1L << 55) - 1)) >> 24")
        if short.select("sequence_id").distinct().count() <= 1:
            break
    return done.union(short).drop("ids").withColumnRenamed("doc_id", doc)
