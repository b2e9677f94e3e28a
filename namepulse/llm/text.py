"""Vectorised views of text batches: bytes, words, lines and their hashes.

Tasks see Arrow batches. They are cut into chunks of whole texts of about
``CHUNK`` bytes, so that the arrays of a task stay small however many rows a
batch has. A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``.

Hashes are 64 bits wide: a polynomial over random byte values, then mixed. The
same bytes give the same hash in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 2 << 20
_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def table(members: bytes) -> np.ndarray:
    """A 256-entry membership table of byte values."""
    flags = np.zeros(256, bool)
    flags[list(members)] = True
    return flags


IS_SPACE = table(_SPACES)
IS_TAIL = table(bytes(range(0x80, 0xC0)))  # bytes inside a code point
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on all."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n-1 of the base and of its inverse; those of ordinary chunks are kept."""
    if n > 2 * CHUNK:
        return _make_powers(n)
    if not _powers or len(_powers[0]) < n:
        _powers[:] = _make_powers(max(n, CHUNK))
    return _powers[0][:n], _powers[1][:n]


def _make_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _UNBASE)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def range_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each ``data[start:end]``."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[:-1], out=sums[1:])
    out = (sums[ends] - sums[starts]) * down[starts]
    return mix(out + (ends - starts).astype(np.uint64) * _VALUES[0])


class Chunk(NamedTuple):
    """Some whole texts of a batch: rows ``first`` to ``first + len(offsets) - 2``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """The texts of a column as UTF-8 bytes; a null is an empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield Chunk(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


class Words(NamedTuple):
    """Words in order: bounds in the chunk's bytes, text and hash; ``bounds`` has the words of each text."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words(chunk: Chunk, data: np.ndarray | None = None, piece: int = 2 * CHUNK) -> Words:
    """All words of a chunk. A text longer than ``piece`` is gone through in pieces cut at separators."""
    data = chunk.data if data is None else data
    found = []
    at = 0
    while at < len(data):
        to = min(at + piece, len(data))
        while to < len(data):
            spaces = np.flatnonzero(IS_SPACE[data[max(at, to - 65536) : to]])
            if len(spaces):
                to = max(at, to - 65536) + int(spaces[-1]) + 1
                break
            to = min(to + piece, len(data))
        inner = chunk.offsets[(chunk.offsets > at) & (chunk.offsets < to)]
        found.append([x + at for x in _bounds(data[at:to], inner - at)] + [None])
        starts, ends, _ = found[-1]
        found[-1][2] = range_hash(data[at:to], starts - at, ends - at)
        at = to
    starts, ends, hashes = (
        (np.concatenate(x) for x in zip(*found, strict=True))
        if found
        else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    )
    return Words(starts, ends, hashes, np.searchsorted(starts, chunk.offsets))


def _bounds(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words, none of which crosses a cut."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~IS_SPACE[data]
    starts = inside[1:] & ~inside[:-1]
    ends = ~inside[1:] & inside[:-1]
    starts[cuts] |= inside[cuts + 1]
    ends[cuts] |= inside[cuts]
    return np.flatnonzero(starts), np.flatnonzero(ends)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``size`` words within one text, in order; see ``window_starts``."""
    at, doc = window_starts(words, size)
    out = np.zeros(len(at), np.uint64)
    for i in range(size):
        out = out * _BASE + words.hashes[at + i]
    return mix(out), doc


def window_starts(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, text) of every run of ``size`` words within one text."""
    counts = np.maximum(np.diff(words.bounds) - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    skipped = np.cumsum(np.diff(words.bounds) - counts) - (np.diff(words.bounds) - counts)
    return np.arange(len(doc)) + skipped[doc], doc


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set within each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def lines(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines between line feeds, and the bounds of each text's lines."""
    breaks = np.flatnonzero(chunk.data == 10)
    starts = np.sort(np.concatenate([chunk.offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, chunk.offsets[1:]]), kind="stable")
    counts = 1 + np.diff(np.searchsorted(breaks, chunk.offsets))
    return starts, ends, np.concatenate([[0], np.cumsum(counts)])


def column(array: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """A column; unsigned hashes are stored as signed 64-bit values."""
    return pa.array(array.view(np.int64) if array.dtype == np.uint64 else array, kind)
