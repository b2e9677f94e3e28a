"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

Texts are words without ASCII punctuation, A-Z in lower case, one space between
words. The CGK walk of an embedding reads a code point, writes it, and steps on
or stays by a random bit of code point and step; so strings that differ by few
edits give strings that differ in few places. Several hashes sample places of
each embedded string. An item is embedded from its starts as far as the walk
stays inside it, a document from each of its starts; an equal hash nominates the
item-sized window around it. Starts are those of words, and every code point of
scripts that are written without spaces.

How long an item's walks are, how many places a hash samples and how many
embeddings there are follow from the item and the edits that ``percent`` allows:
the item is edited at random as much as that ``TRIES`` times, and the first of
``LADDER`` that finds the ``recall`` of those copies is taken, with as many
embeddings as that took. Items too short or too repetitive for all of these have walks so
short that they stay within the run of whole code points that is always left.

A nominated window, with room for shifts, is compared with the item by the
least edit distance (code points) of the item to any part of the window. Items
within ``100 - percent`` per cent of edits are leaks.

The hashes of all items reach the tasks as a bit table of fixed size; what
passes is joined with the items' hashes. Only the pieces of a text around its
nominations travel, as far as the longest item reaches. Null, empty and wordless
texts and items match nothing. Repeated rows, documents and items are found as
often as their ids differ; a null id is an id like any other. Empty tables give
no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namepulse.llm import text as tx
from namepulse.llm.tables import settle, workers


class Walk(NamedTuple):
    """Steps of a walk, how many of them a hash samples, how many embeddings there may
    be and how many hashes each gives; ``everywhere``: from every code point."""

    steps: int
    sampled: int
    embeddings: int
    hashes: int
    everywhere: bool = False


_SIZES = (Walk(48, 14, 5, 3), Walk(36, 12, 5, 3), Walk(24, 10, 4, 3), Walk(12, 6, 4, 3))
#: What an item's walks may be, the ones that nominate least by chance first.
LADDER = (*_SIZES, *(w._replace(everywhere=True) for w in _SIZES[:-1]))
#: Edited copies by which an item's recall is measured, and how many of its code points they have at most:
#: what finds a part finds the whole.
TRIES = 400
_SEEN = 2000
#: Code points from here on are of scripts without spaces between words, or are rare.
_UNSPACED = 0x0E00
_PIECE = 1 << 13
_TABLE_BITS = 26
#: A first look at 32-bit hashes in a smaller table spares most of the 64-bit ones.
_MARK_BITS = 21
_ODD = np.uint32(0x9E3779B1)
#: Nominations of an item that start within so many code points are one.
_NEAR = 32
_PUNCTUATION = bytes(set(range(33, 127)) - set(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
NORMAL = np.where(tx.table(_PUNCTUATION), np.uint8(32), tx.LOWER)
_CANDIDATES = "doc_id long, text string, signatures array<long>, places array<int>"
_INDEX = "item_id long, item string, signature long, mark int, place int, steps int, sampled int, everywhere boolean, embeddings int"


def _draws(walk: Walk, embedding: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """The embedding's odd factors, one for each 32 steps, the hashes' first values, and which hashes sample each step.

    Walks of all sizes share their embeddings: a shorter one is the other's beginning.
    """
    rng = np.random.Generator(np.random.PCG64([11, embedding]))
    factors = rng.integers(1, 2**63, walk.steps // 32 + 1, np.uint64) * np.uint64(2) + np.uint64(1)
    rng = np.random.Generator(np.random.PCG64([13, *walk[:2], walk.everywhere, embedding]))
    first = rng.integers(1, 2**63, walk.hashes, np.uint64)
    places = [set(rng.choice(walk.steps, walk.sampled, replace=False).tolist()) for _ in range(walk.hashes)]
    return factors, first, [[h for h in range(walk.hashes) if step in places[h]] for step in range(walk.steps)]


def _marked_pieces(symbols: np.ndarray, starts: np.ndarray, walks: list[Walk], embedding: int):
    """``_MARK_BITS`` bits for each of the walks' hashes and each start, some starts at a time: equal where signatures are."""
    draws = [_draws(walk, embedding) for walk in walks]
    firsts = np.cumsum([0, *(walk.hashes for walk in walks)])
    steps = max(walk.steps for walk in walks)
    sampled = [[low + h for low, w, d in zip(firsts, walks, draws) if step < w.steps for h in d[2][step]] for step in range(steps)]
    own = [(symbols * f >> np.uint64(32)).astype(np.uint32) for f in max((d[0] for d in draws), key=len)]
    begin = np.concatenate([d[1] for d in draws]).astype(np.uint32)[:, None]
    for low in range(0, len(starts), _PIECE):
        at = starts[low : low + _PIECE].astype(np.int64)
        hashes = np.empty((len(begin), len(at)), np.uint32)
        hashes[:] = begin
        here, bit = np.empty(len(at), np.uint32), np.empty(len(at), np.uint32)
        for step in range(steps):
            np.take(own[step >> 5], at, out=here, mode="clip")
            for h in sampled[step]:
                hashes[h] *= _ODD
                hashes[h] += here
            # The walk's random bit of code point and step.
            np.right_shift(here, np.uint32(step & 31), out=bit)
            np.bitwise_and(bit, np.uint32(1), out=bit)
            at += bit
        hashes ^= hashes >> np.uint32(15)
        hashes *= _ODD
        hashes >>= np.uint32(32 - _MARK_BITS)
        yield low, hashes


def marks(symbols: np.ndarray, starts: np.ndarray, walk: Walk, embedding: int) -> np.ndarray:
    parts = [hashes for _, hashes in _marked_pieces(symbols, starts, [walk], embedding)]
    return np.concatenate(parts, 1) if parts else np.zeros((walk.hashes, 0), np.uint32)


def signatures(symbols: np.ndarray, starts: np.ndarray, walk: Walk, embedding: int) -> tuple[np.ndarray, np.ndarray]:
    """The sampled hashes of the walk from each start, and the last place each walk reads.

    ``symbols`` are mixed code points (``mixed``). Walks that run off the end
    go on reading the last one.
    """
    factors, first, sampled = _draws(walk, embedding)
    out = np.empty((walk.hashes, len(starts)), np.uint64)
    out[:] = first[:, None]
    at = last = starts.astype(np.int64)
    for step in range(walk.steps):
        here = symbols.take(at, mode="clip") * factors[step >> 5]
        for h in sampled[step]:
            out[h] *= tx._BASE
            out[h] += here
        last = at
        at = at + ((here >> np.uint64(32 + (step & 31))) & np.uint64(1)).view(np.int64)
    return tx.mix(out), last


def mixed(codes: np.ndarray) -> np.ndarray:
    return tx.mix(codes.astype(np.uint64) + np.uint64(1))


def starts_of(codes: np.ndarray) -> np.ndarray:
    """Flags of code points that begin a word or belong to a script without spaces."""
    begins = np.ones(len(codes), bool)
    begins[1:] = (codes[:-1] == 32) | (codes[1:] >= _UNSPACED)
    return begins & (codes != 32)


def item_signatures(codes: np.ndarray, walk: Walk, embedding: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, place of each) of an item's walks that stay inside it."""
    starts = np.arange(len(codes)) if walk.everywhere else np.flatnonzero(starts_of(codes))
    hashes, last = signatures(mixed(codes), starts, walk, embedding)
    inside = last < len(codes)
    return hashes[:, inside], starts[inside]


def edited(codes: np.ndarray, edits: int, tries: int, seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    """Copies of an item with so many code points replaced, left out or preceded by another: code points, and whose they are."""
    rng = np.random.Generator(np.random.PCG64([seed, len(codes)]))
    size = len(codes)
    kind = np.zeros((tries, size + 1), np.int8)
    places = np.argsort(rng.random((tries, size)), 1)[:, :edits]
    np.put_along_axis(kind, places, rng.integers(1, 4, places.shape, np.int8), 1)
    kind[:, size] = 0
    other = np.full(kind.shape, 1, np.uint32)  # no normal text has it
    whole = np.broadcast_to(np.append(codes, np.uint32(32)), kind.shape)
    # Two cells for each code point: what is put before it, and itself or what replaces it.
    cells = np.stack([other, np.where(kind == 1, other, whole)], 2)
    kept = np.stack([kind == 3, kind != 2], 2)
    owner = np.broadcast_to(np.arange(tries)[:, None, None], kept.shape)
    return cells[kept], owner[kept]


def run_walk(length: int, percent: int) -> Walk:
    """Walks no longer than the run of whole code points that any ``100 - percent`` per cent of edits leave."""
    edits = length * (100 - percent) // 100
    steps = max(1, -((edits - length) // (edits + 1)))
    return Walk(steps, steps, 1, 1, True)


def chosen(codes: np.ndarray, percent: int = 80, recall: float = 0.99, tries: int = TRIES) -> Walk:
    """The walks of an item: ``embeddings`` is how many of them it takes."""
    part = codes[:_SEEN]
    copies, owner = edited(part, len(part) * (100 - percent) // 100, tries)
    symbols, begins = mixed(copies), starts_of(copies)
    for walk in LADDER:
        found = np.zeros(tries, bool)
        starts = np.arange(len(copies)) if walk.everywhere else np.flatnonzero(begins)
        for embedding in range(walk.embeddings):
            own, _ = item_signatures(part, walk, embedding)
            if not own.size:
                break
            hashes, _ = signatures(symbols, starts, walk, embedding)
            hit = np.isin(hashes, own).any(0)
            found[owner[starts[hit]]] = True
            if found.mean() >= recall:
                return walk._replace(embeddings=embedding + 1)
    return run_walk(len(codes), percent)


class _Joined(NamedTuple):
    """The normal texts of a chunk, one space between words: bytes, code points before each, bounds, word starts."""

    data: np.ndarray
    points: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray

    def text(self, row: int) -> str:
        return self.data[self.bounds[row] : self.bounds[row + 1]].tobytes().decode()


def _join_words(chunk: tx.Chunk) -> _Joined:
    data = NORMAL[chunk.data]
    kept = ~tx.IS_SPACE[data]
    begins = kept.copy()
    begins[1:] &= ~kept[:-1]
    texts = chunk.offsets[:-1][chunk.offsets[:-1] < len(data)]
    begins[texts] = kept[texts]
    starts = np.flatnonzero(begins)
    bounds = np.searchsorted(starts, chunk.offsets)
    inner = np.ones(len(starts), bool)
    inner[bounds[:-1][bounds[:-1] < bounds[1:]]] = False
    kept[starts[inner] - 1] = True
    data[starts[inner] - 1] = 32
    starts = np.cumsum(kept, dtype=np.int32)[starts] - 1
    data = data[kept]
    points = np.cumsum(~tx.IS_TAIL[data], dtype=np.int32) - 1 if len(data) and data.max() > 127 else np.arange(len(data), dtype=np.int32)
    # A text begins at its first word, an empty one where the text before ends.
    return _Joined(data, points, np.append(starts, len(data))[bounds], starts)


def _points(data: np.ndarray) -> np.ndarray:
    if not len(data) or data.max() < 128:
        return data.astype(np.uint32)
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)


def _item_rows(percent: int, recall: float):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for chunk in tx.chunks(batch.column(1)):
                joined = _join_words(chunk)
                for row in range(len(chunk.offsets) - 1):
                    own = joined.data[joined.bounds[row] : joined.bounds[row + 1]]
                    if len(own):
                        yield _of_item(ids[chunk.first + row], own, percent, recall)

    return run


def _of_item(item_id: int | None, own: np.ndarray, percent: int, recall: float) -> pa.RecordBatch:
    codes = _points(own)
    walk = chosen(codes, percent, recall)
    found = [item_signatures(codes, walk, embedding) for embedding in range(walk.embeddings)]
    hashes = np.concatenate([h.ravel() for h, _ in found])
    places = np.concatenate([np.tile(p, walk.hashes) for _, p in found])
    mark = np.concatenate([marks(mixed(codes), p, walk, embedding).ravel() for embedding, (_, p) in enumerate(found)])
    # A repetitive item has the same hash at many places: once for those that are near each other.
    order = np.lexsort((places, hashes))
    hashes, places, mark = hashes[order], places[order], mark[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (places[1:] // _NEAR != places[:-1] // _NEAR)
    hashes, places, mark = hashes[first], places[first], mark[first]
    same = lambda value, kind: pa.array([value] * len(hashes), kind)
    columns = [
        same(item_id, pa.int64()),
        same(own.tobytes().decode(), pa.string()),
        tx.column(hashes),
        pa.array(mark, pa.int32()),
        pa.array(places, pa.int32()),
        same(walk.steps, pa.int32()),
        same(walk.sampled, pa.int32()),
        same(walk.everywhere, pa.bool_()),
        same(walk.embeddings, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["item_id", "item", "signature", "mark", "place", "steps", "sampled", "everywhere", "embeddings"])


def _walks(index: DataFrame) -> list[Walk]:
    """The kinds of walk that items have, each with the most embeddings that one has: no more than the ladder's and the short runs'."""
    hashes = {(w.steps, w.sampled, w.everywhere): w.hashes for w in LADDER}
    rows = index.groupBy("steps", "sampled", "everywhere").agg(F.max("embeddings").alias("n")).collect()
    return sorted(Walk(r.steps, r.sampled, r.n, hashes.get((r.steps, r.sampled, r.everywhere), 1), r.everywhere) for r in rows)


def _bits(spots: DataFrame, size: int) -> np.ndarray:
    """A table of ``2 ** size`` bits of which those in the column ``at`` are set, whatever the number of items."""
    cells = spots.groupBy(F.expr("at div 32").alias("word"))
    rows = cells.agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 AS int))")).alias("bits")).toArrow()
    bits = np.zeros((1 << size) // 32, np.uint32)
    bits[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return bits


def _spots() -> list:
    """Two places of a signature in the table."""
    return [F.expr(f"shiftrightunsigned(signature, {64 - _TABLE_BITS - i * _TABLE_BITS}) & {(1 << _TABLE_BITS) - 1}") for i in (0, 1)]


def _hits(found: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Flags of signatures whose two places are set."""
    hit = np.ones(found.shape, bool)
    for i in (0, 1):
        at = ((found >> np.uint64(64 - _TABLE_BITS - i * _TABLE_BITS)) & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)
        hit &= (bits[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1
    return hit


def _nominated(symbols: np.ndarray, starts: np.ndarray, walks: list[Walk], marked: np.ndarray, bits: np.ndarray):
    """(hashes, their starts) of the walks from each start that may be an item's, embedding by embedding."""
    for embedding in range(max((w.embeddings for w in walks), default=0)):
        own = [w for w in walks if w.embeddings > embedding]
        seen = np.zeros((len(own), len(starts)), bool)
        for low, hashes in _marked_pieces(symbols, starts, own, embedding):
            row = 0
            for flags, walk in zip(seen[:, low : low + _PIECE], own, strict=True):
                for h in hashes[row : row + walk.hashes]:
                    flags |= np.take(marked, h, mode="clip")
                row += walk.hashes
        for walk, flags in zip(own, seen, strict=True):
            at = starts[flags]
            found, _ = signatures(symbols, at, walk, embedding)
            h, place = np.nonzero(_hits(found, bits))
            yield found[h, place], at[place]


def _pieces(doc: np.ndarray, places: np.ndarray, reach: int) -> np.ndarray:
    """Where a new piece begins among hits in order: in another text, or too far from the hit before."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (places[1:] - places[:-1] > 2 * reach)
    return np.flatnonzero(new)


def _scan(bits: np.ndarray, mark_bits: np.ndarray, walks: list[Walk], reach: int):
    """Pieces of documents with walks that may be an item's: normal text, hashes and the code points where they start."""

    def run(batches):
        marked = np.unpackbits(mark_bits.view(np.uint8), bitorder="little").view(bool)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            null = np.array([not x.is_valid for x in batch.column(0)], bool)
            for chunk in tx.chunks(batch.column(1)):
                joined = _join_words(chunk)
                codes = _points(joined.data)
                symbols = mixed(codes)
                begins = codes >= _UNSPACED
                begins[joined.points[joined.starts]] = True
                word_starts = np.flatnonzero(begins)
                hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for everywhere in {walk.everywhere for walk in walks}:
                    starts = np.arange(len(codes)) if everywhere else word_starts
                    own = [walk for walk in walks if walk.everywhere == everywhere]
                    for found, at in _nominated(symbols, starts, own, marked, bits):
                        hashes.append(found)
                        places.append(at)
                hashes, places = np.concatenate(hashes), np.concatenate(places)
                order = np.argsort(places, kind="stable")
                hashes, places = hashes[order], places[order]
                bounds = np.append(joined.points, len(codes))[joined.bounds]
                doc = np.searchsorted(bounds, places, "right") - 1
                first = _pieces(doc, places, reach)
                ends = np.append(first, len(places))
                own = doc[first]
                low = np.maximum(places[first] - reach, bounds[own])
                high = np.minimum(places[ends[1:] - 1] + reach, bounds[own + 1])
                places = places - np.repeat(low, np.diff(ends))
                rows = chunk.first + own
                cut = [codes[a:b].tobytes().decode("utf-32-le") for a, b in zip(low.tolist(), high.tolist())]
                columns = [
                    pa.array(np.where(null[rows], 0, ids[rows]).astype(np.int64), pa.int64(), mask=null[rows]),
                    pa.array(cut, pa.string()),
                    pa.ListArray.from_arrays(ends.astype(np.int32), hashes.view(np.int64)),
                    pa.ListArray.from_arrays(ends.astype(np.int32), places.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "signatures", "places"])

    return run


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, and the bounds of each text's."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), bounds


def _edits_of_slice(items: list[str], texts: list[str]) -> np.ndarray:
    """Least edits of each (item, text); the items take the same number of 64-bit blocks.

    One pass over the columns of all pairs at once, with differences between
    rows held in bits. Texts are filled up with a symbol of no item, which can
    not lower a distance.
    """
    names = {item: i for i, item in enumerate(dict.fromkeys(items))}
    own = np.array([names[item] for item in items])
    codes, bounds = _codes(list(names))
    alphabet = np.unique(codes)
    width, sizes = len(alphabet) + 1, np.diff(bounds)
    blocks = int(sizes.max() + 63) // 64
    place = np.arange(len(codes)) - np.repeat(bounds[:-1], sizes)
    cell = np.repeat(np.arange(len(names)), sizes) * width + 1 + np.searchsorted(alphabet, codes)
    same = np.zeros((blocks, len(names) * width), np.uint64)
    np.bitwise_or.at(same, (place >> 6, cell), np.uint64(1) << (place & 63).astype(np.uint64))

    codes, bounds = _codes(texts)
    at = np.minimum(np.searchsorted(alphabet, codes), len(alphabet) - 1)
    symbol = np.where(alphabet[at] == codes, at + 1, 0)
    lengths = np.diff(bounds)
    steps = np.repeat(own[None, :] * width, max(int(lengths.max()), 1), 0).astype(np.int32)
    column = np.repeat(np.arange(len(texts)), lengths)
    steps[np.arange(len(codes)) - np.repeat(bounds[:-1], lengths), column] += symbol.astype(np.int32)

    one, last = np.uint64(1), np.uint64(63)
    top = ((sizes[own] - 1) & 63).astype(np.uint64)
    up, down = np.full((blocks, len(items)), ~np.uint64(0)), np.zeros((blocks, len(items)), np.uint64)
    score = sizes[own].copy()
    best = score.copy()
    nothing = np.zeros(len(items), np.uint64)
    for step in steps:
        more, less = nothing, nothing  # what the block above passes on: a rise or a fall of one
        for block in range(blocks):
            p, m, equal = up[block], down[block], same[block].take(step)
            stay = equal | m
            if block:
                equal |= less
            zero = (((equal & p) + p) ^ p) | equal
            rises, falls = m | ~(zero | p), p & zero
            if block == blocks - 1:
                score += ((rises >> top) & one).view(np.int64)
                score -= ((falls >> top) & one).view(np.int64)
            passed = (rises >> last, falls >> last) if block < blocks - 1 else None
            rises, falls = rises << one, falls << one
            if block:
                rises |= more
                falls |= less
            up[block], down[block] = falls | ~(stay | rises), rises & stay
            more, less = passed or (nothing, nothing)
        np.minimum(best, score, out=best)
    return best


def _possible(items: list[str], pieces: list[str], most: np.ndarray, at_once: int) -> np.ndarray:
    """Which pairs may be within ``most`` edits: 64 code points of an item at a
    time, whose least edits add up to no more than the item's."""
    left = np.argsort([len(p) for p in pieces], kind="stable")
    bound = np.zeros(len(items), np.int64)
    for low in range(0, max(map(len, items), default=0), 64):
        more = np.array([len(items[i]) > max(64, low) for i in left], bool)
        done, left = left[~more], left[more]
        for first in range(0, len(left), at_once):
            some = left[first : first + at_once]
            bound[some] += _edits_of_slice([items[i][low : low + 64] for i in some], [pieces[i] for i in some])
        left = np.concatenate([done, left])
        left = left[bound[left] <= most[left]]
        left = left[np.argsort([len(pieces[i]) for i in left], kind="stable")] if len(left) else left
    return left


def least_edits(items: list[str], texts: list[str], percent: int = 0, at_once: int = 2048) -> np.ndarray:
    """For each pair, the least edit distance of the item to any part of the text.

    Exact up to ``100 - percent`` per cent of the item's code points; above
    that, above it too. Long texts are cut into pieces that overlap by the
    longest part so close to the item.
    """
    pairs, pieces = [], []
    for pair, (item, text) in enumerate(zip(items, texts, strict=True)):
        overlap = len(item) + len(item) * (100 - percent) // 100 + 1
        for start in range(0, max(1, len(text) - overlap), 2 * overlap):
            pairs.append(pair)
            pieces.append(text[start : start + 3 * overlap])
    best = np.array([len(item) for item in items], np.int64)
    most = best * (100 - percent) // 100
    left = _possible([items[i] for i in pairs], pieces, most[pairs], at_once) if percent else range(len(pairs))
    work = sorted(((len(items[pairs[i]]) + 63) // 64, len(pieces[i]), i) for i in left)
    first = 0
    while first < len(work):
        end = first + 1
        while end < len(work) and end - first < at_once and work[end][0] == work[first][0]:
            end += 1
        some = [w[2] for w in work[first:end]]
        found = _edits_of_slice([items[pairs[i]] for i in some], [pieces[i] for i in some])
        np.minimum.at(best, [pairs[i] for i in some], found)
        first = end
    return best


def _spans(starts: list[int], size: int, slack: int) -> list[list[int]]:
    """Code points around the nominated windows of so many, those that meet as one."""
    spans: list[list[int]] = []
    for start in sorted(starts):
        low, high = max(0, start - slack), start + size + slack
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(high, spans[-1][1])
        else:
            spans.append([low, high])
    return spans


def _check(percent: int, at_once: int = 4 << 20):
    """Documents with their nominations: compares about ``at_once`` code points of windows at a time."""

    def checked(ids: list, items: list[str], texts: list[str]) -> pa.RecordBatch:
        least: dict[tuple, int] = {}
        for (doc, item_id), item, edits in zip(ids, items, least_edits(items, texts, percent).tolist(), strict=True):
            if 100 * edits <= (100 - percent) * len(item):
                key = (doc, item_id, len(item))
                least[key] = min(edits, least.get(key, edits))
        rows = [(doc, item_id, edits, size) for (doc, item_id, size), edits in least.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "edits", "item_chars"])

    def run(batches):
        ids, items, texts, size = [], [], [], 0
        for batch in batches:
            for doc, text, nominated in zip(*(batch.column(n) for n in ("doc_id", "text", "nominated")), strict=True):
                whole = text.as_py()
                starts: dict[tuple, list[int]] = {}
                for n in nominated.as_py():
                    starts.setdefault((n["item_id"], n["item"]), []).append(n["near"] * _NEAR)
                for (item_id, item), own in starts.items():
                    for low, high in _spans(own, len(item), 2 * _NEAR + len(item) * (100 - percent) // 100):
                        ids.append((doc.as_py(), item_id))
                        items.append(item)
                        texts.append(whole[low:high])
                        size += len(texts[-1])
                if size > at_once:
                    yield checked(ids, items, texts)
                    ids, items, texts, size = [], [], [], 0
        yield checked(ids, items, texts)

    return run


def leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    percent: int = 80,
    recall: float = 0.99,
) -> DataFrame:
    """One row per document and item found in it: ``edits``, the least distance, and ``item_chars``, the item's length.

    ``recall`` is the share of an item's copies with all the edits that
    ``percent`` allows, at random places, that its walks are to find; unchanged
    items are always found.
    """
    workers()
    index = items.select(F.col(item).cast("long"), F.col(item_text).cast("string"))
    index = settle(index.mapInArrow(_item_rows(percent, recall), _INDEX).withColumn("name", F.xxhash64("item_id", "item")), "items")
    longest = index.agg(F.max(F.length("item")).alias("n")).first().n or 0
    reach = longest + longest * (100 - percent) // 100 + 3 * _NEAR
    bits = _bits(index.select(F.explode(F.array(*_spots())).alias("at")), _TABLE_BITS)
    mark_bits = _bits(index.select(F.col("mark").cast("long").alias("at")), _MARK_BITS)
    texts = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string"))
    found = texts.mapInArrow(_scan(bits, mark_bits, _walks(index), reach), _CANDIDATES)
    # The number stands for the piece from here on: it is written with it.
    found = settle(found.withColumn("row", F.monotonically_increasing_id()), "candidates")
    hits = found.select("row", F.explode(F.arrays_zip("signatures", "places")).alias("hit"))
    hits = hits.select("row", F.col("hit.signatures").alias("signature"), F.col("hit.places").alias("at"))
    near = F.floor((F.col("at") - F.col("place")) / _NEAR).cast("int").alias("near")
    windows = hits.join(index.select("signature", "name", "place"), "signature").select("row", "name", near).distinct()
    names = index.select("name", "item_id", "item").distinct()
    windows = windows.join(names, "name").select("row", F.struct("item_id", "item", "near").alias("n"))
    # A piece's nominations are in proportion to its own length; its text goes to a task once.
    windows = windows.groupBy("row").agg(F.collect_set("n").alias("nominated"))
    rows = windows.join(found.select("row", "doc_id", "text"), "row")
    checked = rows.drop("row").mapInArrow(_check(percent), "doc_id long, item_id long, edits long, item_chars long")
    # An item that occurs with several texts, or a document, counts by its nearest.
    out = checked.groupBy("doc_id", "item_id").agg(F.min(F.struct("edits", "item_chars")).alias("least"))
    return out.select(F.col("doc_id").alias(doc), F.col("item_id").alias(item), "least.edits", "least.item_chars")
