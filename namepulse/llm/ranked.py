"""Ranked lexical search: MaxScore whose bounds know pairs of terms.

A term is a run of ASCII letters, digits and all characters above ASCII, with
A-Z lower-cased. A document's score for a query is the sum over the query's
terms of an integer impact (``impacts``).

* ``build`` reads all texts once and writes the index: blocks of some thousand
  documents with the postings of the queries' terms, and each term's document
  count. A second pass turns postings into impacts and adds, for pairs of terms
  that queries hold together, the list of the documents that have both and the
  greatest sum of both impacts.
* ``search`` reads the index. A task goes through its blocks one after the
  other and keeps each query's best documents so far; the least of them is the
  threshold. A query's terms are taken as units, a pair or a single term. A
  unit may be left out, adding its joint maximum to the bound of what is
  skipped; a pair may be entered by its intersection list only, adding the
  larger of its single maxima; or be entered whole, adding nothing. Steps are
  taken by gain per posting until the bound falls below the threshold. Only the
  documents so entered are scored, and only those whose sum so far, with the
  bound of the units left, still reaches the threshold meet the next unit.

Each task gives its best documents of each query, and those of all tasks are
ranked. Nothing is cut that could be in the result, so results are exact, ties
included. Pairs are chosen from the queries alone: the terms of a query, rarest
first, each with the next.

Queries go in groups of about ``GROUP`` (query, term) rows, as many as needed;
a group's terms are what tasks and the driver hold. Terms are compared by
64-bit hash and length.

Documents and queries with a null or wordless text have no terms and no rows.
Rows of one query id are one query, with the terms of all; a null id is one
too. Repeated rows of a document are ranked each; equal scores are ordered by
document, nulls last. Empty tables give no rows. A very long text is a block of
its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namepulse.llm import text as tx
from namepulse.llm.tables import settle, workers

GROUP = 200_000
#: Bytes of text and documents of a block, about.
BLOCK_BYTES, BLOCK_DOCS = 8 << 20, 8192
SALT, LENGTH_PERCENT, SCALE = 20, 50, 1_000_000_000
_IS_TERM = tx.table(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_POSTINGS = "docs array<long>, sizes array<long>, terms array<int>, counts array<int>, places array<int>, tf array<int>"
_INDEX = "docs array<long>, terms array<int>, counts array<int>, places array<int>, impacts array<long>, pairs array<int>, joint array<long>, shared array<int>, both array<int>"


class Terms(NamedTuple):
    """Terms of a chunk in order: start, end, hash, and the text they are in."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    doc: np.ndarray


def terms(chunk: tx.Chunk) -> Terms:
    data = tx.LOWER[chunk.data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IS_TERM[data]
    starts, ends = inside[1:] & ~inside[:-1], ~inside[1:] & inside[:-1]
    cuts = chunk.offsets[1:-1]
    starts[cuts] |= inside[cuts + 1]
    ends[cuts] |= inside[cuts]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    return Terms(starts, ends, tx.range_hash(data, starts, ends), np.searchsorted(chunk.offsets, starts, "right") - 1)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(w: np.ndarray, tf: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to a document's score, in 64-bit whole numbers."""
    m = 100 - LENGTH_PERCENT + LENGTH_PERCENT * sizes * n_docs // max(n_terms, 1)
    return w * (SCALE * tf // (1000 * tf + SALT * m))


class Queries(NamedTuple):
    """Some queries: ids, their terms' numbers, sorted hashes and lengths of terms, and the pairs of terms."""

    ids: list
    terms: list[np.ndarray]
    hashes: np.ndarray
    lengths: np.ndarray


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in tx.chunks(batch.column(1)):
            found = terms(chunk)
            columns = [batch.column(0).take(pa.array(chunk.first + found.doc)), tx.column(found.hashes), pa.array(found.ends - found.starts)]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "hash", "length"])


def _groups(queries: DataFrame) -> Iterator[Queries]:
    rows = queries.mapInArrow(_query_terms, "item_id long, hash long, length long").distinct()
    rows = settle(rows, "query-terms")
    groups = max(1, -(-rows.count() // GROUP))
    for number in range(groups):
        table = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == number).toArrow()
        if not len(table):
            continue
        hashes = np.asarray(table.column(1)).view(np.uint64)
        distinct, first, term = np.unique(hashes, return_index=True, return_inverse=True)
        own: dict = {}
        for item, t in zip(table.column(0).to_pylist(), term.tolist(), strict=True):
            own.setdefault(item, []).append(t)
        yield Queries(list(own), [np.array(sorted(t), np.int32) for t in own.values()], distinct, np.asarray(table.column(2))[first])


def _lists(columns: list[tuple[np.ndarray, pa.DataType]]) -> list[pa.Array]:
    return [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c, t)) for c, t in columns]


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _find_postings(hashes: np.ndarray, lengths: np.ndarray):
    """One row a block: documents, their sizes, and the postings of the given terms, by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        sizes, found = [], []
        n_bytes = n_docs = 0

        def block() -> pa.RecordBatch:
            term, place, tf = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.lexsort((place, term))
            known, counts = np.unique(term, return_counts=True)
            docs = pa.concat_arrays(ids).cast(pa.int64())
            docs = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)
            rest = _lists([(np.concatenate(sizes), pa.int64()), (known, pa.int32()), (counts, pa.int32()), (place[order], pa.int32()), (tf[order], pa.int32())])
            return pa.RecordBatch.from_arrays([docs, *rest], _names(_POSTINGS))

        for batch in batches:
            for chunk in tx.chunks(batch.column(1)):
                n = len(chunk.offsets) - 1
                read = terms(chunk)
                ids.append(batch.column(0).slice(chunk.first, n))
                sizes.append(np.bincount(read.doc, minlength=n))
                at = np.minimum(np.searchsorted(hashes, read.hashes), len(hashes) - 1)
                hit = np.flatnonzero((hashes[at] == read.hashes) & (lengths[at] == read.ends - read.starts))
                both, tf = np.unique(at[hit] * n + read.doc[hit], return_counts=True)
                found.append((both // n, both % n + n_docs, tf))
                n_docs, n_bytes = n_docs + n, n_bytes + len(chunk.data)
                if n_bytes >= BLOCK_BYTES or n_docs >= BLOCK_DOCS:
                    yield block()
                    ids, sizes, found = [], [], []
                    n_bytes = n_docs = 0
        if ids:
            yield block()

    return run


def _values(batch: pa.RecordBatch, row: int) -> dict[str, np.ndarray]:
    return {name: np.asarray(batch.column(name)[row].values) for name in batch.schema.names if name != "docs"}


def pairs_of(queries: list[np.ndarray], df: np.ndarray) -> np.ndarray:
    """Distinct pairs (a < b): each query's terms by document count, the first with the second and so on."""
    found = set()
    for query in queries:
        some = query[np.lexsort((query, df[query]))].tolist()
        some = [t for t in some if df[t]]
        found.update((min(p), max(p)) for p in zip(some[::2], some[1::2], strict=False))
    return np.array(sorted(found), np.int64).reshape(-1, 2)


def _add_impacts(weights: np.ndarray, pairs: np.ndarray, n_docs: int, n_terms: int):
    """Postings to impacts, by term and within it by document, and the lists of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                b = _values(batch, row)
                worth = impacts(np.repeat(weights[b["terms"]], b["counts"]), b["tf"].astype(np.int64), b["sizes"][b["places"]], n_docs, n_terms)
                bounds = np.concatenate([[0], np.cumsum(b["counts"])])
                where = np.full(len(weights), -1)
                where[b["terms"]] = np.arange(len(b["terms"]))
                at = where[pairs]
                kept, joint, lists = [], [], []
                for number in np.flatnonzero((at >= 0).all(1)).tolist():
                    (x, y) = (slice(bounds[i], bounds[i + 1]) for i in at[number])
                    both, i, j = np.intersect1d(b["places"][x], b["places"][y], assume_unique=True, return_indices=True)
                    kept.append(number)
                    joint.append(int((worth[x][i] + worth[y][j]).max()) if len(both) else 0)
                    lists.append(both)
                shared = [len(x) for x in lists]
                flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
                rest = _lists([(b["terms"], pa.int32()), (b["counts"], pa.int32()), (b["places"], pa.int32()), (worth, pa.int64()), (np.array(kept, int), pa.int32()), (np.array(joint, int), pa.int64()), (np.array(shared, int), pa.int32()), (flat, pa.int32())])
                yield pa.RecordBatch.from_arrays([batch.column("docs").slice(row, 1), *rest], _names(_INDEX))

    return run


class Block(NamedTuple):
    """A block's lists in memory: for each term and pair its documents, impacts and greatest impact."""

    n: int
    places: dict[int, np.ndarray]
    impacts: dict[int, np.ndarray]
    most: dict[int, int]
    both: dict[int, np.ndarray]
    joint: dict[int, int]


def _block(b: dict[str, np.ndarray], n: int) -> Block:
    def cut(values: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> dict[int, np.ndarray]:
        ends = np.cumsum(counts)
        return {k: values[e - c : e] for k, c, e in zip(keys.tolist(), counts.tolist(), ends.tolist(), strict=True)}

    worth = cut(b["impacts"], b["terms"], b["counts"])
    return Block(
        n,
        cut(b["places"], b["terms"], b["counts"]),
        worth,
        {k: int(v.max()) for k, v in worth.items()},
        cut(b["both"], b["pairs"], b["shared"]),
        dict(zip(b["pairs"].tolist(), b["joint"].tolist(), strict=True)),
    )


class Unit(NamedTuple):
    """Terms that are bounded together: ``high`` for a document with any of them, ``low`` for one without the pair."""

    terms: tuple[int, ...]
    pair: int
    high: int
    low: int


def units_of(query: np.ndarray, block: Block, pair_of: dict[tuple[int, int], int]) -> list[Unit]:
    """A query's terms in a block: pairs with a list where that tightens the bound, single terms otherwise."""
    out = []
    free = [t for t in query.tolist() if block.most.get(t, 0) > 0]
    here = set(free)
    for a in free:
        if a not in here:
            continue
        b, number = pair_of.get(a, (None, None))
        if b in here and number in block.joint:
            most = max(block.most[a], block.most[b])
            out.append(Unit((a, b), number, max(block.joint[number], most), most))
            here -= {a, b}
        else:
            out.append(Unit((a,), -1, block.most[a], block.most[a]))
            here.discard(a)
    return out


def plan(units: list[Unit], block: Block, threshold: int) -> list[int]:
    """How each unit is entered: 0 not at all, 1 by its pair's list, 2 whole; so that what is skipped is below the threshold."""
    ways = [0] * len(units)
    bound = sum(u.high for u in units)
    steps = []
    for i, u in enumerate(units):
        size = sum(len(block.places[t]) for t in u.terms)
        if u.pair >= 0 and u.high > u.low and (u.high - u.low) * size > u.high * len(block.both[u.pair]):
            listed = len(block.both[u.pair])
            steps.append(((u.high - u.low) / max(listed, 1), i, 1, u.high - u.low))
            steps.append((u.low / size, i, 2, u.low))
        else:
            steps.append((u.high / size, i, 2, u.high))
    for _, i, way, gain in sorted(steps, key=lambda s: (-s[0], s[1], s[2])):
        if bound < threshold:
            break
        ways[i], bound = way, bound - gain
    return ways


def best_in(query: np.ndarray, block: Block, pair_of: dict, threshold: int, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores) of a block that may reach the threshold, whole scores, and how many documents were entered."""
    units = units_of(query, block, pair_of)
    if sum(u.high for u in units) < threshold or not units:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    ways = plan(units, block, threshold)
    enter = np.zeros(block.n, bool)
    for u, way in zip(units, ways, strict=True):
        if way == 2:
            for t in u.terms:
                enter[block.places[t]] = True
        elif way == 1:
            enter[block.both[u.pair]] = True
    found = np.flatnonzero(enter)
    entered = len(found)
    left = sum(u.high for u in units)
    scores = np.zeros(len(found), np.int64)
    for u in sorted(units, key=lambda u: -u.high):
        if not len(found):
            break
        for t in u.terms:
            scratch[block.places[t]] = block.impacts[t]
            scores += scratch[found]
            scratch[block.places[t]] = 0
        left -= u.high
        if left:
            good = scores + left >= threshold
            if not good.all():
                found, scores = found[good], scores[good]
    good = scores >= threshold
    return found[good], scores[good], entered


def _search(queries: Queries, pairs: np.ndarray, k: int):
    pair_maps = []
    numbers = {tuple(p): i for i, p in enumerate(pairs.tolist())}
    by_term: dict[int, list[tuple[int, int]]] = {}
    for (a, b), i in numbers.items():
        by_term.setdefault(a, []).append((b, i))
        by_term.setdefault(b, []).append((a, i))
    for query in queries.terms:
        # Pairs of other queries are as good as a query's own; each term is in one.
        own, taken = set(query.tolist()), {}
        for a in query.tolist():
            for b, i in by_term.get(a, []):
                if a not in taken and b in own and b not in taken:
                    taken[a], taken[b] = (b, i), (a, i)
        pair_maps.append(taken)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.iinfo(np.int64).max
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in queries.ids]
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("docs")[row].values
                null = np.asarray(ids.is_null())
                docs = np.asarray(ids.fill_null(last))
                block = _block(_values(batch, row), len(docs))
                scratch = np.zeros(block.n, np.int64)
                for number, query in enumerate(queries.terms):
                    scores, own, unknown = best[number]
                    # A score of nought is no match.
                    threshold = max(int(scores[-1]), 1) if len(scores) == k else 1
                    found, more, _ = best_in(query, block, pair_maps[number], threshold, scratch)
                    if not len(found):
                        continue
                    scores, own, unknown = np.append(scores, more), np.append(own, docs[found]), np.append(unknown, null[found])
                    if len(scores) > 8 * k:
                        least = np.partition(scores, len(scores) - k)[len(scores) - k]
                        some = scores >= least
                        scores, own, unknown = scores[some], own[some], unknown[some]
                    order = np.lexsort((own, unknown, -scores))[:k]
                    best[number] = scores[order], own[order], unknown[order]
        n = [len(b[0]) for b in best]
        if sum(n):
            scores, own, unknown = (np.concatenate(c) for c in zip(*best, strict=True))
            items = pa.array(queries.ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(n)), n)))
            yield pa.RecordBatch.from_arrays([items, pa.array(own, mask=unknown), pa.array(scores)], ["item_id", "doc_id", "score"])

    return run


class Index(NamedTuple):
    """A written index for one group of queries: blocks, and the pairs that have lists."""

    queries: Queries
    blocks: DataFrame
    pairs: np.ndarray


def build(docs: DataFrame, queries: DataFrame, *, doc: str = "doc_id", item: str = "item_id", text: str = "text") -> Iterator[Index]:
    """The indexes of ``docs`` for all terms of ``queries``, one for each group of queries."""
    workers()
    texts = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = queries.select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("text"))
    for group in _groups(asked):
        postings = settle(texts.mapInArrow(_find_postings(group.hashes, group.lengths), _POSTINGS), "postings")
        n_docs, n_terms = postings.selectExpr(
            "coalesce(sum(size(filter(sizes, n -> n > 0))), 0L)", "coalesce(sum(aggregate(sizes, 0L, (a, n) -> a + n)), 0L)"
        ).first()
        held = postings.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
        held = held.groupBy("t.terms").agg(F.sum("t.counts").alias("df")).toArrow()
        df = np.zeros(len(group.hashes), np.int64)
        df[np.asarray(held.column(0))] = np.asarray(held.column(1))
        weights = np.array([weight(n_docs, int(x)) if x else 0 for x in df], np.int64)
        pairs = pairs_of(group.terms, np.where(weights > 0, df, 0))
        blocks = postings.mapInArrow(_add_impacts(weights, pairs, n_docs, n_terms), _INDEX)
        yield Index(group, settle(blocks, "lexical-index"), pairs)


def search(index: Index, k: int) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each query of the index."""
    found = index.blocks.mapInArrow(_search(index.queries, index.pairs, k), "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, queries: DataFrame, k: int = 50, **columns: str) -> DataFrame:
    """The ``k`` best documents of every query: indexes are built and searched group by group."""
    found = None
    for index in build(docs, queries, **columns):
        ranked = search(index, k)
        found = ranked if found is None else found.union(ranked)
    if found is None:
        found = docs.sparkSession.range(0).selectExpr("id AS item_id", "cast(id AS int) AS rank", "id AS doc_id", "id AS score")
    return found.withColumnsRenamed({"item_id": columns.get("item", "item_id"), "doc_id": columns.get("doc", "doc_id")})
