"""Personal data: plain patterns, and a linear-chain conditional random field that adds to them.

The patterns find e-mail addresses, IP addresses, card and telephone numbers
in their ordinary spellings. A random field over word shapes finds them in
other ones (``ann at mail dot org``, ``10[.]0[.]0[.]1``, ``(743) 555-0199``). It
is trained on the driver from a small labelled table of at most ``MOST_WORDS``
words, and decoded by Viterbi in numpy, a batch of texts at a time.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; its core is the word
without punctuation at its ends. Features are a word's shape, length, digits
and, where the labelled table has it often, its text, and some of these of
the words beside it. The words of a line are one chain. Each word is one of
``LABELS``; words of one kind in a row are one span, kept if it has what the
kind needs (``_holds``) and touches no span of the patterns.

Most words are settled without a chain: where the label "none" leads by more
than transitions can make up for, it is in every best path. Chains of the
words in between are decoded together; the labels are those of Viterbi over
whole lines.

A null text is an empty one and has no spans. Rows are judged one by one, so
repeated rows and null ids come out as they went in; an empty table gives no
rows. Very long texts and unbroken words are gone through in linear time.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namepulse.llm import text as tx
from namepulse.llm.tables import workers

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
MOST_WORDS = 200_000
#: A word of the labelled table is a feature by its text from so many occurrences on.
LEAST_OFTEN = 5

_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_ADDRESS = re.compile(r"[^\s@]+\s*(?:@|\bat\b|[(\[]at[)\]])\s*[^\s@.]+\s*(?:\.|\bdot\b|[(\[]dot[)\]])\s*[^\s@.]+", re.IGNORECASE)
_DIGITS = b"0123456789"
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_IS_DIGIT = tx.table(_DIGITS)
_IS_LOCAL = tx.table(_LETTERS + _DIGITS + b"._%+-")
_IS_EDGE = tx.table(b".,;:!?\"'#$%&*|<>{}=~^_`")
_CLASS = np.full(256, 10, np.uint8)
for _number, _members in enumerate((bytes(range(97, 123)) + bytes(range(128, 256)), bytes(range(65, 91)), _DIGITS, b"@", b".", b"-", b"+", b"([", b")]", b"/")):
    _CLASS[list(_members)] = _number


def _luhn(digits: bytes) -> bool:
    values = [b - 48 for b in reversed(digits)]
    return sum(values[::2]) % 10 == sum(v * 2 - 9 * (v > 4) for v in values[1::2]) * 9 % 10


def _runs(flags: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of set flags, none of which crosses a cut."""
    inside = np.zeros(len(flags) + 2, bool)
    inside[1:-1] = flags
    starts, ends = inside[1:] & ~inside[:-1], ~inside[1:] & inside[:-1]
    starts[cuts] |= inside[cuts + 1]
    ends[cuts] |= inside[cuts]
    return np.flatnonzero(starts), np.flatnonzero(ends)


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def base_spans(chunk: tx.Chunk) -> list[tuple[int, int, int, int]]:
    """(text, kind, start, end) in bytes of the chunk: leftmost matches of each kind that hold."""
    data, offsets = chunk.data, chunk.offsets
    raw = data.tobytes()
    out = []

    def row_of(places: np.ndarray) -> list[int]:
        return (np.searchsorted(offsets, places, "right") - 1).tolist()

    at = np.flatnonzero(data == 64)
    stops = np.concatenate([[-1], np.flatnonzero(~_IS_LOCAL[data])])
    before = stops[np.searchsorted(stops, at) - 1] + 1
    done = 0
    for place, start, row in zip(at.tolist(), before.tolist(), row_of(at), strict=True):
        start = max(start, done, int(offsets[row]))
        found = start < place and _DOMAIN.match(raw, place + 1, int(offsets[row + 1]))
        if found:
            done = found.end()
            out.append((row, 0, start, done))

    digit = _IS_DIGIT[data]
    digits = _sums(digit)
    cuts = offsets[1:-1]
    dots = data == 46
    n_dots = _sums(dots)
    starts, ends = _runs(digit | dots, cuts)
    some = (n_dots[ends] - n_dots[starts] >= 3) & (digits[ends] - digits[starts] >= 4)
    for start, end, row in zip(starts[some].tolist(), ends[some].tolist(), row_of(starts[some]), strict=True):
        for found in _IP.finditer(raw, start, end):
            if all(len(p.lstrip(b"0")) <= 3 and int(p) <= 255 for p in found.group().split(b".")):
                out.append((row, 1, *found.span()))

    starts, ends = _runs(digit | (data == 32) | (data == 45), cuts)
    some = digits[ends] - digits[starts] >= 12
    for start, end, row in zip(starts[some].tolist(), ends[some].tolist(), row_of(starts[some]), strict=True):
        for found in _CARD.finditer(raw, start, end):
            only = found.group().replace(b" ", b"").replace(b"-", b"")
            if 12 <= len(only) <= 19 and _luhn(only):
                out.append((row, 2, *found.span()))

    plus = np.flatnonzero((data[:-1] == 43) & digit[1:])
    done = 0
    for start, row in zip(plus.tolist(), row_of(plus), strict=True):
        found = start >= done and _PHONE.match(raw, start, int(offsets[row + 1]))
        if found:
            done = found.end()
            if 9 <= digits[done] - digits[start] <= 15:
                out.append((row, 3, start, done))
    return out


class Model(NamedTuple):
    """Sorted feature hashes, their weights for (own, before, after) x label, transitions, frequent words."""

    features: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    known: np.ndarray


class _Words(NamedTuple):
    """A chunk's words: core bounds, number of the distinct word, text, and whether the word before is in the same line."""

    starts: np.ndarray
    ends: np.ndarray
    kind: np.ndarray
    doc: np.ndarray
    joined: np.ndarray
    own: np.ndarray
    beside: np.ndarray
    text: np.ndarray


def _bucket(n: np.ndarray) -> np.ndarray:
    return np.minimum(n, 12 + n // 8)


def _hash(template: int, *values: np.ndarray) -> np.ndarray:
    out = np.full(len(values[0]), template + 1, np.uint64)
    for value in values:
        out = tx.mix(out * tx._BASE + value.astype(np.uint64))
    return out


def _read(chunk: tx.Chunk) -> _Words:
    """Words of a chunk and, for each distinct one, the hashes of its features."""
    data = chunk.data
    words = tx.words(chunk)
    _, first, kind = np.unique(words.hashes, return_index=True, return_inverse=True)
    doc = words.doc()
    line = np.searchsorted(np.flatnonzero(data == 10), words.starts)
    joined = np.zeros(len(doc), bool)
    joined[1:] = (doc[1:] == doc[:-1]) & (line[1:] == line[:-1])
    inner = np.concatenate([np.flatnonzero(~_IS_EDGE[data]), [len(data)]])
    low = inner[np.searchsorted(inner, words.starts)]
    bare = low >= words.ends
    low = np.where(bare, words.starts, low)
    high = np.where(bare, words.ends, inner[np.searchsorted(inner, words.ends) - 1] + 1)
    starts, ends = low[first], high[first]
    classes = _CLASS[data]
    change = np.ones(len(data), bool)
    change[1:] = classes[1:] != classes[:-1]
    change[starts] = True
    change = np.flatnonzero(change)
    shape = tx.range_hash(classes[change], np.searchsorted(change, starts), np.searchsorted(change, ends))
    digits = _sums(_IS_DIGIT[data])
    n_digits = _bucket((digits[ends] - digits[starts]).astype(np.int64))
    text = tx.range_hash(tx.LOWER[data], starts, ends)
    borders = classes[starts].astype(np.int64) * 16 + classes[np.maximum(ends - 1, 0)]
    own = [_hash(0, shape), _hash(1, shape, n_digits), _hash(2, n_digits), _hash(3, _bucket(ends - starts)), _hash(4, borders), _hash(5, text), _hash(6, bare[first])]
    beside = [_hash(7, shape), _hash(8, n_digits), _hash(9, text)]
    return _Words(low, high, kind, doc, joined, np.stack(own, 1), np.stack(beside, 1), text)


def _scores(words: _Words, model: Model) -> np.ndarray:
    """What the features say for each label of each word."""

    def total(hashes: np.ndarray, part: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(model.features, hashes), len(model.features) - 1)
        return (model.weights[at, part] * (model.features[at] == hashes)[..., None]).sum(1)

    own, before, after = total(words.own, 0), total(words.beside, 1), total(words.beside, 2)
    out = own[words.kind]
    then = np.flatnonzero(words.joined)
    out[then] += before[words.kind[then - 1]]
    out[then - 1] += after[words.kind[then]]
    return out


def viterbi(scores: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best labels of chains ``(chain, place, label)`` that begin and end beside label 0."""
    n, length, _ = scores.shape
    best = scores[:, 0] + steps[0]
    back = np.zeros(scores.shape, np.int8)
    for place in range(1, length):
        ways = best[:, :, None] + steps
        back[:, place] = ways.argmax(1)
        best = ways.max(1) + scores[:, place]
    out = np.zeros((n, length), np.int8)
    out[:, -1] = (best + steps[:, 0]).argmax(1)
    for place in range(length - 1, 0, -1):
        out[:, place - 1] = back[np.arange(n), place, out[:, place]]
    return out


def decode(scores: np.ndarray, joined: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The best label of each word; ``joined`` says which words follow the word before in one chain."""
    # However its neighbours are labelled, a word gains at most this much from another label than 0.
    gain = steps[:, 1:, None] + steps[None, 1:, :] - steps[:, :1, None] - steps[None, :1, :]
    open_words = np.flatnonzero(scores[:, 1:].max(1) + gain.max() >= scores[:, 0])
    labels = np.zeros(len(scores), np.int8)
    if not len(open_words):
        return labels
    new = np.ones(len(open_words), bool)
    new[1:] = (np.diff(open_words) > 1) | ~joined[open_words[1:]]
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(open_words)))
    for power in np.unique(np.ceil(np.log2(lengths)).astype(int)).tolist():
        width = 1 << power
        chosen = np.flatnonzero((lengths <= width) & (2 * lengths > width))
        each = max(1, (1 << 18) // width)
        for at in range(0, len(chosen), each):
            some = chosen[at : at + each]
            place = np.arange(width)
            real = place < lengths[some, None]
            index = open_words[np.minimum(starts[some, None] + place, len(open_words) - 1)]
            padded = np.where(real[..., None], scores[index], np.where(np.arange(scores.shape[1]), -1e9, 0.0))
            labels[index[real]] = viterbi(padded, steps)[real]
    return labels


def _holds(kind: int, found: str) -> bool:
    """Whether a span of the field has what its kind needs."""
    numbers = re.findall("[0-9]+", found)
    n = sum(map(len, numbers))
    if kind == 0:
        return bool(_ADDRESS.search(found))
    if kind == 1:
        return len(numbers) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in numbers)
    if kind == 2:
        return 12 <= n <= 19 and _luhn("".join(numbers).encode())
    return 7 <= n <= 15


def _added(chunk: tx.Chunk, model: Model, base: list) -> list[tuple[int, int, int, int]]:
    words = _read(chunk)
    if not len(words.kind):
        return []
    labels = decode(_scores(words, model), words.joined, model.steps)
    some = np.flatnonzero(labels)
    if not len(some):
        return []
    new = np.ones(len(some), bool)
    new[1:] = (np.diff(some) > 1) | (labels[some[1:]] != labels[some[:-1]]) | ~words.joined[some[1:]]
    first = some[new]
    last = some[np.append(np.flatnonzero(new)[1:], len(some)) - 1]
    taken = np.zeros(len(chunk.data) + 1, bool)
    for _, _, start, end in base:
        taken[start:end] = True
    covered = _sums(taken[:-1])
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        start, end, kind = int(words.starts[a]), int(words.ends[b]), int(labels[a]) - 1
        if end - start <= 200 and covered[end] == covered[start] and _holds(kind, chunk.data[start:end].tobytes().decode("utf-8", "replace")):
            out.append((int(words.doc[a]), kind, start, end))
    return out


def _listed(spans: list, chars: np.ndarray, row_start: np.ndarray, n: int) -> list[str]:
    """For each text, ``kind:start:end`` in code points, by start and then kind."""
    texts: list[list] = [[] for _ in range(n)]
    for row, kind, start, end in sorted(spans, key=lambda s: (s[0], s[2], s[1], s[3])):
        zero = row_start[row]
        texts[row].append(f"{KINDS[kind]}:{chars[start] - zero}:{chars[end] - zero}")
    return [",".join(t) for t in texts]


_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _find(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in tx.chunks(batch.column(1)):
                n = len(chunk.offsets) - 1
                base = base_spans(chunk)
                more = _added(chunk, model, base)
                chars = _sums(~tx.IS_TAIL[chunk.data])
                zero = chars[chunk.offsets[:-1]]
                counts = np.zeros((4, n), np.int64)
                for row, kind, _, _ in base:
                    counts[kind, row] += 1
                digests = [hashlib.sha256(t.encode()).hexdigest() for t in _listed(base, chars, zero, n)]
                rows = [batch.column(0).slice(chunk.first, n), *map(pa.array, counts), pa.array(digests, pa.string())]
                rows.append(pa.array(_listed(base + more, chars, zero, n), pa.string()))
                yield pa.RecordBatch.from_arrays(rows, ["doc_id", *(p.split()[0] for p in _FOUND.split(", "))])

    return run


def find(docs: DataFrame, model: Model, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the patterns' spans of each kind, their digest, and all spans, for every row of ``docs``.

    Spans are ``kind:start:end`` in code points, the end exclusive, by start
    and then in the order of ``KINDS``, joined by commas.
    """
    workers()
    texts = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return texts.mapInArrow(_find(model), f"doc_id long, {_FOUND}").withColumnRenamed("doc_id", doc)


# Training


def train(labelled: DataFrame, *, rounds: int = 60, rate: float = 0.2, shrink: float = 0.02) -> Model:
    """A model from rows (sentence, place, word, label), of which there may be at most ``MOST_WORDS``.

    Rows with a null are left out; labels are those of ``LABELS``. Of rows with
    the same sentence and place, all are words, in the order of their text.
    """
    rows = labelled.select("sentence", "place", "word", "label").dropna()
    table = rows.orderBy("sentence", "place", "word", "label").limit(MOST_WORDS + 1).toArrow()
    if len(table) > MOST_WORDS:
        raise ValueError(f"the labelled table has more than {MOST_WORDS} words")
    number, word, label = (table.column(c).to_pylist() for c in ("sentence", "word", "label"))
    sentences: dict = {}
    for key, w, y in zip(number, word, label, strict=True):
        sentences.setdefault(key, []).append(("".join(w.split()) or "-", LABELS.index(y)))
    return fit(list(sentences.values()), rounds=rounds, rate=rate, shrink=shrink)


def fit(sentences: list[list[tuple[str, int]]], *, rounds: int, rate: float, shrink: float) -> Model:
    """Weights of greatest likelihood less a penalty on their squares, by gradients over all sentences."""
    n_labels = len(LABELS)
    joined = "\n".join(" ".join(w for w, _ in s) for s in sentences)
    words = _read(next(tx.chunks(pa.array([joined]), len(joined.encode()) + 1), None) or tx.Chunk(0, np.zeros(0, np.uint8), np.zeros(2, np.int64)))
    hashes, often = np.unique(words.text[words.kind], return_counts=True)
    known = hashes[often >= LEAST_OFTEN]
    rare = ~np.isin(words.text, known)
    own, beside = words.own.copy(), words.beside.copy()
    own[rare, 5] = own[rare, 0]
    beside[rare, 2] = beside[rare, 0]
    features = np.unique(np.concatenate([own.ravel(), beside.ravel(), np.zeros(1, np.uint64)]))
    own, beside = np.searchsorted(features, own), np.searchsorted(features, beside)
    lengths = np.array([len(s) for s in sentences] or [1])
    n, width = len(lengths), int(lengths.max())
    real = np.arange(width) < lengths[:, None]
    index = np.zeros((n, width), np.int64)
    index[real] = np.arange(len(words.kind)) if sentences else 0
    gold = np.zeros((n, width), np.int64)
    gold[real] = [y for s in sentences for _, y in s] if sentences else 0
    kinds = words.kind[index] if sentences else index
    weights, steps = np.zeros((len(features), 3, n_labels)), np.zeros((n_labels, n_labels))
    model = Model(features, weights, steps, known)
    if not sentences:
        return model
    sums = [np.zeros_like(weights), np.zeros_like(steps)]
    one_hot = np.eye(n_labels)[gold] * real[..., None]
    follows = real[:, 1:]
    gold_steps = np.zeros_like(steps)
    np.add.at(gold_steps, (gold[:, :-1][follows], gold[:, 1:][follows]), 1)
    np.add.at(gold_steps, (np.zeros(n, int), gold[:, 0]), 1)
    np.add.at(gold_steps, (gold[np.arange(n), lengths - 1], np.zeros(n, int)), 1)
    for _ in range(rounds):
        per_kind = weights[own, 0].sum(1), weights[beside, 1].sum(1), weights[beside, 2].sum(1)
        scores = per_kind[0][kinds]
        scores[:, 1:] += per_kind[1][kinds[:, :-1]]
        scores[:, :-1] += per_kind[2][kinds[:, 1:]] * follows[..., None]
        chances, pairs = _expected(scores, steps, real, lengths)
        error = (one_hot - chances) * real[..., None]
        slope = np.zeros_like(weights)
        _spread(slope, 0, own, kinds[real], error[real])
        _spread(slope, 1, beside, kinds[:, :-1][follows], error[:, 1:][follows])
        _spread(slope, 2, beside, kinds[:, 1:][follows], error[:, :-1][follows])
        for value, up, total in ((weights, slope, sums[0]), (steps, gold_steps - pairs, sums[1])):
            up = up - shrink * value
            total += up * up
            value += rate * up / np.sqrt(total + 1e-8)
    return model


def _spread(slope: np.ndarray, part: int, features: np.ndarray, kinds: np.ndarray, error: np.ndarray) -> None:
    """Add each word's error to all features of its kind of word."""
    by_kind = np.zeros((len(features), error.shape[1]))
    np.add.at(by_kind, kinds, error)
    np.add.at(slope[:, part], features, by_kind[:, None, :])


def _expected(scores: np.ndarray, steps: np.ndarray, real: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chances of each label of each word and expected numbers of transitions, forwards and backwards."""
    n, width, _ = scores.shape

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + steps[0]
    for place in range(1, width):
        ahead[:, place] = total(ahead[:, place - 1, :, None] + steps, 1) + scores[:, place]
    behind[:] = steps[:, 0]
    for place in range(width - 2, -1, -1):
        on = total(steps + (scores[:, place + 1] + behind[:, place + 1])[:, None, :], 2)
        behind[:, place] = np.where((place < lengths - 1)[:, None], on, steps[:, 0])
    whole = total(ahead[:, 0] + behind[:, 0], 1)
    chances = np.exp(ahead + behind - whole[:, None, None])
    both = ahead[:, :-1, :, None] + steps + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[:, None, None, None]
    pairs = (np.exp(np.minimum(both, 0)) * real[:, 1:, None, None]).sum((0, 1))
    pairs[0] += chances[:, 0].sum(0)
    pairs[:, 0] += chances[np.arange(n), lengths - 1].sum(0)
    return chances, pairs


# A small labelled table by rule: invented sentences with personal data in many spellings, and numbers that are none

_SYLLABLES = "an be con der el fi ga her in jo ka lu mi no or pa que ra sen ti un ver wo zu ção ü é".split()
_TOPS = "com org net de fr es io".split()
_CUES = {
    0: ["mail", "email", "write", "to", "contact:", "from"],
    1: ["host", "server", "address", "ip", "at", "from"],
    2: ["card", "visa", "number", "paid", "with", "card:"],
    3: ["call", "phone", "tel", "tel.", "fax", "mobile:"],
}


def card_number(rng: random.Random, n: int = 16) -> str:
    """Digits that pass the check sum."""
    head = "".join(str(rng.randrange(10)) for _ in range(n - 1))
    return next(head + str(d) for d in range(10) if _luhn(f"{head}{d}".encode()))


def _word(rng: random.Random) -> str:
    return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))


def example(rng: random.Random, kind: int) -> list[str]:
    """The words of a piece of personal data, in one of its spellings."""
    d = lambda n: "".join(str(rng.randrange(10)) for _ in range(n))
    if kind == 0:
        name, host, top = f"{_word(rng)}{rng.choice(['', '.', '_'])}{d(rng.randint(0, 3))}".strip("._"), _word(rng) + d(rng.randint(0, 1)), rng.choice(_TOPS)
        more = rng.choice([[], [], ["example"]])
        parts = [host, *more, top]
        return rng.choice(
            [
                [f"{name}@{'.'.join(parts)}"],
                [f"{name}@{'.'.join(parts)}"],
                [name, "at", ".".join(parts)],
                [name, "[at]", ".".join(parts)],
                [f"{name}(at){'.'.join(parts)}"],
                [f"{name}[at]{'.'.join(parts)}"],
                [name, "at", *" dot ".join(parts).split()],
                [name, "(at)", *" (dot) ".join(parts).split()],
            ]
        )
    if kind == 1:
        parts = [str(rng.randrange(256)) for _ in range(4)]
        return [rng.choice([".", ".", "[.]", "(.)"]).join(parts)]
    if kind == 2:
        number = card_number(rng, rng.choice([16, 16, 16, 15]))
        groups = [number[:4], number[4:8], number[8:12], number[12:]]
        return rng.choice([[number], groups, ["-".join(groups)], [".".join(groups)], ["/".join(groups)]])
    a, b, c = d(3), d(3), d(4)
    return rng.choice(
        [
            [f"+{rng.randint(1, 99)}", f"({a})", f"{b}-{c}"],
            [f"+{rng.randint(1, 99)}-{a}-{b}-{c}"],
            [f"({a})", f"{b}-{c}"],
            [f"{a}-{b}-{c}"],
            [f"{a}.{b}.{c}"],
            [f"({a}){b}-{c}"],
            [f"00{rng.randint(10, 99)}", a, b + c],
        ]
    )


def _other(rng: random.Random) -> list[str]:
    """Words with digits or signs that are nobody's data."""
    d = lambda n: "".join(str(rng.randrange(10)) for _ in range(n))
    return rng.choice(
        [
            [str(rng.randint(1000, 2100))],
            [f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}"],
            [f"{rng.randint(1900, 2030)}-{d(2)}-{d(2)}"],
            [f"{rng.randint(0, 9)}.{rng.randint(0, 20)}"],
            [f"{rng.randint(0, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)}"],
            [f"v{rng.randint(0, 9)}.{d(1)}.{d(2)}-rc{d(1)}"],
            [f"{rng.randint(0, 23)}:{d(2)}"],
            [f"${rng.randint(1, 9)},{d(3)}.{d(2)}"],
            [f"{d(2)}-{d(3)}"],
            [f"{d(3)}-{d(4)}"],
            ["pages", f"{d(3)}-{d(3)}"],
            ["token", "=", f'"{rng.getrandbits(160):040x}"'],
            ["commit", f"{rng.getrandbits(160):040x}"],
            ["No.", d(rng.randint(1, 6))],
            [d(rng.randint(1, 9))],
            [f"{d(3)},{d(3)},{d(3)}"],
            ["ISBN", f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}"],
            [f"{_word(rng)}{rng.choice(['###', '$$$', '%%%', '&&&', '***', '!!'])}"],
            [f"@{_word(rng)}"],
            ["CC", "BY-NC", "4.0."],
            ["at", _word(rng)],
            ["dot", _word(rng)],
            [f"({_word(rng)})"],
            [f"{_word(rng)}-{_word(rng)}"],
            [f"{_word(rng)}.{rng.choice(_TOPS)}"],
            [_word(rng).upper(), "|", _word(rng), "|"],
        ]
    )


def sentences(n: int, seed: int) -> list[list[tuple[str, int]]]:
    """Sentences as lists of (word, label): about two in three hold personal data."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words: list[tuple[str, int]] = []

        def plain() -> None:
            for _ in range(rng.randint(0, 4)):
                word = _word(rng) + rng.choice(["", "", "", "", ",", "."])
                words.append((rng.choice([word, word, word.capitalize()]), 0))

        plain()
        for _ in range(rng.randint(0, 2)):
            kind = rng.randrange(4)
            if rng.random() < 0.4:
                words += [(w, 0) for w in rng.sample(_CUES[kind], rng.randint(1, 2))]
            found = example(rng, kind)
            found[-1] += rng.choice(["", "", "", ".", ",", "###", "!!"])
            words += [(w, kind + 1) for w in found]
            plain()
            words.append((_word(rng), 0))
        if rng.random() < 0.6:
            words += [(w, 0) for w in _other(rng)]
        plain()
        out.append(words or [(_word(rng), 0)])
    return out


def example_table(spark: SparkSession, n: int = 1000, seed: int = 11) -> DataFrame:
    """The labelled table (sentence, place, word, label) of invented sentences."""
    rows = [(i, j, w, LABELS[y]) for i, s in enumerate(sentences(n, seed)) for j, (w, y) in enumerate(s)]
    return spark.createDataFrame(rows, "sentence int, place int, word string, label string")
