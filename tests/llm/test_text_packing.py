import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from namepulse.llm import packing, queries
from namepulse.llm import text as tx
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_words_are_found_in_chunks_and_pieces(piece):
    texts = [*ODD, "one two", "three\nfour  five", "end"]
    found = []
    for chunk in tx.chunks(pa.array(texts), 40):
        words = tx.words(chunk, piece=piece)
        for row in range(len(chunk.offsets) - 1):
            part = slice(words.bounds[row], words.bounds[row + 1])
            found.append([chunk.data[a:b].tobytes().decode() for a, b in zip(words.starts[part], words.ends[part], strict=True)])
            assert len(set(words.hashes[part])) == len(set(found[-1]))
    assert found == [WORD.findall(t or "") for t in texts]


def test_lines_and_windows():
    chunk = next(tx.chunks(pa.array(["a\nb\n", "", "\nc d e"])))
    starts, ends, bounds = tx.lines(chunk)
    assert [chunk.data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)] == [b"a", b"b", b"", b"", b"", b"c d e"]
    assert list(bounds) == [0, 3, 4, 6]
    assert list(tx.windows(tx.words(chunk), 2)[1]) == [0, 2, 2]


def check(df, ids, width):
    rows = df.toPandas()
    at = dict.fromkeys(ids, 0)
    for r in rows.sort_values(["doc_id", "start"]).itertuples():
        assert at[r.doc_id] == r.start and r.doc_tokens == len(ids[r.doc_id])
        at[r.doc_id] += r.length
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert at == {k: len(v) for k, v in ids.items()}
    sizes = []
    for _, part in rows.sort_values("offset").groupby("sequence_id"):
        assert list(part.offset) == [0, *part.length.cumsum()[:-1]]
        sizes.append(part.length.sum())
    assert max(sizes) <= width and sum(s < width for s in sizes) <= 1


def test_every_id_is_packed_once_with_one_short_window(table, clashing):
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.tokenizer_file()
    random.seed(3)
    texts = [*ODD, *(" ".join(random.choice(["the", "Über-cat's", "x1", "<|endoftext|>"]) for _ in range(random.randrange(90))) for _ in range(60))]
    whole = tokenizers.Tokenizer.from_file(path)
    ids = {i: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in enumerate(texts)}
    check(packing.pack_tokens(clashing(table(texts)), path, width=64, open_windows=3, merge_ways=2), ids, 64)


def test_empty_table(table):
    assert packing.pack_tokens(table([]), queries.tokenizer_file()).count() == 0


def test_open_windows_are_bounded_and_the_best_fit_is_taken():
    docs = [(i, b"\0" * (4 * n), 0, n) for i, n in enumerate([6, 3, 4, 9, 1])]
    windows = list(packing.pack(iter(docs), 10, 2))
    assert [w.size for w in windows] == [10, 10, 3]
    assert [(d[0], s, n) for d, s, n in windows[0].pieces] == [(0, 0, 6), (1, 0, 3), (3, 0, 1)]
