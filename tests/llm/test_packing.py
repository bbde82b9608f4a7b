import zlib

import numpy as np
import pytest

from tabml.llm import packing
from tabml.llm.queries import QUERIES, byte_bpe

from ..conftest import SF001


def check(rows, texts, capacity=1024, end=2):
    """Every document is whole, piece by piece, and every sequence gapless."""
    slow = packing.Tokens(byte_bpe()[0]).slow
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    want = {}
    for i, t in texts:
        ids = np.array([*slow.encode(t or "", add_special_tokens=False).ids, end], "<u4")
        first = len(ids) % capacity or min(len(ids), capacity)
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want.setdefault(i, []).extend((k, x, y - x, zlib.crc32(ids[x:y].tobytes())) for k, (x, y) in enumerate(zip(cuts, cuts[1:])))
    assert {i: sorted(v) for i, v in want.items()} == {i: sorted((r.piece, r.start, r.length, r.ids_crc32) for r in v) for i, v in by_doc.items()}
    fill = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values(), default=0) <= capacity
    return len(fill), sum(fill.values())


def test_odd_documents(odd, odd_rows):
    rows = packing.pack_documents(odd, byte_bpe(), 2, pack_size=8).collect()
    check(rows, [(r[0], r[1]) for r in odd_rows])


def test_query_is_nearly_full(llm):
    rows = QUERIES["op4_packing"](llm, SF001).collect()
    n, total = check(rows, [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF001}/documents.parquet").collect()])
    assert n <= 1.05 * total / 1024 + 1


def test_empty_table(none):
    assert packing.pack_documents(none, byte_bpe(), 2).collect() == []


def test_sum_of_squares_places_where_the_sum_becomes_smallest():
    rng = np.random.default_rng(1)
    sizes, capacity = rng.integers(1, 20, 300), 20
    where = packing.sum_of_squares(sizes, capacity)
    fill = {}

    def squares(f):
        gaps = [capacity - x for x in f.values() if x < capacity]
        return sum(gaps.count(g) ** 2 for g in set(gaps))

    for s, w in zip(sizes.tolist(), where.tolist()):
        options = [squares({**fill, b: fill[b] + s}) for b in fill if fill[b] + s <= capacity] + [squares({**fill, -1: s})]
        fill[w] = fill.get(w, 0) + s
        assert fill[w] <= capacity and squares(fill) == min(options)


def test_beats_first_fit_and_nears_the_bound():
    sizes = np.random.default_rng(3).integers(1, 1024, 6000)
    where = packing.pack(sizes, 1024)
    assert np.bincount(where, sizes).max() <= 1024
    assert where.max() + 1 <= 1.02 * sizes.sum() / 1024


@pytest.mark.parametrize("text", ["it's 12\n\n  x ", "naïve Œuvre", "<|endoftext|> a", "漢字 x", "a\x85b\xa0c", ""])
def test_both_libraries_agree(text):
    t = packing.Tokens(*byte_bpe())
    assert t.ids(text).tolist() == t.slow.encode(text, add_special_tokens=False).ids


def test_rows_without_an_id_are_dealt_out_like_others(llm):
    """A third of the rows without an id, a third with one id: no pack holds more than its size."""
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, "word " * (i % 40)) for i in range(3000)]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    out = packing.pack_documents(df, byte_bpe(), 2, capacity=64, pack_size=256).collect()
    assert len(out) == 3000
    fill = {}
    for r in out:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 64 and len(fill) <= 1.05 * sum(fill.values()) / 64 + 1


def test_any_fit_opens_a_sequence_only_where_nothing_fits():
    rng = np.random.default_rng(2)
    sizes = np.sort(rng.integers(1, 60, 400))[::-1]
    where, fill = packing.sum_of_squares(sizes, 64, any_fit=True), {}
    for s, w in zip(sizes.tolist(), where.tolist()):
        if w not in fill:
            assert all(f + s > 64 for f in fill.values())
        else:
            def squares(f):
                gaps = [64 - x for x in f.values() if x < 64]
                return sum(gaps.count(g) ** 2 for g in set(gaps))
            assert squares({**fill, w: fill[w] + s}) == min(squares({**fill, b: f + s}) for b, f in fill.items() if f + s <= 64)
        fill[w] = fill.get(w, 0) + s
    assert max(fill.values()) <= 64
