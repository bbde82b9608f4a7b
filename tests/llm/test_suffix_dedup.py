import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tabml.llm import suffix_array, suffix_dedup
from tabml.llm.queries import QUERIES

from ..conftest import SF001


def brute(rows, window=50):
    """(id, n_bytes, spans, kept) by sets of strings; null ids last; equal ids don't remove from each other."""
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for s in range(len(b) - window + 1):
            k = b[s:s + window]
            first[k] = min(first.get(k, (1, 0)), (0, i) if i is not None else (1, 0))
    out = []
    for i, b in data:
        own = (0, i) if i is not None else (1, 0)
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - window + 1):
            if first[b[s:s + window]] < own:
                gone[s:s + window] = True
        turn = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(int)))
        out.append((i, len(b), [(int(x), int(y)) for x, y in zip(turn[::2], turn[1::2])], bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def as_set(rows):
    return sorted(((i is None, i or 0, n, str(s), hashlib.sha256(bytes(k)).hexdigest()) for i, n, s, k in rows))


@pytest.mark.parametrize("size", [1500, 1 << 22])
def test_odd_documents(odd, odd_rows, size):
    got = suffix_dedup.remove_repeats(odd, batch_bytes=size).collect()
    assert as_set([(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept) for r in got]) == as_set(brute([(r[0], r[1]) for r in odd_rows]))
    assert {r.row.batch for r in got} == {"clash", None}


@pytest.mark.parametrize("hot", [1, 3])
def test_split_anchors_give_the_same(odd, odd_rows, hot):
    got = suffix_dedup.remove_repeats(odd, batch_bytes=1500, hot=hot).collect()
    assert as_set([(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept) for r in got]) == as_set(brute([(r[0], r[1]) for r in odd_rows]))


def hot_texts(n):
    """A third of the texts hold one phrase of the length of a seed, whose hash is small, in surroundings of their own."""
    rng = random.Random(3)
    letters = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k)).encode()
    seeds = [letters(20) for _ in range(4000)]
    seed = min(seeds, key=lambda b: int(suffix_dedup.hashes(np.frombuffer(b + bytes(1), np.uint8))[0]))
    return [letters(60) + (seed if i % 3 == 0 else b"") + letters(60) for i in range(n)]


def groups(texts, hot, batches=4, buckets=16, window=50):
    """Contexts of each task that sorts, by the steps of the operator."""
    held = [pa.record_batch([pa.array([k]), pa.array([list(range(k, len(texts), batches))]), pa.array([texts[k::batches]])], ["batch", "ids", "texts"]) for k in range(batches)]
    anchors = pa.Table.from_batches(suffix_dedup._anchor_rows(window, buckets)(iter(held))).to_pandas()
    shared = suffix_dedup._shared_bits(hot, window)
    bits = pa.concat_tables([shared(pa.Table.from_pandas(x)) for _, x in anchors.groupby("bucket")]).to_pandas()
    size = {}
    for k in range(batches):
        of = bits[bits["batch"] == k]
        c = suffix_dedup.Contexts(texts[k::batches], dict(zip(of["bucket"], of["bits"])), dict(zip(of["bucket"], of["splits"])), window, buckets)
        for g in c.bucket.tolist():
            size[g] = size.get(g, 0) + 1
    return size


def test_a_hot_anchor_is_split():
    texts = hot_texts(6000)
    whole, split = groups(texts, 1 << 16), groups(texts, 100)
    assert max(whole.values()) >= 2000  # all surroundings of the phrase in one task
    assert len(split) > 16
    for hot in (200, 1000):
        size = groups(texts, hot)
        assert max(n for g, n in size.items() if g >= 16) <= 1.4 * hot and max(n for g, n in size.items() if g < 16) <= 200


def test_hot_anchor_against_brute_force(llm):
    texts = hot_texts(900)
    texts = [(i, (t + texts[i // 2] if i % 5 == 0 else t).decode()) for i, t in enumerate(texts)]
    df = llm.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = suffix_dedup.remove_repeats(df, batch_bytes=20_000, hot=16).collect()
    assert as_set([(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept) for r in got]) == as_set(brute(texts))


def test_other_window(odd, odd_rows):
    got = suffix_dedup.remove_repeats(odd, window=24).collect()
    assert as_set([(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept) for r in got]) == as_set(brute([(r[0], r[1]) for r in odd_rows], 24))
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(odd, window=10)


def test_empty_table(none):
    assert suffix_dedup.remove_repeats(none).collect() == []


def test_query_against_brute_force(llm):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = {(i, n, sum(y - x for x, y in s), len(s), hashlib.sha256(k).hexdigest()) for i, n, s, k in brute(rows)}
    assert {tuple(r) for r in QUERIES["op1_suffix_dedup"](llm, SF001).collect()} == want


@pytest.mark.parametrize("seed", range(30))
def test_two_stage_order(seed):
    rng = np.random.default_rng(seed)
    n, depth = int(rng.integers(1, 250)), 50
    t = rng.integers(0, rng.integers(1, 5), n).astype(np.uint8)
    if seed % 3 == 0:
        t = np.concatenate([np.full(70, 3, np.uint8), t, np.full(120, 3, np.uint8), t])
    text = np.concatenate([t, np.zeros(depth + 8, np.uint8)])
    wanted = np.zeros(len(text), bool)
    wanted[:len(t)] = rng.random(len(t)) < 0.7
    order = suffix_array.two_stage(text, wanted, depth)
    starts = [text[i:i + depth].tobytes() for i in order]
    assert sorted(order) == list(np.flatnonzero(wanted)) and starts == sorted(starts)
    lcp = suffix_array.common_prefixes(text, order, depth)
    for k in range(1, len(order)):
        same = next((j for j in range(depth) if starts[k - 1][j] != starts[k][j]), depth)
        assert lcp[k] == same


def test_buckets_get_even_shares_of_the_anchors():
    """An anchor is the smallest hash of its window, so anchors crowd at the low end of the hashes."""
    rng = random.Random(8)
    keys = suffix_dedup.Runs([bytes(rng.choices(range(97, 123), k=60_000)) for _ in range(4)], 50).keys(64)
    share = np.bincount((keys >> np.uint64(40)).astype(np.int64), minlength=64)
    assert len(keys) > 10_000 and share.max() < 1.5 * share.mean() and share.min() > 0.5 * share.mean()


def test_buckets_grow_with_the_text_whatever_the_partitions(odd, odd_rows, monkeypatch):
    used, real = [], suffix_dedup._anchor_rows
    monkeypatch.setattr(suffix_dedup, "_anchor_rows", lambda window, buckets: used.append(buckets) or real(window, buckets))
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 300)
    got = suffix_dedup.remove_repeats(odd, batch_bytes=1500).collect()
    assert used == [-(-sum(len((r[1] or "").encode()) for r in odd_rows) // 300)] and used[0] > suffix_dedup.BUCKETS * suffix_dedup.shuffle_partitions(odd.sparkSession)
    assert as_set([(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept) for r in got]) == as_set(brute([(r[0], r[1]) for r in odd_rows]))
