import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabml.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, words string, f string, h string, n string, rank string"


def plain(rows, least, longest=4, percent=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], a)
        scored = []
        for p, a in often.items():
            if 100 * inside[p] >= percent * a:
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def table(llm, rows):
    return llm.createDataFrame([(None, t, lang, "clash", "clash", "clash", "clash", "clash", "clash") for t, lang in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("least", [2, 30])
def test_odd_documents(odd, odd_rows, least):
    assert got(collocations.collocations(odd, least)) == plain([(r[1], r[2]) for r in odd_rows], least)


@pytest.mark.parametrize(("least", "longest", "percent", "top"), [(3, 4, 80, 2000), (5, 3, 50, 10), (8, 5, 100, 2000), (1, 2, 80, 7)])
def test_against_brute_force(llm, least, longest, percent, top):
    """Ties, overlaps (a a a), breaks of every kind, equal texts in several languages."""
    rng = random.Random(least)
    marks = [" ", "  ", "\t", " ", " ", ", ", ".", "\n", "\x0b", "? ", "; x"]
    rows = []
    for i in range(150):
        text = "".join(rng.choice(["a", "a", "b", "of the", "É", "New York", "|"]) + rng.choice(marks) for _ in range(rng.randint(0, 25)))
        rows += [(text, rng.choice(["en", "de", None, "und"]))] * rng.choice([1, 1, 3])
    rows += [(None, "en"), ("", None), (" \t.,", "xx"), ("alone", "yy")]
    assert got(collocations.collocations(table(llm, rows), least, longest, percent, top=top)) == plain(rows, least, longest, percent, top)


def test_one_language_with_a_phrase_in_a_third_of_the_rows(llm):
    rows = [(f"the quick brown fox {i} jumps" if i % 3 == 0 else f"the lazy dog {i % 7}", "en") for i in range(900)]
    assert got(collocations.collocations(table(llm, rows))) == plain(rows, 30)


def test_nothing_frequent(none, llm):
    assert collocations.collocations(none).collect() == []
    assert collocations.collocations(table(llm, [("a b c", "en"), (None, None)])).collect() == []


def test_counts_beyond_64_bits_of_the_product(llm):
    big = 1 << 60
    row = llm.range(1).selectExpr(f"cast(cast({big} as decimal(20, 0)) * 2000000 div cast({big} + {big - 2} as decimal(20, 0)) as bigint) as score").first()
    assert row.score == 2000000 * big // (2 * big - 2)


def test_words_with_equal_hashes_take_another_seed(llm, monkeypatch):
    """Ten words under a few bits: seeds are tried until all frequent words differ."""
    real, tried = collocations._spell, []
    monkeypatch.setattr(collocations, "_spell", lambda sieve, seed, bits: tried.append((seed, bits)) or real(sieve, seed, bits))
    monkeypatch.setattr(collocations, "SPARE_BITS", -3)
    rows = [("ab cd ef gh ij kl mn op qr st ab cd ef gh ij kl", "en")] * 3
    assert got(collocations.collocations(table(llm, rows), 2)) == plain(rows, 2)
    assert len(tried) > 1 and all(b < 8 for _, b in tried)


def test_counts_travel_packed():
    """A block's counts are a row for each bucket, of a few bytes a group, whatever the number of its groups."""
    rng = np.random.default_rng(3)
    h = np.unique(rng.integers(0, 1 << 63, 50_000).astype(np.uint64))
    n = rng.integers(1, 4, len(h))
    mark = collocations._mark(h << np.uint64(1))
    sent = collocations._parcels(mark, [mark], n, 3)
    assert sent.num_rows == 3 and sum(sent.column("size").to_pylist()) == len(h)
    assert sum(len(c) for r in sent.column("columns").to_pylist() for c in r) < 4 * len(h)


def test_buckets_add_up_to_the_exact_counts():
    """Blocks that share keys, keys that share a mark: each key of a bucket once, with all its occurrences."""
    rng = np.random.default_rng(4)
    want, sent = Counter(), []
    for _ in range(4):
        ids = np.unique(rng.integers(0, 9, (60, 2)).astype(np.uint64) << np.uint64(59), axis=0)
        n = rng.integers(1, 40, len(ids))
        want.update(dict(zip(map(tuple, ids.tolist()), n.tolist())))
        mark = np.where(ids[:, 0] < ids[0, 0] + (5 << 59), 7, 0xFFFFFFFF).astype(np.uint32)
        sent.append(collocations._parcels(mark, list(ids.T), n, 2))
    table = pa.Table.from_batches(sent)
    got = {}
    for bucket in (0, 1):
        out = collocations._often(np.uint64, ["w0", "w1"], 50)(table.filter(pa.array([b == bucket for b in table.column("bucket").to_pylist()])))
        for w0, w1, f in zip(*(out.column(c).to_pylist() for c in ("w0", "w1", "f"))):
            assert (w0 % (1 << 64), w1 % (1 << 64)) not in got
            got[w0 % (1 << 64), w1 % (1 << 64)] = f
    assert got == {k: f for k, f in want.items() if f >= 50} and got


def test_many_buckets(llm, monkeypatch):
    monkeypatch.setattr(collocations, "BUCKET", 20)
    rng = random.Random(9)
    rows = [(" ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 30))), rng.choice(["en", None])) for _ in range(80)]
    assert got(collocations.collocations(table(llm, rows), 4)) == plain(rows, 4)


def test_a_file_of_a_relation_holds_few_blocks(llm, monkeypatch):
    """Parquet's reader has thousands of rows of a file in memory, and a block is megabytes."""
    kept, real = {}, collocations.stored
    monkeypatch.setattr(collocations, "stored", lambda df, name, **how: kept.update({name: real(df, name, **how)}) or kept[name])
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 100)
    docs = llm.createDataFrame([(i, "en", "a b c d e f g h. " * 8) for i in range(90)], "doc_id long, lang string, text string").coalesce(1)
    assert {r.a for r in collocations.collocations(docs).collect()} == {720}
    for name in ("setm-words", "setm-1", "setm-2", "setm-3"):
        files = [r["count"] for r in kept[name].groupBy(F.input_file_name()).count().collect()]
        assert sum(files) > 40 and max(files) <= collocations.PER_FILE
