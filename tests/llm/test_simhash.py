import random
from itertools import combinations

import pytest
import xxhash

from tabml.llm import components, simhash
from tabml.llm.queries import QUERIES

from ..conftest import SF001


def plain(text, n=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    shingles = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(pairs_of, ids, near):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(len(ids)), 2):
        if near(pairs_of[a], pairs_of[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    out = {}
    for i in range(len(ids)):
        known = [ids[j] for j in range(len(ids)) if find(j) == find(i) and ids[j] is not None]
        out[i] = min(known) if known else None
    return out


def check(df, rows, **args):
    got = sorted(map(tuple, simhash.simhash_groups(df, **args).collect()), key=str)
    fps, ids = [plain(t) for _, t in rows], [i for i, _ in rows]
    comp = groups(fps, ids, lambda a, b: (a ^ b).bit_count() <= args.get("max_bits", 4))
    assert got == sorted(((ids[i], f"{fps[i]:016x}", comp[i]) for i in range(len(ids))), key=str)


def test_odd_documents(odd, odd_rows):
    check(odd, [(r[0], r[1]) for r in odd_rows])


def test_query_against_brute_force(llm):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF001}/documents.parquet").collect()]
    fps, ids = [plain(t) for _, t in rows], [i for i, _ in rows]
    comp = groups(fps, ids, lambda a, b: (a ^ b).bit_count() <= 4)
    assert {tuple(r) for r in QUERIES["op7_simhash"](llm, SF001).collect()} == {(ids[i], f"{fps[i]:016x}", comp[i]) for i in range(len(ids))}


def test_empty_table(none):
    assert simhash.simhash_groups(none).collect() == []


@pytest.mark.parametrize("bits", range(8))
def test_position_sets_cover(bits):
    sets = [set(s) for s in simhash.position_sets(bits)]
    for kept in combinations(range(8), 8 - bits):
        assert any(s <= set(kept) for s in sets)


@pytest.mark.parametrize(("bits", "block"), [(4, 16384), (4, 7), (2, 5), (6, 16384)])
def test_links_of_dense_and_long_lists(llm, bits, block):
    rng = random.Random(bits)
    centres = [rng.getrandbits(64) for _ in range(12)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centres for _ in range(25)}
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(100)})
    signed = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)]
    prints = llm.createDataFrame(signed, "fp long, v long")
    found = dict(map(tuple, components.components(simhash.links(prints, bits, block)).collect()))
    want = groups(fps, list(range(len(fps))), lambda a, b: (a ^ b).bit_count() <= bits)
    assert {i: found.get(i, i) for i in range(len(fps))} == want


def test_components_of_paths_stars_and_loops(llm):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(100, 180)]
    rng.shuffle(path)
    edges = path + [(300, 200 + i) for i in range(60)] + [(5, 5), (7, None), (900, 901), (901, 900)]
    got = dict(map(tuple, components.components(llm.createDataFrame(edges, "a long, b long").repartition(6)).collect()))
    assert got == {**{i: 100 for i in range(101, 181)}, **{i: 200 for i in [*range(201, 260), 300]}, 901: 900}
    assert components.components(llm.createDataFrame([], "a long, b long")).collect() == []


def test_bits_are_tested_on_pairs_with_enough_shared_bytes_alone(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(4)
    fp = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    fp[::2] = fp[1::2] ^ np.uint64(0b11 << 20)
    fp[100:600] = (fp[100] & np.uint64(0xFFFFFF)) | (fp[100:600] << np.uint64(24))  # a list that shares three bytes
    x = fp[:-1] ^ fp[1:]
    want = np.array([bin(int(v)).count("1") <= 4 for v in x])
    shared = np.array([sum((int(v) >> 8 * k & 255) == 0 for k in range(8)) for v in x])
    assert (8 - simhash._different_bytes(x) == shared).all()
    tested = []
    real = simhash._within
    monkeypatch.setattr(simhash, "_within", lambda v, k: tested.append(len(v)) or real(v, k))
    assert (simhash._near(x, 4) == want).all()
    assert sum(tested) == (shared >= 4).sum() < len(x) * 0.7 and (shared[want] >= 4).all()
    # a list whose pairs share three bytes each: the tally leaves few of them
    tested.clear()
    simhash._links(np.zeros(500, np.int64), fp[100:600], np.arange(500), 4)
    assert sum(tested) < 0.1 * 500 * 499 / 2
