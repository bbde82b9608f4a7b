import numpy as np
import pytest

from tabml.llm import embedding_dedup
from tabml.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, x string, cell string"


def brute(rows, threshold=0.93):
    def sound(v):
        return v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)

    n = [0] * len(rows)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    vec = [np.array(v, np.float64) if sound(v) and i is not None and y is not None else None for i, v, y, *_ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if vec[a] is not None and vec[b] is not None and rows[a][2] == rows[b][2] and len(vec[a]) == len(vec[b]):
                if vec[a] @ vec[b] / np.sqrt(vec[a] @ vec[a]) / np.sqrt(vec[b] @ vec[b]) >= threshold:
                    n[a] += 1
                    n[b] += 1
                    root[find(a)] = find(b)
    out = []
    for a in range(len(rows)):
        least = min((rows[b][0] for b in range(len(rows)) if find(b) == find(a)), key=lambda v: (v is None, v))
        out.append((rows[a][0], n[a], least, rows[a][0] is not None and rows[a][0] == least))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = []
    for label in (0, 1, 2, None):
        for c in rng.normal(size=(6, 8)):
            for k in range(rng.integers(1, 14)):
                v = c + rng.normal(size=8) * rng.choice([0, 0.05, 0.15, 0.3])
                out.append([float(np.float32(x)) for x in v * rng.choice([1, 2.5])] + [label])
    rows = [(7 * i % 1009, v[:-1], v[-1], "clash", "clash") for i, v in enumerate(out)]
    odd = [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, [1e-30] * 8, [1e30] * 8, [1.0] * 4, [2.0] * 4]
    rows += [(2000 + i, v, 0, None, None) for i, v in enumerate(odd)]
    return rows + [rows[0], rows[1], (None, rows[0][1], rows[0][2], None, None), (None, None, None, None, None)]


@pytest.mark.parametrize(("cell", "block"), [(2048, 2048), (6, 2048), (6, 3)])
def test_any_cells_and_blocks_give_all_links(llm, rows, cell, block):
    df = llm.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted(map(tuple, embedding_dedup.embedding_groups(df, cell=cell, block=block).collect()), key=str)
    assert got == brute(rows)


def test_without_label_and_empty(llm):
    df = llm.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, embedding_dedup.embedding_groups(df, label_col=None).collect()))
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert embedding_dedup.embedding_groups(llm.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        embedding_dedup.embedding_groups(df, threshold=1.5)


def test_query_against_brute_force(llm):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in llm.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, QUERIES["op8_embeddings"](llm, d).collect()), key=str) == brute(rows)


def test_vectors_of_equal_hash_stay_apart(llm):
    one, two, end, top = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5, (1 << 64) - 1
    bits = lambda x: int(np.float64(x).view(np.uint64))
    turn = lambda x, k: (x << k | x >> 64 - k) & top
    pairs = [(1.0, 0.5), *((-1.0 - k / 1000, 1.0) for k in range(4000))]
    seeds = [r.h % (1 << 64) for r in llm.createDataFrame(pairs, "x double, y double").selectExpr("xxhash64(array(x)) h").collect()]
    # xxhash64 of a long can be solved for the long: a second component that gives the hash of the first pair
    want = (seeds[0] + end + 8) & top ^ turn(bits(0.5) * two & top, 31) * one & top
    for (x, _), seed in zip(pairs[1:], seeds[1:], strict=True):
        k1 = want ^ (seed + end + 8) & top
        y = float(np.uint64(turn(k1 * pow(one, -1, 1 << 64) & top, 33) * pow(two, -1, 1 << 64) & top).view(np.float64))
        if 1e-3 < abs(y) < 1e3:
            break
    df = llm.createDataFrame([(1, [1.0, 0.5], 0), (2, [x, y], 0)], "vec_id long, embedding array<double>, label int")
    assert df.selectExpr("xxhash64(embedding) h").distinct().count() == 1
    assert sorted(map(tuple, embedding_dedup.embedding_groups(df, threshold=0.999).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_centres_are_spherical_means(llm, monkeypatch):
    """The distributed rounds against loops over the same vectors, in parts of a few products."""
    monkeypatch.setattr(embedding_dedup, "PRODUCTS", 7)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 5))
    start = x[:4] / np.linalg.norm(x[:4], axis=1, keepdims=True)
    df = llm.createDataFrame([(3, 5, list(map(float, v))) for v in x], "label long, dim int, x array<double>").repartition(5)
    got = embedding_dedup.spherical_kmeans(df, {(3, 5): start}, rounds=3)[3, 5]
    want, unit = start, x / np.linalg.norm(x, axis=1, keepdims=True)
    for _ in range(3):
        home = (unit @ want.T).argmax(1)
        want = np.array([unit[home == k].sum(0) if (home == k).any() else want[k] for k in range(4)])
        want /= np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(got, want)


def test_cells_are_fitted_to_about_their_number(llm):
    rng = np.random.default_rng(9)
    rows = [(int(k % 10 == 0), 4, k, list(map(float, rng.normal(size=4)))) for k in range(3000)]
    df = llm.createDataFrame(rows, "label long, dim int, v long, x array<double>").repartition(3)
    centres = embedding_dedup.fit_centres(df, cell=400)
    assert {k: len(c) for k, c in centres.items()} == {(0, 4): 7}  # 2700 vectors of one label, 300 of the other
    assert embedding_dedup.fit_centres(df.limit(0)) == {} == embedding_dedup.fit_centres(df, cell=5000)
