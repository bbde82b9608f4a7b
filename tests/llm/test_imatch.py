import hashlib
import math
import re
from collections import Counter

import pytest

from tabml.llm import imatch
from tabml.llm.queries import QUERIES

from ..conftest import SF001


def neighbours(rows):
    """(row, text of the next): falling id, nulls last, after the last the first; of equal ids any order."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    return [(r, order[(k + 1) % len(order)][1] or "") for k, r in enumerate(order)]


def edited(text, after):
    text = text or ""
    half = len(text) // 2
    return hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()


def test_odd_documents_with_distinct_ids(llm, odd_rows):
    rows = [(k, r[1], *r[2:]) for k, r in enumerate(odd_rows)][::-1]
    rows = [((r[0] * 7919) % 100_003 - 50_000, *r[1:]) for r in rows]
    rows[0] = (None, *rows[0][1:])
    df = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, parts string, bucket string, guest string, h string").repartition(6)
    got = {r.doc_id: r for r in imatch.fingerprint_edits(df).collect()}
    assert len(got) == len(rows)
    same = {}
    for r, after in neighbours([(r[0], r[1]) for r in rows]):
        g = got[r[0]]
        assert g.n_chars == len(r[1] or "") and g.edited_sha256 == edited(r[1], after)
        assert 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
        assert same.setdefault(r[1] or "", g.fingerprint) == g.fingerprint


def test_repeated_ids_and_rows(odd, odd_rows):
    got = imatch.fingerprint_edits(odd).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in odd_rows)


def test_few_documents(llm, none):
    assert imatch.fingerprint_edits(none).collect() == []
    one = imatch.fingerprint_edits(llm.createDataFrame([(5, "abcd")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in one] == [(5, hashlib.sha256(b"abab").hexdigest(), 1.0)]


def test_lexicon_is_the_band(llm):
    texts = [(i, " ".join(["all", f"half{i % 2}", f"few{i % 25}", f"one{i}"])) for i in range(100)]
    df = llm.createDataFrame(texts, "doc_id long, text string")
    known = set(imatch.lexicon(df, band=(0.5, 3.5)))
    hashes = {r.w: r.h for w in ("all", "half0", "few3", "one7") for r in llm.sql(f"select '{w}' w, xxhash64('{w}') h").collect()}
    assert {w: h in known for w, h in hashes.items()} == {"all": False, "half0": True, "few3": True, "one7": False}


@pytest.fixture(scope="module")
def found(llm):
    return QUERIES["op10_imatch"](llm, SF001).collect()


def test_query_edits(llm, found):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = {r.doc_id: r for r in found}
    assert all(got[r[0]].edited_sha256 == edited(r[1], after) and got[r[0]].n_chars == len(r[1]) for r, after in neighbours(rows))


def test_edits_are_nearer_than_other_documents(found):
    assert sum(r.near_edited > r.near_next for r in found) / len(found) > 0.9
    assert sum(r.near_next for r in found) / len(found) < 0.1


def test_native(llm):
    plan = QUERIES["op10_imatch"](llm, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_hot_ids_are_dealt_out(llm):
    """A third of the rows without id, a third of one id and of few texts: every row has the next one's text, no bucket holds an id's rows together."""
    rows = [(None, f"free words number {k} of none") for k in range(300)] + [(7, f"copy {k % 3} of seven") for k in range(300)] + [(k + 10, f"own text {k} here") for k in range(300)]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = imatch.fingerprint_edits(df).collect()
    hashes = {r.t: r.h for r in llm.createDataFrame([(t,) for t in {t for _, t in rows}], "t string").selectExpr("t", "xxhash64(t) h").collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]], r[1]))
    want = [(r[0], edited(r[1], order[(k + 1) % len(order)][1])) for k, r in enumerate(order)]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.edited_sha256)) for r in got)
    keyed = df.selectExpr("coalesce(doc_id, -9223372036854775807L - 1L) k", "xxhash64(text) th")
    bounds, hot = imatch._bounds(keyed, 8)
    assert hot.keys() == {7, -(1 << 63)}
    sizes = keyed.withColumn("bucket", imatch._bucket(bounds, hot)).filter("k < 0").groupBy("bucket").count().collect()
    assert max(r["count"] for r in sizes) < 60


def test_one_id_and_one_text(llm):
    got = imatch.fingerprint_edits(llm.createDataFrame([(3, "abcd")] * 50, "doc_id long, text string")).collect()
    assert [r.edited_sha256 for r in got] == [hashlib.sha256(b"abab").hexdigest()] * 50 and {r.near_next for r in got} == {1.0}


def test_fingerprints_against_python(llm, found):
    """Lexicon, subsets and hashes of sf0.001 by loops over its words."""
    texts = {r.doc_id: r.text or "" for r in llm.read.parquet(f"{SF001}/documents.parquet").collect()}
    terms = {d: set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())) for d, t in texts.items()}
    low, high = max(imatch.LEAST_DOCS, math.ceil(len(texts) * math.exp(-imatch.IDF_BAND[1]))), math.floor(len(texts) * math.exp(-imatch.IDF_BAND[0]))
    df = Counter(w for ws in terms.values() for w in ws)
    every = llm.createDataFrame([(w,) for w in df], "w string").selectExpr("w", "xxhash64(w) h").collect()
    h = {r.w: r.h for r in every if low <= df[r.w] <= high}
    wanted = {}
    for d, ws in terms.items():
        subsets = []
        for one_of, n, skip in imatch.RATES:
            for k in range(n):
                subsets.append(frozenset(h[w] for w in ws if w in h and (h[w] >> skip) % one_of == k))
        wanted[d] = subsets
    prints = {r.doc_id: r.fingerprint for r in found}
    for d, subsets in wanted.items():
        if not any(subsets):
            assert prints[d].startswith("text:")
        else:
            assert [prints[d][4 * k:4 * k + 4] == "----" for k in range(len(subsets))] == [not s for s in subsets]
    # one hash for each set of terms, and different ones for different sets but for 16-bit chance
    by_set = {}
    for d, subsets in wanted.items():
        for k, s in enumerate(subsets):
            if s:
                by_set.setdefault((k, s), set()).add(prints[d][4 * k:4 * k + 4])
    assert all(len(v) == 1 for v in by_set.values())
    # the next document's likeness is the share of equal subsets among those that either has terms in
    order = sorted(texts, reverse=True)
    near = {r.doc_id: r.near_next for r in found}
    for i, d in enumerate(order):
        after = order[(i + 1) % len(order)]
        a, b = (prints[x] for x in (d, after))
        if a.startswith("text:") or b.startswith("text:"):
            assert near[d] == float(a == b)
            continue
        pairs = [(a[j:j + 4], b[j:j + 4]) for j in range(0, len(a), 4)]
        either = sum(p != ("----", "----") for p in pairs)
        assert near[d] == pytest.approx(1.0 if a == b else sum(x == y != "----" for x, y in pairs) / either)
