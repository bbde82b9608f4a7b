import math
import re

from tabml.llm import licenses
from tabml.llm.queries import QUERIES

from ..conftest import SF001

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(licenses.WORD, (text or "").translate(LOW))


def brute(rows, rare=3, least=0.6):
    """Every template at every place, without an index."""
    docs = [(i, words(t)) for i, t in rows]
    bodies = [t.text.split() for t in licenses.TEMPLATES]
    df = {w: sum(w in set(d) for _, d in docs) for b in bodies for w in b}
    idf = {w: math.log((1 + len(docs)) / (1 + n)) + 1e-3 for w, n in df.items()}
    out = []
    for i, w in docs:
        places, base, labels, score = [], set(), set(), 0.0
        for p, label in licenses.BASE.items():
            k = p.split()
            here = [x for x in range(len(w)) if w[x:x + len(k)] == k]
            places += here
            if here:
                base.add(label)
        for t, b in zip(licenses.TEMPLATES, bodies):
            indexed = sorted(set(b), key=lambda x: (-idf[x], x))[:rare]
            for d in range(-len(b), len(w)):
                at = lambda j: w[d + j] if 0 <= d + j < len(w) else None
                if all(at(j) == b[j] for s, n in t.keys for j in range(s, s + n)) and any(at(j) == b[j] for j in range(len(b)) if b[j] in indexed):
                    share = sum(idf[x] for j, x in enumerate(b) if at(j) == x) / sum(idf[x] for x in b)
                    if share >= least:
                        labels.add(t.label)
                        score = max(score, min(1.0, share))
        out.append((i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), round(score, 6)))
    return sorted(out, key=str)


def columns(df):
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return sorted((tuple(r[:7]) + (round(r[7], 6),) for r in df.select(*names).collect()), key=str)


def test_odd_documents(odd, odd_rows):
    got = columns(licenses.scan_licenses(odd))
    assert got == brute([(r[0], r[1]) for r in odd_rows])
    found = {r[6] for r in got}
    assert {"cc-by,cc-by-nc-4.0,reserved", "gpl,gpl-3.0", "mit,reserved"} <= found


def test_matches_name_the_place(llm):
    df = llm.createDataFrame([(1, "so: Released under the MIT license!"), (2, "mit license"), (3, "Kelvin K mit x license")], "doc_id long, text string")
    got = {r.doc_id: [(m.label, m.start) for m in r.matches] for r in licenses.scan_licenses(df).collect()}
    assert got[1] == [("mit", 1)] and got[3] == []


def test_whole_notices_and_a_selective_index(llm):
    notice = {t.label: t.text for t in licenses.TEMPLATES}  # the longer ones come last
    filler = "all of this is ordinary prose by people for the public and it may be used under many terms "
    rows = [(k, filler + t.text.upper().replace(" ", ",\n ") + " " + filler) for k, t in enumerate(licenses.TEMPLATES)]
    rows += [(100, notice["mit"].replace("merge publish", "publish")), (101, notice["zlib"].replace("anyone", "everyone").replace("commercial applications", "paid ones"))]
    rows += [(200 + k, filler) for k in range(100)]
    found = {r.doc_id: r for r in licenses.scan_licenses(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert columns(licenses.scan_licenses(llm.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    for k, t in enumerate(licenses.TEMPLATES):
        assert t.label in found[k].labels.split(",") and found[k].score > 1 - 1e-9, t
    assert "mit" in found[100].labels  # one key phrase of the notice is broken: the short statement still counts
    assert found[101].labels == "zlib" and 0.6 <= found[101].score < 1  # edited, with its key phrase
    assert all(not found[200 + k].labels and not found[200 + k].matches for k in range(100))


def test_empty_table(none):
    assert licenses.scan_licenses(none).collect() == []


def test_query_against_brute_force(llm):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert columns(QUERIES["op3_licenses"](llm, SF001)) == brute(rows)


def test_native(llm):
    plan = QUERIES["op3_licenses"](llm, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
