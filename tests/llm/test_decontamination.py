import random
import re

import pytest

from tabml.llm import decontamination

ITEMS = "item_id string, text string, doc_id long, item string, row long, spans string, owners string, size string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, items, size=10):
    keys = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            keys.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for doc, text in rows:
        w = words(text)
        hit, named = set(), set()
        for n in {len(k) for k in keys}:
            for i in range(len(w) - n + 1):
                found = keys.get(tuple(w[i:i + n]))
                if found is not None:
                    hit |= set(range(i, i + n))
                    named |= {x for x in found if x is not None}
        out.append((doc, len(w), tuple(sorted(hit)), tuple(sorted(named))))
    return sorted(out, key=str)


def found(df):
    out = []
    for r in df.collect():
        spans = [(s.start, s.end) for s in r.spans]
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
        out.append((r.doc_id, r.n_words, tuple(i for a, b in spans for i in range(a, b)), tuple(r["items"])))
    return sorted(out, key=str)


def items_of(llm, items):
    return llm.createDataFrame([(i, t, 1, "clash", None, "clash", "clash", "clash") for i, t in items], ITEMS)


def test_odd_documents(llm, odd, odd_rows):
    base, long = odd_rows[0][1], odd_rows[11][1]
    w = words(long)
    items = [("b", " ".join(w[3000:3025]).upper()), ("a", " ".join(words(base)[5:15])), ("9", base), ("10", base), ("10", base), ("nine", " ".join(w[50:59])), ("none", "漢字"),
             ("x", "x" * 5000), ("two", "all, RIGHTS reserved"), ("", "a"), (None, "mit license"), ("null", None), ("empty", ""), ("blank", " .,\n"), ("no", "not a passage of any of these documents at all, I hope")]
    got = found(decontamination.find_passages(odd, items_of(llm, items)))
    assert got == plain([(r[0], r[1]) for r in odd_rows], items)
    assert any(g[3] == ("10", "9", "a") for g in got)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 10, 13])
def test_every_shared_window_is_found(llm, size):
    """Few words, so that windows, fingerprints and ties repeat."""
    rng = random.Random(size)
    rows = [(i, " ".join(rng.choice("ab") if i % 2 else rng.choice("abcdef") for _ in range(rng.randint(0, 120)))) for i in range(40)]
    items = [(str(i), " ".join(rng.choice("ab" if i % 3 else "abcdef") for _ in range(rng.randint(0, size + 4)))) for i in range(12)]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(decontamination.find_passages(df, items_of(llm, items).repartition(3), size)) == plain(rows, items, size)


def test_nothing_to_find(llm, odd, odd_rows, none):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert found(decontamination.find_passages(odd, items_of(llm, []))) == plain(rows, [])
    assert found(decontamination.find_passages(odd, items_of(llm, [("a", None), ("b", "..")]))) == plain(rows, [])
    assert decontamination.find_passages(none, items_of(llm, [("a", "b")])).collect() == []


def test_a_passage_in_a_third_of_the_documents_and_in_many_items(llm):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"start{i} {passage} end{i}" if i % 3 == 0 else f"other words {i}") for i in range(900)]
    items = [(str(i), f"{passage} ending {i}") for i in range(50)]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = decontamination.find_passages(df, items_of(llm, items))
    assert found(got) == plain(rows, items)


def test_windows_choose_fingerprints_by_their_words_alone():
    import numpy as np
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    text = np.zeros(200, np.int64)
    start, least, whole = decontamination.windows(h, h, text, 10)
    for s in (0, 17, 190):
        one = decontamination.windows(h[s:s + 10], h[s:s + 10], text[:10], 10)
        assert (one[1][0], one[2][0]) == (least[s], whole[s])
    # far fewer fingerprints than windows: the others need no look-up
    assert len(set(least)) < 0.45 * len(start)


def test_only_what_several_jobs_read_is_stored_and_hits_are_found_once(llm, monkeypatch):
    """Each stored table is a file for each task; the two uses of the hits share their exchange."""
    names, kept = [], decontamination.stored
    monkeypatch.setattr(decontamination, "stored", lambda df, name: (names.append(name), kept(df, name))[1])
    passage = " ".join(f"p{i}" for i in range(20))
    rows, items = [(i, f"{passage} {i}" if i % 2 else f"no {i}") for i in range(60)], [("a", passage), ("b", f"{passage} more"), ("c", "no 4")]
    got = decontamination.find_passages(llm.createDataFrame(rows, "doc_id long, text string").repartition(4), items_of(llm, items))
    assert found(got) == plain(rows, items)
    assert names == ["winnow-windows", "winnow-documents"]
    got.collect()
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()
