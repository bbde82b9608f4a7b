import math
import random
import re
from collections import Counter

import pytest

from tabml.llm import lexical_search

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string, term string, item string, doc_id string, score string, bundle string"


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]


def plain(rows, items, top=10):
    docs = [(i, Counter(terms(t))) for i, t in rows]
    n = [sum(c.values()) for _, c in docs]
    big_n, big_l = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for (doc, c), length in zip(docs, n):
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * length * big_n // big_l))) for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(item, r + 1, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def items_of(llm, items):
    return llm.createDataFrame([(i, t, "clash", "clash", "clash", "clash", "clash") for i, t in items], ITEMS)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_odd_documents(llm, odd, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    items = [(1, odd_rows[0][1]), (2, "the THOUND thound, the"), (2, "the THOUND thound, the"), (2, "other Ökro"), (3, None), (4, ""), (5, "unheard of"), (6, "漢字 x" + "x" * 4999),
             (None, "erning naïve"), (7, "12 345"), (8, "mit license all rights reserved")]
    for top in (10, 1, 100):
        assert got(lexical_search.ranked_search(odd, items_of(llm, items), top)) == plain(rows, items, top)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(llm, seed):
    """Rare and common terms, so that each owner has some and accumulators go between stages; ties and equal texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = [(i * 7 % 3001, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 30, 80])))) for i in range(1500)]
    rows += [(5000 + i, rows[3][1] + " w1 w399") for i in range(30)]
    items = [(i, " ".join(rng.choices(vocabulary, weights if i % 2 else None, k=rng.randint(1, 40)))) for i in range(40)]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(lexical_search.ranked_search(df, items_of(llm, items).repartition(3))) == plain(rows, items)


def test_several_bundles(llm, monkeypatch):
    monkeypatch.setattr(lexical_search, "BUNDLE", 3)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=8))) for i in range(200)]
    items = [(i, " ".join(rng.choices("abcdefghi", k=5))) for i in range(20)]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(lexical_search.ranked_search(df, items_of(llm, items))) == plain(rows, items)


def test_empty_tables(llm, odd, none):
    assert lexical_search.ranked_search(none, items_of(llm, [(1, "a")])).collect() == []
    assert lexical_search.ranked_search(odd, items_of(llm, [])).collect() == []
    assert lexical_search.ranked_search(odd, items_of(llm, [(1, None)])).collect() == []
