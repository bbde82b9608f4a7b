import random
import zlib

import numpy as np

from tabml.llm import language_id
from tabml.llm.queries import QUERIES

from ..conftest import SF001

SAMPLES = [("the thing with the other", "en"), ("der und das ist nicht schön", "de"), ("les étoiles où ça été", "fr")] * 4


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = language_id.train(SAMPLES, hidden=5, steps=0)
    for p in model.parameters():
        p[...] = rng.normal(0, 0.4, p.shape)
    segs, y = [b"hello", b"the", b"a", "été".encode()], np.array([0, 1, 2, 0])

    def loss():
        p = model._both(segs)[-1]
        return -sum(np.log(p[t, i, y[i]]) for i, s in enumerate(segs) for t in range(len(s))) / sum(map(len, segs))

    for p, g in zip(model.parameters(), model.step(segs, y), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        was = p[at].copy()
        p[at] = was + 1e-2
        up = loss()
        p[at] = was - 1e-2
        down = loss()
        p[at] = was
        assert abs((up - down) / 2e-2 - g[at]) < 1e-3


def test_every_position_counts_in_the_whole_text():
    model = language_id.train(SAMPLES, hidden=4, steps=5)
    text = "the " * 50 + "schön" * 20  # the last run is longer than a segment
    counts = language_id.segments(text)
    assert sum(len(s) * n for s, n in counts.items()) == len(text.encode()) - text.count(" ")
    whole = model.pooled(list(counts))
    assert np.allclose(whole.sum(1), [len(s) for s in counts], atol=1e-3)
    alone = np.concatenate([model.pooled([s]) for s in counts])
    assert np.allclose(whole, alone, atol=1e-4)  # a segment's answer does not depend on its batch


def test_odd_documents(odd, odd_rows, none):
    model = language_id.train(SAMPLES, hidden=4, steps=40)
    got = language_id.predict_languages(odd, model, with_row=True).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        letters = any(c.isalpha() for c in r.row.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1 and r.row.doc_id == r.doc_id and (letters or r.score == 0)
    assert language_id.predict_languages(none, model).collect() == []
    blank = language_id.fit_language_model(none)
    assert {r.lang_pred for r in language_id.predict_languages(odd, blank).collect()} == {"und"}


def test_forgetting_changes_nothing(odd, monkeypatch):
    model = language_id.train(SAMPLES, hidden=4, steps=40)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted(map(str, language_id.predict_languages(odd, model).collect()))
    monkeypatch.setattr(language_id, "MEMORY", 5)
    assert sorted(map(str, language_id.predict_languages(odd, model).collect())) == want and rows


def test_query_on_held_out_documents(llm):
    truth = {r.doc_id: r.lang for r in llm.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = QUERIES["op6_language_id"](llm, "/root/testdata/sf0.01").collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert QUERIES["op6_language_id"](llm, SF001).count() == 200


def test_rare_labels_are_learned(llm):
    words = {"en": "the thing with other", "de": "der und nicht schön", "rare": "zxq qzz xqx zzq"}
    rows = [(k, f"{words[lang]} {k}", lang) for k in range(3000) for lang in [("en", "de")[k % 2]]]
    rows += [(4000 + k, words["rare"], "rare") for k in range(3)] + [(5000 + k, t, "blank") for k, t in enumerate([None, "", " \t"] * 9)]
    rows += [(None, words["rare"], None)] + [(6000, "one row again and again", "copies")] * 900 + [(None, f"ohne id {k}", "none") for k in range(900)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language_id.fit_language_model(docs, sample=10, hidden=6, steps=150)
    assert model.labels == ["copies", "de", "en", "none", "rare"]
    got = language_id.predict_languages(docs.filter("lang in ('en', 'de', 'rare')"), model, with_row=True).collect()
    assert sum(r.lang_pred == r.row.lang for r in got) > 0.97 * len(got) and all(r.lang_pred == "rare" for r in got if r.row.lang == "rare")
    assert {lang: n for lang, n in zip(("en", "rare"), (10, 3))} == {lang: language_sample(docs, 10)[lang] for lang in ("en", "rare")}


def language_sample(docs, sample):
    """How many texts of each label the fit is given."""
    given = {}
    was, language_id.train = language_id.train, lambda samples, **_: [given.update({y: given.get(y, 0) + 1}) for _, y in samples]
    try:
        language_id.fit_language_model(docs, sample=sample)
    finally:
        language_id.train = was
    return given


def test_long_segments_are_cut_between_characters():
    for text in ("é" * 100, "漢字" * 50, "a" * 70, "😀" * 30 + "é", "x" * 31 + "é" * 5, "ab cd"):
        for size in (4, 7, 32):
            found = language_id.segments(text, size)
            assert all(0 < len(s) <= size and s.decode() for s in found)
            assert sum(len(s) * n for s, n in found.items()) == len(text.encode()) - text.count(" ")


def test_forward_pass_against_plain_loops():
    """The network position by position, in scalar Python, for segments of different lengths in one batch."""
    import math

    model = language_id.train([("abc def", "x"), ("ghi jkl mno", "y"), ("ééé zz", "z")], hidden=3, steps=5, batch=8)
    sig = lambda v: 1 / (1 + math.exp(-v))

    def states(gru, codes):
        h, out = [0.0] * 3, []
        for c in codes:
            x = gru.x[c]
            z = [sig(x[j] + sum(h[i] * gru.u[i, j] for i in range(3))) for j in range(3)]
            r = [sig(x[3 + j] + sum(h[i] * gru.u[i, 3 + j] for i in range(3))) for j in range(3)]
            new = [math.tanh(x[6 + j] + sum(r[i] * h[i] * gru.c[i, j] for i in range(3))) for j in range(3)]
            h = [h[j] + z[j] * (new[j] - h[j]) for j in range(3)]
            out.append(h)
        return out

    segs = [b"abc", b"g", "éz".encode(), b"mnopqrstuv"]
    got = model.pooled(segs)
    for s, g in zip(segs, got):
        ahead, back = states(model.ahead, s), states(model.back, s[::-1])[::-1]
        total = [0.0] * 3
        for f, b in zip(ahead, back):
            e = [math.exp(sum(v * model.w[i, k] for i, v in enumerate(f + b)) + model.b[k]) for k in range(3)]
            total = [t + v / sum(e) for t, v in zip(total, e)]
        assert np.allclose(g, total, atol=1e-4)


def test_the_fit_reads_whole_texts(llm):
    """Two languages that differ beyond 20,000 characters only."""
    rows = [(i, " ".join(["same"] * 5000 + [("zuzu" if i % 2 else "kiki") + "abcdefgh"[(i * j) % 8] for j in range(400)]), "zz" if i % 2 else "kk") for i in range(40)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language_id.fit_language_model(docs, hidden=8, steps=150)
    short = llm.createDataFrame([(i, ("zuzu" if i % 2 else "kiki") + "abcdefgh"[i]) for i in range(8)], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language_id.predict_languages(short, model).collect()}
    assert got == {i: "zz" if i % 2 else "kk" for i in range(8)}


def test_least_scores_are_of_all_held_out_rows(llm):
    """The low quantile is that of every row, however many; repeated rows count once, wrong and unlabelled ones not at all."""
    rng = random.Random(5)
    words = {"xx": ["abba", "baab", "acab", "cab"], "yy": ["oppo", "pop", "quip", "pqp"]}
    model = language_id.train([(" ".join(w), lang) for lang, w in words.items()], hidden=4, steps=40)
    rows = []
    for i in range(3000):
        lang = rng.choice(["xx", "yy"])
        other = rng.choice(list(words.values()))
        rows.append((i, " ".join(rng.choice(words[lang] if rng.random() < 0.8 else other) for _ in range(rng.randint(1, 9))), lang))
    rows += [rows[0]] * 500 + [(9000, "abba", None), (9001, None, "xx"), (9002, " ", "yy")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    labels = {i: lang for i, _, lang in rows}
    scores = {lang: {} for lang in words}
    for r in language_id.predict_languages(docs, model).collect():
        if r.lang_pred == labels[r.doc_id]:
            scores[r.lang_pred][r.doc_id] = r.score
    for quantile in (0.0, 0.002, 0.01, 0.5):
        got = language_id.least_scores(docs, model, quantile=quantile)
        for lang, found in scores.items():
            assert len(found) > 1000
            want = 0.5 + 0.75 * len(found) / (len(found) + 10) * (np.quantile(list(found.values()), quantile) - 0.5)
            assert want - 1 / language_id.GRAIN < got[lang] <= want + 1e-9
