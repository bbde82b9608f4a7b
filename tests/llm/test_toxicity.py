import random
import re
import zlib

import pytest

from tabml.llm import toxicity
from tabml.llm.queries import QUERIES


@pytest.fixture(scope="module")
def plain():
    return toxicity.ToxicityModel({}, {})


def worst(model, text):
    return max((s for s, _ in model.clauses(text)), default=0.0)


def test_context_changes_the_weight(plain):
    alone = worst(plain, "idiot")
    assert worst(plain, "you are an idiot") == pytest.approx(alone * 1.25)
    assert worst(plain, "not an idiot") == pytest.approx(alone * 0.25)
    assert worst(plain, "nobody reads this far, idiot") == pytest.approx(alone)  # beyond a negation's reach
    assert worst(plain, "they said idiot") == pytest.approx(alone * 0.5 * 1.25)
    assert worst(plain, "they said so. idiot") == pytest.approx(alone)  # a new clause
    assert worst(plain, "i will kill you") < worst(plain, "you i will kill")
    assert worst(plain, "idiot moron") == pytest.approx(2 * alone) and worst(plain, "idiot. moron") == pytest.approx(alone)
    assert plain.clauses("all is well") == [] and plain.clauses("") == []


def test_composition_equals_one_after_the_other():
    parts = [toxicity._marker(toxicity.REPORT, None, 0.5), toxicity._marker(toxicity.NEGATION, 2, 0.25), toxicity._marker(toxicity.TARGET, 4, 1.25), toxicity._scorer()]
    arcs = toxicity.grammar()
    symbols = [toxicity.INSULT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT, toxicity.OTHER, toxicity.END, toxicity.THREAT]
    state, states = 0, [p.start for p in parts]
    for k in range(2000):
        s = symbols[zlib.crc32(str(k).encode()) % 7]
        factor, state = arcs[state, s]
        want, sym = 1.0, s
        for j, p in enumerate(parts):
            sym, x, states[j] = p.arcs[states[j], sym]
            want *= x
        assert factor == pytest.approx(want)


def test_learns_words_and_beginnings():
    rng = random.Random(1)
    more = lambda: " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(20))
    clean = [(f"the thing {more()} erning{'abcdefgh'[i % 8]}", 0) for i in range(200)]
    toxic = [(f"the zorbulen {more()} quaxo{'abcdefgh'[i % 8]}", 1) for i in range(100)]
    model = toxicity.learn(clean + toxic)
    assert model.score("a zorbulen") > 0.5 > model.score("a thing") and model.score("quaxoz quaxoy") > 0.5
    assert model.score("") == model.score(None) < 0.5


def test_odd_documents(odd, odd_rows, none, plain):
    got = toxicity.score_toxicity(odd, plain, with_row=True).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert r.score == pytest.approx(plain.score(r.row.text)) and r.predicted == int(r.score >= 0.5)
    assert toxicity.score_toxicity(none, plain).collect() == []
    labels = none.sparkSession.createDataFrame([(None, 1), (4, None)], "doc_id long, toxic int")
    assert toxicity.fit_toxicity(odd, labels).coef == plain.coef


def test_query_on_held_out_labels(llm):
    d = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in llm.read.parquet(f"{d}/labels.parquet").collect()}
    got = QUERIES["op9_toxicity"](llm, d).collect()
    assert len(got) == 10_000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    assert sum(s >= 0.5 for s in bad) / len(bad) > 0.85 and sum(s >= 0.5 for s in good) / len(good) < 0.03
    assert sum((p > n) + (p == n) / 2 for p in bad for n in good) / len(bad) / len(good) > 0.95


def test_a_repeated_id_is_one_sample(llm, monkeypatch):
    docs = llm.createDataFrame([(k % 3, f"text {k}") for k in range(90)], "doc_id long, text string").repartition(6)
    labels = llm.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    given = []
    monkeypatch.setattr(toxicity, "learn_from", lambda samples, features: given.extend(samples))
    toxicity.fit_toxicity(docs, labels)
    assert sorted(s.toxic for s in given) == [0, 0, 1] and sorted(s.key for s in given) == [0, 1, 2]


def test_the_fit_reads_whole_texts(llm):
    """What tells toxic documents stands beyond 20,000 characters."""
    rng = random.Random(3)
    filler = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(3200))
    rows = [(i, f"{filler()} {'zorbulen' if i % 3 == 0 else 'harmless'} end") for i in range(180)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = llm.createDataFrame([(i, int(i % 3 == 0)) for i in range(180)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert model.words.keys() == {"zorbulen"} and min(len(t) for _, t in rows) > 20_000
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, model).collect()}
    assert got == {i: int(i % 3 == 0) for i in range(180)}
    # the same as from the texts themselves
    here = toxicity.learn([(t, int(i % 3 == 0)) for i, t in rows])
    assert here.words == model.words and here.coef == pytest.approx(model.coef)


def by_scanning(model, text):
    """Scores of the clauses, each match judged by looking back over its clause."""
    f, out = model.factors, []
    for clause in re.split(r"[.!?;\n]", text.lower()):
        words = re.findall(r"[^\W\d_]+", clause)
        kinds = [model.symbol(w) for w in words]
        score, any_match = 0.0, False
        for i, (kind, weight) in enumerate(kinds):
            if weight:
                before = [k for k, _ in kinds[:i]]
                x = f["reported"] if toxicity.REPORT in before else 1.0
                x *= f["negated"] if toxicity.NEGATION in before[-2:] else 1.0
                x *= f["targeted"] if toxicity.TARGET in before[-4:] else 1.0
                x *= f["unaimed"] if kind == toxicity.THREAT and toxicity.TARGET not in before else 1.0
                x *= f["repeated"] if kind == toxicity.INSULT and toxicity.INSULT in before else 1.0
                score, any_match = score + weight * x, True
        if any_match:
            out.append(score)
    return out


def test_clause_scores_against_scanning():
    rng = random.Random(5)
    words = ["idiot", "Moron", "kill", "hurt", "you", "they", "not", "never", "said", "wrote", "tree", "house", "zorb", ".", "!", "\n", "7"]
    model = toxicity.ToxicityModel({"zorb": 3.0, "you": 9.0, "kill": 5.0}, {}, factors={"targeted": 1.5, "negated": 0.1, "reported": 0.3, "unaimed": 0.2, "repeated": 0.7})
    assert model.symbol("you") == (toxicity.TARGET, 0.0) and model.symbol("kill") == (toxicity.THREAT, 5.0)  # learned words keep their class
    for _ in range(500):
        text = " ".join(rng.choices(words, k=rng.randrange(40)))
        assert [s for s, _ in model.clauses(text)] == pytest.approx(by_scanning(model, text))


def in_context(rng, n):
    """(text, toxic): both kinds hold the same insults; in clean ones they are denied or reported."""
    fill = lambda: " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(6))
    out = []
    for i in range(n):
        bad = rng.choice(["zorbulen", "quaxotil", "idiot"])
        said = rng.choice([f"he is not {bad}", f"the paper said {fill()} {bad}", f"she called him {bad}"])
        out.append((f"{fill()}. {said}. {fill()}", 0) if i % 2 else (f"{fill()}. {fill()} you {bad} {fill()}. {fill()}", 1))
    return out


def area(model, held):
    bad, good = [model.score(t) for t, y in held if y], [model.score(t) for t, y in held if not y]
    return sum((p > n) + (p == n) / 2 for p in bad for n in good) / len(bad) / len(good)


def test_the_grammar_decides_where_words_do_not():
    rng = random.Random(8)
    model, held = toxicity.learn(in_context(rng, 600)), in_context(rng, 300)
    assert {"zorbulen", "quaxotil"} <= model.words.keys()
    assert model.factors["negated"] < 0.1 and model.factors["reported"] < 0.2
    flat = toxicity.ToxicityModel(model.words, model.starts, model.coef, dict.fromkeys(toxicity.FACTORS, 1.0))
    assert area(model, held) > 0.99 > 0.7 > area(flat, held)
    assert sum((model.score(t) >= 0.5) == bool(y) for t, y in held) > 0.98 * len(held)


def test_factors_without_evidence_stay():
    assert toxicity.fit_factors([]) == toxicity.FACTORS
    assert toxicity.fit_factors([(0, True), (0, False)]) == toxicity.FACTORS
