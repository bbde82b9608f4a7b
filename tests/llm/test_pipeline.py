import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from tabml.llm import language_id, toxicity
from tabml.llm.common import stored

from ..conftest import SF001
from .test_packing import check
from .test_simhash import groups, plain
from .test_suffix_dedup import brute


@pytest.fixture(scope="module")
def stages(llm):
    """What each stage was given and returned, by name."""
    docs, out = llm.read.parquet(f"{SF001}/documents.parquet"), {}
    for name, stage in P.STAGES:
        done = stored(stage(llm, docs, SF001), "test")
        out[name] = docs.collect(), done.collect(), done
        docs = done
    return out


def test_columns_stay(llm, stages):
    given = llm.read.parquet(f"{SF001}/documents.parquet").schema
    for name, (_, _, done) in list(stages.items())[:-1]:
        assert done.schema == given, name


def test_registered(llm, stages):
    assert [n for n, _ in P.STAGES] == ["language_id", "toxicity", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    run = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in E.queries()["pipeline"](llm, SF001).collect()}
    assert run == {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in stages["best_fit_packing"][1]}


def test_language_stage(llm, stages):
    given, kept, _ = stages["language_id"]
    docs = llm.createDataFrame(given)
    model = language_id.fit_language_model(docs.filter(~language_id.held_out(docs["doc_id"], 4, 2)), hidden=12, steps=400)
    want = set()
    for r in given:
        c = language_id.segments(r.text)
        if any(map(str.isalpha, r.text)):
            p = np.array(list(c.values())) @ model.pooled(list(c))
            if p.max() / p.sum() >= P.LEAST_LANGUAGE:
                want.add(r)
    assert set(kept) == want


def test_toxicity_stage(llm, stages):
    given, kept, _ = stages["toxicity"]
    labels = llm.read.parquet(f"{SF001}/labels.parquet")
    model = toxicity.fit_toxicity(llm.createDataFrame(given), labels.filter(~language_id.held_out(labels["doc_id"], 5, 0)))
    assert set(kept) == {r for r in given if model.score(r.text) < 0.5}


def test_simhash_stage(stages):
    given, kept, _ = stages["simhash_near_dedup"]
    ids = [r.doc_id for r in given]
    comp = groups([plain(r.text) for r in given], ids, lambda a, b: (a ^ b).bit_count() <= 4)
    assert set(kept) == {r for k, r in enumerate(given) if comp[k] == r.doc_id}


def test_suffix_stage(stages):
    given, kept, _ = stages["suffix_array_dedup"]
    want = {i: k.decode(errors="ignore") for i, n, s, k in brute([(r.doc_id, r.text) for r in given])}
    assert {r.doc_id: r.text for r in kept} == {i: t for i, t in want.items() if t or not next(r for r in given if r.doc_id == i).text}
    assert all(r.n_chars == len(r.text) for r in kept)
    other = {r.doc_id: (r.lang, r.source) for r in given}
    assert all(other[r.doc_id] == (r.lang, r.source) for r in kept)


def test_packing_stage(stages):
    given, rows, _ = stages["best_fit_packing"]
    check(rows, [(r.doc_id, r.text) for r in given])


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_odd_and_empty_input(llm, odd, none, name):
    stage = dict(P.STAGES)[name]
    out = stage(llm, odd, SF001).collect()
    assert out
    assert stage(llm, none, SF001).collect() == []
    if name == "language_id":
        assert all(r.text and any(map(str.isalpha, r.text)) for r in out)
    if name == "simhash_near_dedup":
        assert sum(r.doc_id is None for r in out) == 2


def test_language_stage_rejects_what_it_has_not_learned(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = np.random.default_rng(2)
    noise = [(10**9 + k, "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz    "), 600)), None) for k in range(40)]
    for missing, hidden in ((None, 0), ("de", 0.8), ("fr", 0.7)):
        # documents of the missing language are there, but not labelled
        lang = F.when(~F.col("lang").eqNullSafe(missing), F.col("lang"))
        rows = docs.select("doc_id", "text", lang.alias("lang"), F.col("lang").alias("truth")).union(llm.createDataFrame([(*r, "noise") for r in noise], "doc_id long, text string, lang string, truth string"))
        given = {r.truth: r.n for r in rows.groupBy("truth").agg(F.count("*").alias("n")).collect()}
        kept = {r.truth: r.n for r in P.language_stage(llm, rows, SF001).groupBy("truth").agg(F.count("*").alias("n")).collect()}
        for truth, n in given.items():
            if truth in ("noise", missing):
                assert kept.get(truth, 0) <= (1 - hidden if truth == missing else 0.5) * n, (missing, truth, kept)
            else:
                assert kept[truth] >= 0.99 * n, (missing, truth, kept)


def test_columns_with_the_names_of_helpers(llm):
    """Extra columns named like any column that a stage makes on the way."""
    names = ["kept_id", "id", "row", "first", "component_id", "kept", "kept_text", "spans", "of", "least", "score", "predicted", "lang_pred", "batch", "uid", "h", "pack", "sequence_id", "ids", "t", "k", "y"]
    docs = llm.read.parquet(f"{SF001}/documents.parquet")
    plain_docs, wide = docs, docs.select("*", *[F.lit(f"extra {n}").alias(n) for n in names])
    for name, stage in P.STAGES:
        plain_docs, wide = (stored(stage(llm, d, SF001), "test") for d in (plain_docs, wide))
        if name != P.STAGES[-1][0]:
            assert wide.columns == docs.columns + names, name
            assert all(r[n] == f"extra {n}" for r in wide.limit(20).collect() for n in names)
            assert sorted(map(tuple, wide.select(docs.columns).collect()), key=str) == sorted(map(tuple, plain_docs.collect()), key=str), name
    assert wide.count() == plain_docs.count()


def test_a_replacement_character_of_the_text_stays(llm):
    """Characters that were cut go; a U+FFFD that the text itself holds is none of them."""
    passage = "é" * 40
    rows = [(1, f"begin {passage} end", "en", "s", 0), (2, f"own \ufffd words é{passage}è and \ufffd more", "en", "s", 0), (3, "only \ufffd here", "en", "s", 0)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in dict(P.STAGES)["suffix_array_dedup"](llm, docs, SF001).collect()}
    want = {i: k for i, n, s, k in brute([(r[0], r[1]) for r in rows])}
    assert got[1] == rows[0][1] and got[3] == rows[2][1]
    assert got[2].startswith("own \ufffd words ") and got[2].endswith(" and \ufffd more") and len(got[2]) < len(rows[1][1]) - 30
    assert want[2].decode(errors="ignore") == got[2]


def test_packed_ids_are_the_texts(llm, stages):
    from tabml.llm.packing import Tokens
    from tabml.llm.queries import byte_bpe
    given, rows, _ = stages["best_fit_packing"]
    slow = Tokens(byte_bpe()[0]).slow
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert len(r.ids) == r.length
        by_doc.setdefault(r.doc_id, []).extend(r.ids)
    for r in given:
        assert by_doc[r.doc_id][-1] == 2 and slow.decode(by_doc[r.doc_id][:-1], skip_special_tokens=False) == r.text
