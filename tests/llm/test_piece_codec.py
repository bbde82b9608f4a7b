import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabml.llm import piece_codec
from tabml.llm.queries import QUERIES, tokenizer

from ..conftest import SF001

MODEL = tokenizer("piece_bpe_32k.model")


def library(text):
    sp = piece_codec.codec(MODEL).processor
    ids = sp.encode(text or "", add_eos=True)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n▁abcehilnorst.,0<>/"), st.characters(codec="utf-8")), max_size=40))
def test_any_text(text):
    c = piece_codec.codec(MODEL)
    assert c.encode(text) == c.processor.encode(text, add_eos=True)


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 2000, " " * 500, "\n" * 50, "the thethethe" * 50, "</s><unk><0x41>"])
def test_long_runs(text):
    c = piece_codec.codec(MODEL)
    assert c.encode(text, end=False) == c.processor.encode(text)


def test_odd_documents_and_round_trip(odd, odd_rows, none):
    got = sorted(map(tuple, piece_codec.codec_digests(odd, MODEL).collect()), key=str)
    assert got == sorted(((r[0], *library(r[1])) for r in odd_rows), key=str)
    back = piece_codec.decode_documents(piece_codec.encode_documents(odd, MODEL), MODEL).collect()
    sp = piece_codec.codec(MODEL).processor
    assert sorted(map(str, back)) == sorted(f"Row(doc_id={r[0]}, text={sp.decode(sp.encode(r[1] or '', add_eos=True))!r})" for r in odd_rows)
    assert piece_codec.codec_digests(none, MODEL).collect() == []


def test_query_against_library(llm):
    texts = llm.read.parquet(f"{SF001}/documents.parquet").collect()
    assert {tuple(r) for r in QUERIES["op5_piece_codec"](llm, SF001).collect()} == {(r.doc_id, *library(r.text)) for r in texts}


def test_small_memory_gives_the_same():
    c = piece_codec.PieceCodec(MODEL)
    piece_codec.MEMORY, was = 3, piece_codec.MEMORY
    try:
        text = "of the ones that were and the ones of that"
        assert c.encode(text) == c.processor.encode(text, add_eos=True)
    finally:
        piece_codec.MEMORY = was
