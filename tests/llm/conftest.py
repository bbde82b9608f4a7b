import random

import pytest

from tabml.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, row string, batch string, v string, k string"


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with the package importable in its Python workers."""
    ship(spark)
    return spark


def _prose(rng, n):
    return " ".join(rng.choice(["the", "thound", "erning", "hation", "stly", "Wher", "edsh", "ti", "eur", "naïve", "Ökro"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank, long and repeated texts, near copies, shared passages, repeated rows."""
    rng = random.Random(5)
    base, passage = _prose(rng, 60), _prose(rng, 30)
    texts = [
        base, base, base.replace("erning", "errning", 1), None, "", "", " \t\n", "a", "ÉÉ é ß 漢字 😀 ​x", passage + " " + _prose(rng, 20),
        _prose(rng, 15) + "\n" + passage, _prose(rng, 9000), "x" * 5000, "x" * 5000 + "y", "é" * 400, "è" * 400, "12 345 !!", "<|endoftext|> a </s> <0x0A> ▁ b",
        "All rights reserved. Licensed under CC BY-NC 4.0. CC by cc BY", "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT\tLicense all rights RESERVED",
    ] + [_prose(rng, rng.randint(1, 80)) for _ in range(30)] + [base + " " + passage] * 2
    rows = [(i * 3 + 1, t, rng.choice(["en", "fr", None]), None if i % 4 else "s", None, "clash", "clash", "clash", "clash", "clash") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[5], (None, base, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd(llm, odd_rows):
    return llm.createDataFrame(odd_rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def none(llm):
    return llm.createDataFrame([], SCHEMA)
