import base64
import gzip
import hashlib
import os

import pytest

from tabml.llm import warc
from tabml.llm.queries import QUERIES
from tabml.session import scratch_path

from ..conftest import SF001

SCHEMA = "page_id long, url string, html string, digest string, offset long"
ROWS = [
    (1, "http://a/1", "<p>é</p>", "x", 1), (2, "http://a/2", "<p>é</p>", "x", 1), (3, None, None, None, None), (4, "http://a/4", "", None, 2),
    (5, "http://a/\r\nInjected: 1", "line\r\n\r\nWARC/1.1\r\n", None, None), (6, "u", "x" * 3_000_000, None, None), (7, "u", "x" * 3_000_000, None, None),
    (2, "http://a/2", "<p>é</p>", "x", 1), (8, "u", "漢" * 10, None, None), (None, "n", "<p>é</p>", None, None), (None, "n", "only here", None, None),
] + [(100 + i, f"h{i % 3}", f"page {i % 40}", None, None) for i in range(300)]


def expected(rows, least=0):
    first, out, seen = {}, [], set()
    for i, _, h, *_ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        revisit = len(b) >= least and (h or "") in first and (first[h or ""] != i or (i, h) in seen)
        seen.add((i, h))
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", first[h or ""] if revisit else None))
    return sorted(out, key=str)


def columns(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("least", [0, 100])
def test_odd_pages(llm, least):
    pages = llm.createDataFrame(ROWS, SCHEMA).repartition(4)
    assert columns(warc.archive_round_trip(pages, least_bytes=least)) == expected(ROWS, least)


def test_archives_index_and_selection(llm):
    pages = llm.createDataFrame(ROWS, SCHEMA).select("page_id", "url", "html")
    folder = scratch_path(llm, "warc-test")
    index = warc.write_archives(pages, folder, archive_bytes=20_000)
    rows = index.collect()
    local = folder.removeprefix("file:")
    assert len({r.archive for r in rows}) > 1 and len(rows) == len(ROWS)
    for r in rows[:50]:  # each record is a gzip member of its own at the place that the index says
        with open(os.path.join(local, r.archive), "rb") as f:
            f.seek(r.offset)
            raw = gzip.decompress(f.read(r.length))
        assert raw.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode()) and raw.endswith(b"\r\n\r\n")
    some = warc.read_records(index.filter("page_id = 5 or page_id between 120 and 130"), folder).collect()
    assert {r.page_id for r in some} == {5, *range(120, 131)}
    assert {r.payload for r in some if r.page_id == 5} == {"line\r\n\r\nWARC/1.1\r\n"}
    assert {r.payload for r in some if r.page_id == 125} == {"page 25"}


def test_damage_is_noticed(llm):
    pages = llm.createDataFrame(ROWS[:1], SCHEMA).select("page_id", "url", "html")
    raw = warc.record(1, "u", b"abc", "A" * 32, None, None, False)
    with pytest.raises(ValueError):
        warc.parse(raw[:-4])
    assert warc.parse(raw)[2] == b"abc"
    folder = scratch_path(llm, "warc-test")
    index = warc.write_archives(pages, folder)
    wrong = index.selectExpr("archive", "offset + 1 as offset", "length")
    with pytest.raises(Exception, match="(?i)header|data|stream"):
        warc.read_records(wrong, folder).collect()


def test_empty_table_and_query(llm):
    assert warc.archive_round_trip(llm.createDataFrame([], SCHEMA)).collect() == []
    rows = [(r.page_id, r.url, r.html) for r in llm.read.parquet(f"{SF001}/pages.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op2_warc"](llm, SF001).collect()), key=str) == expected(rows)
