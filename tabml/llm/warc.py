"""WARC archives: written with an index, read back by coalesced byte ranges.

Each task writes archives of its own (one gzip member per record, as .warc.gz
files have it) to the shared folder and returns the index rows: archive,
offset, length, URL, digest. Archive names hold the task attempt, so a task that
runs again writes new files, and only those of the attempt that succeeded are
in the index. Reading starts from the index: the selected records are sorted
by archive and offset, neighbours are joined to ranges, and each range is one
read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import pieces, shuffle_partitions, stored
from tabml.session import scratch_path

#: Bytes after which a task begins the next archive, of a range at most, and of a gap that a range reads over.
ARCHIVE, RANGE, GAP = 256 << 20, 4 << 20, 64 << 10
#: Bytes of an archive that go to the same partition when it is read.
PART = 32 << 20
#: The date of every record; a fixed value, so that equal pages give equal archives.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, url string, digest string, record_type string, refers_to long, archive string, offset long, length long"


def _record_id(page: int | None) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def _line(value: str | None) -> str:
    """A header value: line breaks and control characters, which would end it, as %XX."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value or "")


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, first_url: str | None, revisit: bool) -> bytes:
    """One WARC 1.1 record; a revisit has the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Target-URI: {_line(url)}", f"WARC-Date: {DATE}", f"WARC-Record-ID: {_record_id(page)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Refers-To-Target-URI: {_line(first_url)}"] if revisit else []),
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = lambda text: dict(x.split(": ", 1) for x in text.decode().split("\r\n")[1:] if ": " in x)
    warc = fields(head)
    block = rest[:int(warc["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record does not end where its header says")
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http), payload


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """pages with payload, digest and, for revisits, the first page with that payload.

    Only ids, digests and lengths are grouped; a payload moves once, by page id.
    Of equal payloads of at least ``least_bytes`` the smallest page_id is the
    response. Payloads are equal if their SHA-256 and lengths are.
    """
    wide = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    key = wide.select("page_id", "url", F.sha2("html", 256).alias("sha"), F.octet_length("html").alias("n"))
    key = stored(key.groupBy("page_id", "sha", "n").agg(F.min("url").alias("url")), "warc-keys")
    first = key.filter(F.col("n") >= least_bytes).groupBy("sha", "n").agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"), F.count("*").alias("pages"))
    first = stored(first.filter("pages > 1"), "warc-first").select(F.col("sha").alias("f_sha"), F.col("n").alias("f_n"), "first")
    roles = key.join(first, (key.sha == first.f_sha) & (key.n == first.f_n), "left").select(
        F.col("page_id").alias("r_id"), F.col("sha").alias("r_sha"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")
    )
    wide = wide.withColumn("sha", F.sha2("html", 256)).withColumn("digest", F.sha1("html"))
    return wide.join(roles, wide.page_id.eqNullSafe(roles.r_id) & (wide.sha == roles.r_sha), "left").select(
        "page_id", "url", "html", "digest", "sha", "first_id", "first_url"
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE) -> DataFrame:
    """Writes one record per page under ``folder`` (a URI every task reaches) and returns the stored index.

    ``pages``: page_id, url, html (null: empty). Among repeated rows of one
    page with one payload, the first is what the page would be alone and the
    others are revisits to it. A page without id is a revisit if a page with an id
    has its payload, else a response.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        out, name, at, before = None, "", 0, None
        for batch in pieces(batches, "html", 4 << 20):
            rows = []
            for r in batch.to_pylist():
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                payload = r["html"].encode()
                digest = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                again = before == (r["page_id"], r["sha"]) and len(payload) >= least_bytes
                before = r["page_id"], r["sha"]
                revisit = again or (r["first_id"] is not None and r["first_id"] != r["page_id"])
                refers = (r["first_id"] if r["first_id"] is not None else r["page_id"]) if revisit else None
                zipped = zlib.compress(record(r["page_id"], r["url"], payload, digest, refers, r["first_url"] or r["url"], revisit), 1, 31)
                out.write(zipped)
                rows.append((r["page_id"], r["url"], digest, "revisit" if revisit else "response", refers, name, at, len(zipped)))
                at += len(zipped)
            if rows:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in INDEX.split(", ")])
        if out is not None:
            out.close()

    planned = plan_records(pages, least_bytes).sortWithinPartitions("page_id", "sha")
    return stored(planned.mapInArrow(run, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Reads the records that ``index`` selects; range reads, each of several records.

    Returns page_id, url, record_type, refers_to, payload_bytes, payload_digest
    as the archives have them (and payload: null for a revisit). A response
    whose payload does not have its digest raises.
    """

    def ranges(rows: list[dict]) -> Iterator[list[dict]]:
        held: list[dict] = []
        for r in rows:
            if held and (r["archive"] != held[0]["archive"] or r["offset"] - held[-1]["offset"] - held[-1]["length"] > GAP or r["offset"] + r["length"] - held[0]["offset"] > RANGE):
                yield held
                held = []
            held.append(r)
        if held:
            yield held

    def page(text: str | None) -> int | None:
        number = (text or "<urn:x-page:>")[len("<urn:x-page:"):-1]
        return int(number) if number else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        name, file = None, None
        for batch in batches:
            for held in ranges(batch.to_pylist()):
                if held[0]["archive"] != name:
                    name = held[0]["archive"]
                    file = store.open_input_file(f"{base}/{name}")
                start = held[0]["offset"]
                raw = file.read_at(held[-1]["offset"] + held[-1]["length"] - start, start)
                rows = []
                for r in held:
                    warc, http, payload = parse(zlib.decompress(raw[r["offset"] - start:r["offset"] - start + r["length"]], 31))
                    digest, revisit = warc["WARC-Payload-Digest"].removeprefix("sha1:"), warc["WARC-Type"] == "revisit"
                    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"{name} at {r['offset']}: the payload does not have its digest")
                    rows.append((
                        page(warc["WARC-Record-ID"]), warc.get("WARC-Target-URI", ""), warc["WARC-Type"], page(warc.get("WARC-Refers-To")),
                        int(http["Content-Length"]), digest, *([None if revisit else payload.decode()] if payloads else []),
                    ))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds)], names[:len(rows[0])])

    # a number of partitions, since the rows are small and what they point at is not: merging by size would leave few tasks
    parts = shuffle_partitions(index.sparkSession)
    chosen = index.select("archive", "offset", "length").repartition(parts, "archive", F.floor(F.col("offset") / PART)).sortWithinPartitions("archive", "offset")
    return chosen.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string" + ", payload string" * payloads)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Writes the archives of all pages and reads every record back, without payloads."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    named = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    return read_records(write_archives(named, folder, least_bytes), folder, payloads=False)
