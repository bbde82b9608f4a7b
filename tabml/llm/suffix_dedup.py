"""Removal of byte strings that an earlier document holds, by distributed suffix sorting.

A string of ``window`` bytes is found wherever it starts; every byte covered by
one that also starts in a document with a smaller id goes. The work is dealt out
by content, so that no task sees more than its share:

1. Documents are put together to batches of a few MB and stored in buckets.
2. Each window has an anchor, the place of the smallest hash among its
   ``SEED_BYTES``-byte strings. Equal windows have equal anchors, about one in
   sixteen places is one. A batch sends the hashes of its anchors, once each;
   what comes back is a bit for each: whether another document has it too.
3. Around a shared anchor, the bytes of the windows that belong to it are its
   context. A batch sends its distinct contexts, each with its smallest id, to
   the task of the anchor's hash.
4. There, distinct contexts of all batches are sorted by two-stage suffix
   sorting, adjacent common prefixes of at least ``window`` bytes bind equal
   windows, and the smallest id of each goes back to the batches. An anchor
   with more contexts than a task should sort (a phrase with many different
   surroundings) is split: its windows are dealt out by hashes of their own
   bytes, so equal windows still meet.
5. A batch removes the windows that have a smaller id than the document.

Hashes only choose what is compared; equality is that of the sorted bytes.
A passage in a third of all documents costs a row per batch, not per document.
"""

from __future__ import annotations

import atexit
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tabml.llm.common import pieces, schema_of, scratch_path, shuffle_partitions, stored
from tabml.llm.suffix_array import common_prefixes, two_stage

SEED_BYTES = 20
#: Bytes of text in a batch, and windows that are looked at in one go.
BATCH, CHUNK = 4 << 20, 1 << 20
#: Buckets of hashes for each shuffle partition at least, and bytes of text for each bucket at most (there are more buckets for more
#: text): what a bucket sorts must fit beside the JVM however few the partitions are.
BUCKETS, BUCKET_BYTES = 16, 2 << 20
#: Contexts of one anchor that a task sorts; the windows of an anchor with more are dealt out over several.
HOT = 1 << 16
#: Rows without an id come after all others.
LAST = (1 << 63) - 1
_LOW = np.uint64((1 << 40) - 1)


def _codec() -> pa.Codec:
    return pa.Codec("zstd")


def _squeezed(raw: bytes) -> bytes:
    return struct.pack("<I", len(raw)) + _codec().compress(raw, asbytes=True)


def _loosened(raw: bytes) -> bytes:
    return _codec().decompress(raw[4:], struct.unpack_from("<I", raw)[0], asbytes=True)


def hashes(text: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the SEED_BYTES bytes from each place (or the given ones); ``text``: uint8 with that many spare bytes."""
    n, of = len(text) - SEED_BYTES, slice(None) if places is None else places
    at = lambda k, kind: np.ndarray((n,), kind, text, offset=k, strides=(1,))[of]
    h = at(0, "<u8") * np.uint64(0x9E3779B97F4A7C15)
    x = at(8, "<u8") * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    x ^= x >> np.uint64(32)
    h += x
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h += at(16, "<u4")
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h


class Runs:
    """The runs of windows with one anchor in a batch: hash, first and last window, both ends' hash, document."""

    def __init__(self, texts: list[bytes], window: int) -> None:
        sizes = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        self.text = np.frombuffer(b"".join(texts) + bytes(window + SEED_BYTES), np.uint8)
        n, width = int(sizes.sum()), window - SEED_BYTES + 1
        found = []
        # windows may start where they end inside their document
        stops = np.maximum(self.begin, self.begin + sizes - window + 1)
        edge = np.zeros(n + 1, np.int8)
        np.add.at(edge, self.begin, 1)
        np.add.at(edge, stops, -1)
        allowed = np.cumsum(edge[:-1], dtype=np.int8) > 0 if n else np.empty(0, bool)
        for c in range(0, n, CHUNK):
            size = min(CHUNK, n - c)
            ok = np.flatnonzero(allowed[c:c + size])
            if not len(ok):
                continue
            h = hashes(self.text[c:c + size + window])
            # smallest hash, then leftmost place, among the places of a window: by doubling
            low = (h & ~np.uint64((1 << 22) - 1)) | np.arange(len(h), dtype=np.uint64)
            reach = 1
            while reach < width:
                step = min(reach, width - reach)
                low = np.minimum(low[:-step], low[step:])
                reach += step
            anchor = (low[ok] & np.uint64((1 << 22) - 1)).astype(np.int64)
            cut = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (ok[1:] != ok[:-1] + 1)])
            first, last = ok[cut], ok[np.r_[cut[1:] - 1, len(ok) - 1]]
            found.append((h[anchor[cut]], first + c, last + c, h[first] * np.uint64(3) + h[last + window - SEED_BYTES]))
        kinds = (np.uint64, np.int64, np.int64, np.uint64)
        cols = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.empty(0, k) for k in kinds]
        self.hash, self.first, self.last, self.ends = cols
        self.doc = np.searchsorted(self.begin, self.first, side="right") - 1
        self.sizes = sizes

    def keys(self, buckets: int) -> np.ndarray:
        """Bucket of the hash in the upper bits, 40 of its bits below: sorted keys are grouped by bucket.

        Anchors have the smallest hashes of their windows, so the hash is mixed once more: else the first buckets hold most of them.
        """
        bucket = (((self.hash * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        return (bucket << np.uint64(40)) | (self.hash & _LOW)


def _five(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _eight(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _slices(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of each run of equal buckets."""
    if len(bucket):
        edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        for a, b in zip(edge, [*edge[1:], len(bucket)], strict=True):
            yield int(bucket[a]), int(a), int(b)


def _batches(size: int):
    """Rows of (batch, ids, texts, rows, n_bytes) with a few MB of text each; names are new in every attempt."""

    def out(ids, texts, rows, kind):
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(kind), pa.int64()]
        values = [uuid.uuid4().int >> 65, ids, texts, rows, sum(map(len, texts))]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds, strict=True)], ["batch", "ids", "texts", "rows", "n_bytes"])

    def run(docs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, rows, held, kind = [], [], [], 0, pa.null()
        for b in pieces(docs, "text", size):
            kind = b.schema.field("row").type
            for i, t, r in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), b.column("row").to_pylist(), strict=True):
                ids.append(i)
                texts.append(t)
                rows.append(r)
                held += len(t)
                if held >= size:
                    yield out(ids, texts, rows, kind)
                    ids, texts, rows, held = [], [], [], 0
        if ids:
            yield out(ids, texts, rows, kind)

    return run


def _ids(values: list[int | None]) -> np.ndarray:
    return np.array([LAST if v is None else v for v in values], np.int64)


def _anchor_rows(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for k in range(rows.num_rows):
                batch, ids, texts = (rows.column(c)[k].as_py() for c in range(3))
                r, ids = Runs(texts, window), _ids(ids)
                keys = r.keys(buckets)
                by = np.lexsort((r.ends, keys))
                keys, doc, ends = keys[by], ids[r.doc[by]], r.ends[by]
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
                several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first) if len(first) else np.empty(0, bool)
                # contexts that differ at an end: about as many as there are
                other = np.r_[True, (keys[1:] != keys[:-1]) | (ends[1:] != ends[:-1])][:len(keys)]
                many = np.minimum(np.add.reduceat(other, first, dtype=np.int64), 65_535).astype("<u2") if len(first) else np.empty(0, "<u2")
                keys = keys[first]
                out = [(b, batch, _five(keys[x:y]), np.packbits(several[x:y]).tobytes(), _squeezed(many[x:y].tobytes())) for b, x, y in _slices((keys >> np.uint64(40)).astype(np.int64))]
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["bucket", "batch", "keys", "several", "many"])

    return run


def _shared_bits(hot: int, window: int):
    def run(rows: pa.Table) -> pa.Table:
        """For each batch of a bucket a bit per key: whether two documents have it; and (place of the key, parts) of those split."""
        batch = rows.column("batch").to_pylist()
        keys = [_eight(x) for x in rows.column("keys").to_pylist()]
        several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(rows.column("several").to_pylist(), keys, strict=True)])
        many = np.frombuffer(b"".join(_loosened(x) for x in rows.column("many").to_pylist()), "<u2")
        _, at, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        both = n > 1
        np.logical_or.at(both, at, several > 0)
        total = np.bincount(at, many).astype(np.int64)
        # cut into single windows at worst
        parts = np.where(total > hot, -(-total * (window - SEED_BYTES + 1) // hot), 1)
        ends = np.cumsum([len(k) for k in keys])[:-1]
        kept = []
        for b, x, p in zip(batch, np.split(both[at], ends), np.split(parts[at], ends), strict=True):
            if x.any():
                split = np.flatnonzero(x & (p > 1))
                pairs = np.stack([split, p[split]], axis=1).astype("<u4").tobytes() if len(split) else None
                kept.append((b, rows.column("bucket")[0].as_py(), np.packbits(x).tobytes(), pairs))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array([k[c] for k in kept], t) for c, t in enumerate(kinds)], ["batch", "bucket", "bits", "splits"])

    return run


def _dealt(r: Runs, window: int, used: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place among ``used``, first window, last window, part) of the used runs, those of several parts (from 1) cut where the part changes.

    A window's part is a hash of its bytes at both ends and in the middle, so equal windows have the same.
    """
    whole, cut = np.flatnonzero(parts == 1), np.flatnonzero(parts > 1)
    if not len(cut):
        return whole, r.first[used], r.last[used], np.zeros(len(used), np.int64)
    size = r.last[used[cut]] - r.first[used[cut]] + 1
    of = np.repeat(cut, size)
    place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + r.first[used[of]]
    h = hashes(r.text, place)
    for k in ((window - SEED_BYTES) // 2, window - SEED_BYTES):
        h = (h ^ h >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + hashes(r.text, place + k)
    h ^= h >> np.uint64(32)
    part = 1 + (h % parts[of].astype(np.uint64)).astype(np.int64)
    edge = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (part[1:] != part[:-1])])
    stop = np.r_[edge[1:], len(of)] - 1
    return np.r_[whole, of[edge]], np.r_[r.first[used[whole]], place[edge]], np.r_[r.last[used[whole]], place[stop]], np.r_[np.zeros(len(whole), np.int64), part[edge]]


class Contexts:
    """The distinct contexts of a batch's shared anchors, in order of group and first place.

    A group is a bucket; parts of a split anchor are groups of their own behind the buckets.
    """

    def __init__(self, texts: list[bytes], bits: dict[int, bytes], splits: dict[int, bytes | None], window: int, buckets: int) -> None:
        r = Runs(texts, window)
        keys, at = np.unique(r.keys(buckets), return_inverse=True)
        shared, parts = np.zeros(len(keys), bool), np.ones(len(keys), np.int64)
        for b, x, y in _slices((keys >> np.uint64(40)).astype(np.int64)):
            if b in bits:
                shared[x:y] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=y - x)
                pairs = np.frombuffer(splits[b] or b"", "<u4").reshape(-1, 2).astype(np.int64)
                parts[x + pairs[:, 0]] = pairs[:, 1]
        used = np.flatnonzero(shared[at]) if len(at) else np.empty(0, np.int64)
        of, self.first, last, part = _dealt(r, window, used, parts[at[used]] if len(used) else np.empty(0, np.int64))
        #: Runs of shared anchors: first window, document, and the number of the context of each.
        self.doc, self.sizes = r.doc[used[of]], r.sizes
        raw, seen = r.text.tobytes(), {}
        group = (keys[at[used[of]]] >> np.uint64(40)).astype(np.int64) + buckets * part if len(used) else np.empty(0, np.int64)
        number = [seen.setdefault((g, raw[a:b]), len(seen)) for g, a, b in zip(group.tolist(), self.first.tolist(), (last + window).tolist(), strict=True)]
        number = np.array(number, np.int64)
        bucket = np.zeros(len(seen), np.int64)
        bucket[number] = group
        by = np.argsort(bucket, kind="stable")
        place = np.empty(len(seen), np.int64)
        place[by] = np.arange(len(seen))
        values = [v for _, v in seen]
        self.values, self.bucket, self.number = [values[i] for i in by], bucket[by], place[number]


def _only(table: pa.Table) -> tuple[int, list[int | None], list[bytes]]:
    """The values of the one row of a batch."""
    return tuple(table.column(c)[0].as_py() for c in ("batch", "ids", "texts"))


def _context_rows(window: int, buckets: int):
    def run(docs: pa.Table, bits: pa.Table) -> pa.Table:
        kinds, names = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()], ["bucket", "batch", "sizes", "bytes", "least"]
        out = []
        if docs.num_rows and bits.num_rows:
            batch, ids, texts = _only(docs)
            of, bit, split = (bits.column(x).to_pylist() for x in ("bucket", "bits", "splits"))
            c = Contexts(texts, dict(zip(of, bit, strict=True)), dict(zip(of, split, strict=True)), window, buckets)
            least = np.full(len(c.values), LAST, np.int64)
            np.minimum.at(least, c.number, _ids(ids)[c.doc])
            for b, x, y in _slices(c.bucket):
                sizes = np.array([len(v) for v in c.values[x:y]], "<u4").tobytes()
                out.append((b, batch, _squeezed(sizes), _squeezed(b"".join(c.values[x:y])), _squeezed(least[x:y].tobytes())))
        return pa.Table.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names)

    return run


def _least_ids(window: int):
    def run(rows: pa.Table) -> pa.Table:
        """For the contexts of a bucket: runs of windows (context, from, to) with the smallest id of each."""
        seen: dict[bytes, int] = {}
        least: list[int] = []
        per = []
        for sizes, raw, ids in zip(*(rows.column(c).to_pylist() for c in ("sizes", "bytes", "least")), strict=True):
            ends = np.cumsum(np.frombuffer(_loosened(sizes), "<u4"), dtype=np.int64)
            raw, number, a = _loosened(raw), [], 0
            for b, i in zip(ends.tolist(), np.frombuffer(_loosened(ids), np.int64).tolist(), strict=True):
                k = seen.setdefault(raw[a:b], len(seen))
                if k == len(least):
                    least.append(i)
                elif i < least[k]:
                    least[k] = i
                number.append(k)
                a = b
            per.append(np.array(number, np.int64))
        text = np.frombuffer(b"".join(seen) + bytes(window + 16), np.uint8)
        size = np.array([len(v) for v in seen], np.int64)
        begin = np.cumsum(size) - size
        count = size - window + 1
        # windows: all places of a context but its last ones
        owner = np.repeat(np.arange(len(size)), count)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + begin[owner]
        wanted = np.zeros(len(text), bool)
        wanted[place] = True
        order = two_stage(text, wanted, window)
        first = np.flatnonzero(common_prefixes(text, order, window) < window)
        ids = np.array(least, np.int64)[np.searchsorted(begin, order, side="right") - 1]
        best = np.empty(len(text), np.int64)
        best[order] = np.repeat(np.minimum.reduceat(ids, first), np.diff(np.r_[first, len(order)]))
        best = best[place]
        # runs of equal answers inside a context
        cut = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (best[1:] != best[:-1])])
        stop = np.r_[cut[1:], len(owner)]
        of, a, b, best = owner[cut], place[cut] - begin[owner[cut]], place[stop - 1] - begin[owner[cut]], best[cut]
        at = np.searchsorted(of, np.arange(len(size) + 1))
        out = []
        for batch, number in zip(rows.column("batch").to_pylist(), per, strict=True):
            n = at[number + 1] - at[number]
            pick = np.repeat(at[number] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            which = np.repeat(np.arange(len(number)), n)
            packed = which.astype("<u4").tobytes() + a[pick].astype("<u2").tobytes() + b[pick].astype("<u2").tobytes() + best[pick].astype("<i8").tobytes()
            out.append((batch, rows.column("bucket")[0].as_py(), _squeezed(packed)))
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        return pa.Table.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], ["batch", "bucket", "answers"])

    return run


def _removal(window: int, buckets: int):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        kinds, names = [pa.int64(), pa.int64(), span, pa.binary(), pa.string(), docs.schema.field("rows").type.value_type], ["doc_id", "n_bytes", "spans", "kept", "kept_text", "row"]
        if not docs.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in kinds], names)
        _, ids, texts = _only(docs)
        given = docs.column("rows")[0].as_py()
        number = _ids(ids)
        cols = {c: known.column(c).to_pylist() for c in ("bucket", "bits", "splits", "answers")}
        bits = {b: x for b, x in zip(cols["bucket"], cols["bits"], strict=True) if x is not None}
        splits = {b: x for b, x, y in zip(cols["bucket"], cols["splits"], cols["bits"], strict=True) if y is not None}
        answers = {b: x for b, x in zip(cols["bucket"], cols["answers"], strict=True) if x is not None}
        edges = None
        if answers:
            c = Contexts(texts, bits, splits, window, buckets)
            of, a, b, best = [], [], [], []
            for k, x, _ in _slices(c.bucket):
                raw = _loosened(answers[k])
                n = len(raw) // 16
                of.append(np.frombuffer(raw, "<u4", n).astype(np.int64) + x)
                a.append(np.frombuffer(raw, "<u2", n, 4 * n).astype(np.int64))
                b.append(np.frombuffer(raw, "<u2", n, 6 * n).astype(np.int64))
                best.append(np.frombuffer(raw, "<i8", n, 8 * n))
            of, a, b, best = (np.concatenate(v) for v in (of, a, b, best))
            at = np.searchsorted(of, np.arange(len(c.values) + 1))
            n = at[c.number + 1] - at[c.number]
            pick = np.repeat(at[c.number] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            run_ = np.repeat(np.arange(len(c.first)), n)
            gone = best[pick] < number[c.doc[run_]]
            start = c.first[run_[gone]]
            edges = np.zeros(int(c.sizes.sum()) + 1, np.int32)
            np.add.at(edges, start + a[pick[gone]], 1)
            np.add.at(edges, start + b[pick[gone]] + window, -1)
        rows, begin = [], 0
        removed = None if edges is None else np.cumsum(edges[:-1]) > 0
        for i, t, r in zip(ids, texts, given, strict=True):
            part = None if removed is None else removed[begin:begin + len(t)]
            begin += len(t)
            if part is None or not part.any():
                rows.append((i, len(t), [], t, None, r))
                continue
            turn = np.flatnonzero(np.diff(np.r_[False, part, False].astype(np.int8)))
            spans = [{"start": int(x), "end": int(y)} for x, y in zip(turn[::2], turn[1::2], strict=True)]
            raw = np.frombuffer(t, np.uint8)
            # a character that lost a byte is no longer one
            char = np.cumsum((raw & 0xC0) != 0x80)
            whole = np.bincount(char[part], minlength=char[-1] + 1) == 0
            rows.append((i, len(t), spans, raw[~part].tobytes(), raw[whole[char]].tobytes().decode(), r))
        return pa.Table.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return run


def _forget(spark: SparkSession, table: str) -> None:
    """Takes the batches' table out of the catalog when Python exits; results are read from it until then."""
    if spark.sparkContext._jsc is not None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, batch_bytes: int = BATCH, hot: int = HOT) -> DataFrame:
    """Removes repeated byte strings from every whole text.

    Returns doc_id, n_bytes, spans (removed byte ranges, start and end, maximal
    and in order), kept (the remaining bytes), kept_text (null if nothing is removed, else the characters that are
    whole) and row (the other columns of the input row, as a struct), one row per input row. A null
    text is empty. Rows with one id don't remove from each other; rows without
    an id come after all others, and their doc_id stays null. ``hot``: contexts of one anchor that a task sorts.
    """
    if not 24 <= window <= 60_000:
        raise ValueError("the window must be 24 to 60000 bytes")
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    name = f"suffix_dedup_{uuid.uuid4().hex}"
    rest = F.struct(*[docs[c] for c in docs.columns if c != text_col]).alias("row")
    chosen = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), rest)
    kind = chosen.schema["row"].dataType
    held = StructType.fromDDL("batch long, ids array<long>, texts array<binary>").add("rows", ArrayType(kind)).add("n_bytes", "long")
    batched = chosen.mapInArrow(_batches(batch_bytes), held)
    batched.write.bucketBy(parts, "batch").option("path", scratch_path(spark, name)).option("compression", "zstd").saveAsTable(name)
    atexit.register(_forget, spark, name)
    kept = spark.table(name)
    buckets = max(BUCKETS * parts, -(-(kept.agg(F.sum("n_bytes")).first()[0] or 0) // BUCKET_BYTES))
    batches = kept.drop("n_bytes")

    anchors = batches.mapInArrow(_anchor_rows(window, buckets), "bucket long, batch long, keys binary, several binary, many binary")
    bits = stored(anchors.groupBy("bucket").applyInArrow(_shared_bits(hot, window), "batch long, bucket long, bits binary, splits binary"), "suffix-bits")
    contexts = batches.groupBy("batch").cogroup(bits.groupBy("batch")).applyInArrow(_context_rows(window, buckets), "bucket long, batch long, sizes binary, bytes binary, least binary")
    answers = stored(contexts.groupBy("bucket").applyInArrow(_least_ids(window), "batch long, bucket long, answers binary"), "suffix-answers")
    none = F.lit(None).cast("binary")
    known = bits.withColumn("answers", none).unionByName(answers.withColumns({"bits": none, "splits": none}))
    return batches.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(_removal(window, buckets), schema_of("doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary, kept_text string", chosen))
