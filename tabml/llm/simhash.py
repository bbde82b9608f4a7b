"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint is eight bytes at fixed positions. Two fingerprints at most
``max_bits`` < 8 bits apart differ in at most that many bytes, so they share at
least ``8 - max_bits`` positional bytes. A posting list holds the distinct
fingerprints that share the bytes at a small set of positions; the sets are
chosen so that any ``8 - max_bits`` positions contain one of them, so every
link meets in a list. Within a list the shared positional bytes are tallied per
pair, pairs that reach the guaranteed count are kept, and the bit distance is
verified. Only a spanning forest of each list's links leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tabml.llm.common import id_text, pieces, stored
from tabml.llm.components import components

SEED = 42
#: Fingerprints of one posting list that a task compares; longer lists are dealt out as pairs of blocks.
BLOCK = 16_384
#: Up to this many fingerprints, all pairs of a list are compared by shifting; above, by search from each found one.
SMALL = 8


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit majority fingerprint of the word shingles of a text (0 without words)."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and split at \x20 \x09-\x0D
    if not words:
        return 0
    if len(words) < shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    ones, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for k in range(0, n, 1 << 14):
        top = min(n, k + (1 << 14))
        h = [xxh64_intdigest(line[s:e - 1], SEED) for s, e in zip(starts[k:top], ends[k + shingle - 1:top + shingle - 1], strict=True)]
        ones += np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), one row per input row, in the tasks that read the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any ``8 - max_bits`` positions contain one of them."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be 0 to 7: beyond, fingerprints may share no byte")
    same = 8 - max_bits
    if same < 4:
        return list(combinations(range(8), same))
    # Turan's system: triples inside a group, or two of one group and one of the next; any four positions contain one
    group = (0, 0, 0, 1, 1, 1, 2, 2)
    count = lambda t: sorted(((sum(group[p] == g for p in t), g) for g in {group[p] for p in t}), reverse=True)
    return [t for t in combinations(range(8), 3) if (c := count(t))[0][0] == 3 or c[0][0] == 2 and c[1][1] == (c[0][1] + 1) % 3]


_LOW = np.uint64(0x0101010101010101)


def _different_bytes(x: np.ndarray) -> np.ndarray:
    """How many positional bytes each pair does not share, from the exclusive or of its fingerprints."""
    x = x | x >> np.uint64(4)  # the lowest bit of each byte gathers the others
    x = x | x >> np.uint64(2)
    x = x | x >> np.uint64(1)
    return np.bitwise_count(x & _LOW)


def _near(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs, by their exclusive or, are within the bit distance: those whose tally of shared positional bytes
    reaches the 8 - ``max_bits`` that such pairs have at least are verified, the others are no candidates."""
    kept = np.flatnonzero(_different_bytes(x) <= max_bits)
    near = np.zeros(len(x), bool)
    near[kept] = _within(x[kept], max_bits)
    return near


def _within(x: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(x) <= max_bits


def _search(fp: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Spanning forest of one list: what is found is never compared with its own component again."""
    left, out_a, out_b = np.arange(len(fp)), [], []
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            p = queue.pop()
            hit = _near(fp[left] ^ fp[p], max_bits)
            if hit.any():
                new = left[hit]
                out_a.append(np.full(len(new), p))
                out_b.append(new)
                queue.extend(new.tolist())
                left = left[~hit]
    return out_a, out_b


def _links(group: np.ndarray, fp: np.ndarray, v: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the runs of equal ``group``."""
    n = len(fp)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    end = np.repeat(first + size, size)
    few = np.flatnonzero(np.repeat(size <= SMALL, size))
    for step in range(1, SMALL):
        few = few[few + step < end[few]]
        if not len(few):
            break
        hit = few[_near(fp[few] ^ fp[few + step], max_bits)]
        out_a.append(v[hit])
        out_b.append(v[hit + step])
    for k in np.flatnonzero(size > SMALL):
        at = slice(first[k], first[k] + size[k])
        for a, b in zip(*_search(fp[at], max_bits), strict=True):
            out_a.append(v[at][a])
            out_b.append(v[at][b])
    return np.concatenate(out_a), np.concatenate(out_b)


def _list_links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by list; the last list of a batch waits for the next batch."""
        held: list[np.ndarray] | None = None

        def out(cols):
            a, b = _links(*cols, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()]
            cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols, strict=True)]
            start = int(np.searchsorted(cols[0], cols[0][-1]))
            if start:
                yield out([x[:start] for x in cols])
            held = [x[start:] for x in cols]
        if held is not None:
            yield out(held)

    return run


def links(prints: DataFrame, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """a, b: a spanning set of the links between distinct fingerprints.

    ``prints``: fp and v, distinct fingerprints with a vertex id each.
    """
    sets = position_sets(max_bits)
    masks = [sum(0xFF << 8 * p for p in s) for s in sets]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    posted = prints.select(
        "fp", "v", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("t", "key")
    )
    size = posted.groupBy("t", "key").agg(F.count("*").alias("n"))
    long = stored(size.filter(F.col("n") > block), "simhash-long")
    dealt = posted.join(long, ["t", "key"], "left")
    blocks = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(block)).cast("int")
    dealt = dealt.withColumn("k", blocks).withColumn("i", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
    # a block meets each block, itself included, in one task; an ordinary list is its own only block
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.struct(F.least("i", j).alias("x"), F.greatest("i", j).alias("y"))))
    rows = dealt.select("t", "key", "fp", "v", pair.alias("p"))
    rows = rows.select(F.xxhash64("t", "key", "p.x", "p.y").alias("list"), "fp", "v")
    return rows.repartition("list").sortWithinPartitions("list").mapInArrow(_list_links(max_bits), "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """Near-duplicate groups of documents by SimHash.

    Returns doc_id, fingerprint (16 lowercase hex digits) and component_id (the
    smallest doc_id reachable over links of at most ``max_bits`` differing
    bits, the document itself included), one row per input row. A null text is
    empty; a text without words has fingerprint zero and links like any other;
    repeated rows come back as often as given. Rows without an id are
    fingerprinted and take part through their fingerprint; their component is
    the smallest id there, else null.
    """
    marks = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    prints = stored(marks.groupBy("fp").agg(F.min("doc_id").alias("v")), "simhash-prints")
    found = components(links(prints.filter("v is not null"), max_bits, block))
    of = prints.join(found, "v", "left").select(F.col("fp").alias("p"), F.coalesce("c", "v").alias("component_id"))
    of = stored(of, "simhash-components")
    return marks.join(of, marks.fp == of.p, "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
