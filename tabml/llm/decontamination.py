"""Passages of benchmark items in documents, by winnowing (Schleimer, Wilkerson, Aiken, "Winnowing: local algorithms
for document fingerprinting", 2003).

A fingerprint is the smallest hash of k words among the w neighbouring k-grams of a window of k + w - 1 words (ties:
the last). It depends on the window's words alone, so a window that an item and a document share has the same
fingerprint at the same place in both: no span of that many words is missed. With k = 5 and w = 6 a window has 10 words;
items of fewer words, n, are one window of their own with k = ceil(n / 2).

1. Fingerprints of items are stored with the windows that chose them; so are, per document, those whose fingerprint
   passes a sieve of the items' fingerprints (bounded size, nothing missed) and whose whole window passes one of the
   items' windows.
2. Both are joined by fingerprint and, as its extension to the whole window, by a second 64-bit hash of all its words.
   What is left is what both texts hold; neighbouring windows merge into spans.

Equal windows are those of equal length and equal hashes, of 64 bits each, of the fingerprint and of the whole window
(sums of words' XXH64, weighted by place).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import stored
from tabml.llm.words import Sieve, cut, hashes, make_sieve, mixed, words_of

#: Text and rows that a worker holds at once.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 65_536
#: Seeds of the words' hashes for fingerprints and for windows.
_SEEDS = (11, 12)

_SPANS = "array<struct<start: int, end: int>>"
_ITEM = "item string, size int, print long, whole long"
_DOC = "row long, doc_id long, n_words long, size array<int>, start array<int>, print array<long>, whole array<long>"


def grams(size: int) -> tuple[int, int]:
    """(k, w): words of a k-gram, and k-grams of a window of ``size`` words."""
    k = (size + 1) // 2
    return k, size - k + 1


def _sums(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n neighbouring word hashes: an odd weight for each place, then all bits mixed."""
    weight = mixed(np.arange(1, n + 1)) | np.uint64(1)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        total += h[j: len(h) - n + 1 + j] * weight[j]
    return mixed(total)


def windows(first: np.ndarray, second: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, fingerprint, hash of the whole) of every window of ``size`` words within one text.

    ``first``, ``second``: two hashes of every word; ``text``: the text of each word.
    """
    if len(first) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    k, w = grams(size)
    prints = _sums(first, k)
    n = len(first) - size + 1
    least = prints[:n]
    for j in range(1, w):
        least = np.minimum(least, prints[j: n + j])
    start = np.flatnonzero(text[size - 1:] == text[:n])
    return start, least[start], _sums(second, size)[start]


def _word_hashes(batch: pa.RecordBatch):
    w = words_of(batch.column("text"))
    first, second = (hashes(w.distinct, seed)[w.code] if len(w.code) else np.zeros(0, np.uint64) for seed in _SEEDS)
    return w, first, second


def _item_windows(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, BATCH_BYTES, BATCH_ROWS):
            w, first, second = _word_hashes(batch)
            end = np.cumsum(w.count)
            begin = end - w.count
            names = batch.column("item")
            size_of = np.minimum(w.count, longest)[w.text]
            for size in np.unique(size_of):
                start, least, whole = windows(first, second, w.text, int(size))
                # items of fewer words than a window are one, others have windows of the full size only
                of = w.text[start]
                ok = (w.count[of] >= longest) if size == longest else (w.count[of] == size) & (start == begin[of])
                yield pa.RecordBatch.from_arrays([
                    names.take(pa.array(of[ok])), pa.array(np.full(int(ok.sum()), size), pa.int32()), pa.array(least[ok].view(np.int64)), pa.array(whole[ok].view(np.int64)),
                ], ["item", "size", "print", "whole"])

    return run


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _document_windows(sizes: list[int], prints: Sieve, wholes: Sieve):
    """A row per document, with its windows that pass both sieves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 32
        for batch in cut(batches, BATCH_BYTES, BATCH_ROWS):
            w, first, second = _word_hashes(batch)
            begin, text, found = np.cumsum(w.count) - w.count, w.text, []
            for size in sizes:
                start, least, whole = windows(first, second, text, size)
                # a fingerprint is chosen by several neighbouring windows
                change = np.flatnonzero(np.diff(least, prepend=~least[:1]) != 0)
                ok = np.repeat(prints.passes(least[change]), np.diff(change, append=len(least)))
                start, least, whole = start[ok], least[ok], whole[ok]
                ok = wholes.passes(whole)
                start, least, whole = start[ok], least[ok], whole[ok]
                found.append((text[start], np.full(len(start), size), start - begin[text[start]], least.view(np.int64), whole.view(np.int64)))
            of, size, start, least, whole = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * 5))
            order = np.argsort(of, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(of.astype(np.int64), minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + batch.num_rows)), batch.column("doc_id"), pa.array(w.count, pa.int64()), _lists(size[order], ends, pa.int32()),
                _lists(start[order], ends, pa.int32()), _lists(least[order], ends, pa.int64()), _lists(whole[order], ends, pa.int64()),
            ], ["row", "doc_id", "n_words", "size", "start", "print", "whole"])
            row += batch.num_rows

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals by start, as one each where they touch or overlap."""
    for batch in batches:
        starts, ends = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "end"))
        count = pa.compute.list_value_length(batch.column("start")).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(batch.num_rows), count)
        # rows lie apart from each other, so that one running maximum does for all
        reach = np.maximum.accumulate(ends + (row << 32))
        new = np.flatnonzero(starts + (row << 32) > np.concatenate([[-1], reach[:-1]])) if len(row) else row
        last = reach[np.append(new[1:], len(row)) - 1] - (row[new] << 32)
        spans = pa.StructArray.from_arrays([pa.array(starts[new], pa.int32()), pa.array(last, pa.int32())], ["start", "end"])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=batch.num_rows))])
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), batch.column("owners")], ["row", "spans", "owners"])


def find_passages(
    docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """Which words of each document stand in a passage of ``size`` words that an item holds too.

    Returns a row per row of ``docs``: doc_id (long), n_words, spans (array of start and end words, end excluded;
    apart and rising), items (array of the ids, as strings, sorted, of the items whose windows occur). Words are runs of
    ASCII letters (in lower case), digits and characters beyond ASCII. An item of fewer words than ``size``, but not
    none, is one window.

    Null or empty texts have no words. Equal items, or several rows of an item, count once; an item without an id
    marks words but is not named. Repeated rows of ``docs`` each get a row, whatever their id; long texts are read whole;
    without items or documents nothing is hit. Further columns don't matter.
    """
    asked = items.select(items[item_col].cast("string").alias("item"), F.coalesce(items[item_text_col].cast("string"), F.lit("")).alias("text"))
    seen = asked.mapInArrow(_item_windows(size), _ITEM).distinct()
    # the items of a window, under one number however many windows have them
    owners = seen.groupBy("size", "print", "whole").agg(F.array_sort(F.collect_set("item")).alias("items"))
    owners = stored(owners.withColumn("owners", F.md5(F.to_json("items"))), "winnow-windows")
    sizes = sorted(r["size"] for r in owners.select("size").distinct().collect())
    prints, wholes = make_sieve(owners.select("print").distinct(), "print"), make_sieve(owners.select("whole"), "whole")

    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    rows = stored(texts.mapInArrow(_document_windows(sizes, prints, wholes), _DOC), "winnow-documents")
    likely = rows.select("row", F.inline(F.arrays_zip("size", "start", "print", "whole")))
    hits = likely.join(owners.select("size", "print", "whole", "owners"), ["size", "print", "whole"])
    hits = hits.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("found"), F.array_sort(F.collect_set("owners")).alias("owners"))
    hits = hits.select("row", "found.start", "found.end", "owners").mapInArrow(_merge, f"row long, spans {_SPANS}, owners array<string>")

    # hits are not stored, as both uses below share the exchange by row; documents with the same windows' owners share a list of items
    named = owners.select(F.col("owners").alias("owner"), "items").dropDuplicates(["owner"])
    lists = hits.select("owners").distinct().withColumn("owner", F.explode("owners")).join(named, "owner")
    lists = lists.select("owners", F.explode("items").alias("item")).groupBy("owners").agg(F.array_sort(F.collect_set("item")).alias("items"))
    marked = hits.join(lists, "owners", "left").select("row", "spans", "items")
    return rows.select("row", "doc_id", "n_words").join(marked, "row", "left").select(
        "doc_id", "n_words", F.coalesce("spans", F.expr(f"cast(array() as {_SPANS})")).alias("spans"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))
