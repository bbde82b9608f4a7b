"""Words of whole batches of texts as NumPy arrays, and a bounded sieve for their hashes.

Separators and A to Z are ASCII, and no byte of a longer UTF-8 character is, so
words are found in the bytes: one table maps every byte to its lower case or to
a separator, runs of other bytes are words, and Arrow numbers the distinct ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - binds pa.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK, BREAK = 0x20, 0x0A


def byte_table(blank: Callable[[int], bool], breaks: bytes = b"") -> bytes:
    """What each byte becomes: blank or break (between pieces) for separators, lower case for A to Z, else itself."""
    return bytes(BREAK if b in breaks else BLANK if blank(b) else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


#: Words are runs of digits, letters and bytes beyond ASCII: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A to Z are lower case.
ALNUM = byte_table(lambda b: b < 0x80 and not chr(b).isalnum())


@dataclass
class Words:
    """The words of the texts of a batch, in order: ``code`` numbers ``distinct``; ``count`` words belong to each
    text; ``piece`` is the same for words of one text without a break between them, and grows."""

    code: np.ndarray
    distinct: pa.Array
    count: np.ndarray
    piece: np.ndarray

    @property
    def text(self) -> np.ndarray:
        """The place in the batch of each word's text."""
        return np.repeat(np.arange(len(self.count)), self.count)


def words_of(texts: pa.Array, table: bytes = ALNUM) -> Words:
    """The words of every text; a null text has none."""
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return Words(np.zeros(0, np.int32), pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64))
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    raw = (data.slice(at[0], at[-1] - at[0]).to_pybytes() if data is not None else b"").translate(table)
    buf, at = np.frombuffer(raw, np.uint8), at - at[0]
    inside = (buf != BLANK) & (buf != BREAK)
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < len(buf))]  # two texts may meet without a separator
    start[edge], end[edge - 1] = inside[edge], inside[edge - 1]
    first, last = np.flatnonzero(start), np.flatnonzero(end) + 1
    offsets = np.zeros(len(first) + 1, np.int32)
    np.cumsum(last - first, out=offsets[1:])
    found = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buf[inside])))
    coded = found.dictionary_encode()
    count = np.diff(np.searchsorted(first, at))
    piece = np.repeat(np.arange(len(count)), count)
    breaks = np.flatnonzero(buf == BREAK)
    if len(breaks):
        piece = piece + np.searchsorted(breaks, first)
    return Words(coded.indices.to_numpy(), coded.dictionary, count, piece)


def hashes(distinct: pa.Array, seed: int = 0) -> np.ndarray:
    """XXH64 of each string."""
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(x, seed) for x in distinct.to_pylist()), np.uint64, len(distinct))


def cut(batches: Iterator[pa.RecordBatch], limit: int, rows: int, text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of about ``limit`` bytes of text and at most ``rows`` rows; a longer text is one of its own."""
    for batch in batches:
        size = np.cumsum(pa.compute.binary_length(batch.column(text_col)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            stop = min(start + rows, max(start + 1, int(np.searchsorted(size, before + limit, side="right"))))
            yield batch.slice(start, stop - start)
            start = stop


# ------------------------------------------------------------------- sieve

#: Bits of a sieve: at least, at most (16 MB), and for each hash.
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 16, 1 << 27, 16


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of SplitMix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Sieve:
    """A Bloom filter: passes every hash it was made of, and few others. Its size is bounded whatever it holds;
    what passes is joined, so that an overfull sieve costs time and no answer changes."""

    words: np.ndarray

    def passes(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(h), bool)
        shift = np.uint64(64 - int(len(self.words) * 64).bit_length() + 1)
        low = h.view(np.uint64) if h.dtype == np.int64 else h
        ok = np.ones(len(h), bool)
        for bit in (low >> shift, (low << np.uint64(32)) >> shift):
            ok &= (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
        return ok


def make_sieve(hashed: DataFrame, column: str = "h") -> Sieve:
    """A sieve of a column of 64-bit hashes. Executors set the bits; the driver receives at most 16 MB of them."""
    n = hashed.count()
    if not n:
        return Sieve(np.zeros(0, np.uint64))
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * n - 1).bit_length()))
    shift = 64 - (bits.bit_length() - 1)
    h = F.col(column)
    places: list[Column] = [F.shiftrightunsigned(h, shift), F.shiftrightunsigned(F.shiftleft(h, 32), shift)]
    place = F.explode(F.array(*places))
    rows = hashed.select(place.alias("at")).select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63L as int))").alias("bit"))
    got = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    words = np.zeros(bits // 64, np.uint64)
    words[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return Sieve(words)
