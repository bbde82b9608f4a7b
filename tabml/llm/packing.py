"""Packing of tokenized documents into fixed-length sequences by the sum-of-squares rule.

State of a pack: the number N(g) of open sequences with each residual gap g. A
document goes where the sum of the N(g)^2 becomes smallest; that keeps many
different gaps on offer (Csirik et al., "On the Sum-of-Squares Algorithm for Bin
Packing", 2006). Order is free, as all documents of a pack are there: the longest
come first. The rule chooses among the open gaps that hold the document; a new sequence is
opened where none does (``any_fit``). Left to weigh a new sequence too, as for documents that come one
by one, the rule opens more of them (README has the figures).

Documents are dealt into packs of bounded size by a hash of their row. The emptiest sequences
of a pack, an eighth of its documents at most, go on to the next round, where
eight packs meet in one, until one is left; the others are final. A round keeps
the arrangement that it was given unless its own has fewer sequences.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import id_text, pieces, shuffle_partitions, stored

#: Documents of a pack, and packs of a round that meet in one pack of the next.
PACK, MERGE = 8192, 8
#: Only here do the two libraries surely agree on letters and spaces.
_PLAIN = re.compile("[^\t\n\r -~À-ÖØ-öø-ɏ]")


class Tokens:
    """Ids of whole texts by the tokenizers library.

    ``ranks``: the same vocabulary as a rank file and its split pattern, by
    which tiktoken makes the same ids several times faster. Used for texts of
    ASCII and Latin letters that hold no special token's string.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import base64

            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast and not (_PLAIN.search(text) or any(s in text for s in self.special)):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def tokens(path: str, ranks: str | None, pattern: str | None) -> Tokens:
    """The tokenizer of a file, once per worker."""
    return Tokens(path, ranks, pattern)


def token_pieces(docs: DataFrame, tokenizer: tuple[str, str | None, str | None], end_id: int, capacity: int = 1024, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document cut to ``capacity``.

    A document is its ids and ``end_id``; only one longer than the capacity is
    cut, into full pieces, of which the first may be shorter.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    kinds = ["long", "int", "long", "long", "long", "array<int>"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokens(*tokenizer)
        for b in pieces(batches, "text", 1 << 20):
            rows: list[tuple] = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = np.append(t.ids(text).astype("<u4"), np.uint32(end_id))
                first = len(ids) % capacity or min(len(ids), capacity)
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((doc, k, x, y - x, zlib.crc32(ids[x:y].tobytes()), *([ids[x:y].astype(np.int32)] if keep_ids else [])))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types)], names)

    return id_text(docs, id_col, text_col).mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def sum_of_squares(sizes: np.ndarray, capacity: int, any_fit: bool = False) -> np.ndarray:
    """The sequence number of each size, placed in the given order; ``any_fit``: a new one only where no open gap is large enough."""
    count = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, made = np.empty(len(sizes), np.int64), 0
    for i, s in enumerate(sizes.tolist()):
        # change of the sum for each gap from s on; the last entry is a new sequence
        change = 2 * (count[:capacity + 1 - s] - count[s:]) + 2
        change[0] -= 2 * count[0] + 1  # a gap of 0 is no open sequence
        change[:-1][count[s:capacity] == 0] = 1 << 60
        change[-1] = 1 << 59 if any_fit else 2 * count[capacity - s] + 1 if s < capacity else 0
        gap = s + int(change.argmin())
        if gap == capacity:
            bin_, made = made, made + 1
        else:
            bin_ = open_at[gap].pop()
            count[gap] -= 1
        if gap > s:
            count[gap - s] += 1
            open_at[gap - s].append(bin_)
        where[i] = bin_
    return where


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """A sequence number for each size, placed from the longest to the shortest."""
    order = np.argsort(-sizes, kind="stable")
    where = np.empty(len(sizes), np.int64)
    where[order] = sum_of_squares(sizes[order], capacity, any_fit=True)
    return where


def _packed(capacity: int, level: int, pack_size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "uid"], ignore_index=True)
        sizes = pdf["length"].to_numpy()
        where = pack(sizes, capacity)
        if level and pdf["sequence_id"].nunique() <= where.max() + 1:
            where = None  # what it was given is as good
        else:
            pdf["sequence_id"] = (level << 58) + (int(pdf["pack"].iat[0]) << 20) + where
        by = pdf.groupby("sequence_id")["length"]
        pdf["offset"] = by.cumsum() - pdf["length"]
        fill = by.agg(["sum", "size"]).sort_values("sum")
        open_ = fill.index[(fill["size"].cumsum() <= pack_size // MERGE) & (fill["sum"] < capacity)]
        pdf["full"] = ~pdf["sequence_id"].isin(open_)
        return pdf

    return run


def best_fit(items: DataFrame, capacity: int = 1024, pack_size: int = PACK) -> DataFrame:
    """uid, sequence_id, offset of items (uid: unique long, length up to ``capacity``)."""
    full = items.filter(F.col("length") >= capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = items.filter(F.col("length") < capacity).select("uid", "length", F.col("h"))
    packs = max(1, -(-short.count() // pack_size))
    now = short.select("uid", "length", "h", F.pmod("h", F.lit(packs)).alias("pack"), F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"), F.lit(False).alias("full"))
    done, level = [full], 0
    while True:
        # a number of partitions: rows are small and the work on them is not, so merging by size would leave few tasks
        dealt = now.repartition(min(packs, shuffle_partitions(items.sparkSession)), "pack")
        now = stored(dealt.groupBy("pack").applyInPandas(_packed(capacity, level, pack_size), now.schema), f"packing-{level}")
        last = packs == 1
        done.append((now if last else now.filter("full")).select("uid", "sequence_id", "offset"))
        if last:
            break
        level, packs = level + 1, -(-packs // MERGE)
        now = now.filter(~F.col("full")).withColumn("pack", F.floor(F.col("pack") / MERGE).cast("long"))
    out = done[0]
    for x in done[1:]:
        out = out.union(x)
    return out


def pack_documents(docs: DataFrame, tokenizer: tuple[str, str | None, str | None], end_id: int, capacity: int = 1024, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text", pack_size: int = PACK) -> DataFrame:
    """Packs documents into sequences of at most ``capacity`` tokens.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32 (unsigned,
    of the ids as little-endian unsigned 32-bit numbers), sequence_id, offset
    (and ids). A null or empty text is its end id alone; repeated rows are
    packed as often as given; a null id stays null; an empty table gives none.
    """
    cut = token_pieces(docs, tokenizer, end_id, capacity, keep_ids, id_col, text_col)
    cut = stored(cut.withColumn("uid", F.monotonically_increasing_id()), "packing")
    placed = best_fit(cut.select("uid", "length", F.xxhash64("uid").alias("h")), capacity, pack_size)
    return cut.join(placed, "uid").drop("uid")
