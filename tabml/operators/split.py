"""Repeatable train/test splits and cross-validation folds.

``exact_split`` takes exactly the stated share of each label.

The hash split decides each row by ``md5(key)``, so it does not depend on
partitioning, file order, executor count or retries, and needs no shuffle or
sort (``randomSplit`` sorts each partition and depends on the partitioning).
Keying by a group key (e.g. an order key) keeps a group on one side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.expressions import hash_bucket, split_label
from tabml.operators.columns import qcol
from tabml.operators.numbering import row_numbers


def with_split(df: DataFrame, keys: Sequence[str] | str, train_percent: int = 70,
               name: str = "split") -> DataFrame:
    return df.withColumn(name, split_label(keys, train_percent))


def hash_split(df: DataFrame, keys: Sequence[str] | str, train_percent: int = 70):
    """(train, test) by key hash; disjoint and complete."""
    b = hash_bucket(keys)
    return df.where(b < train_percent), df.where(b >= train_percent)


def with_folds(df: DataFrame, keys: Sequence[str] | str, folds: int, name: str = "fold") -> DataFrame:
    """Integer fold in [0, folds) from the key hash (for ``CrossValidator(foldCol=...)``).
    A salt keeps folds independent of the train/test split buckets."""
    if isinstance(keys, str):
        keys = [keys]
    salted = F.concat_ws("|", F.lit("fold"), *[qcol(k).cast("string") for k in keys])
    head = F.conv(F.substring(F.md5(salted), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(name, (head % F.lit(folds)).cast("int"))


ROW_KEY = "_row"


def with_row_key(df: DataFrame, name: str = ROW_KEY) -> DataFrame:
    """Add a per-row key so identical rows are told apart: a split or fold
    keyed by every column plus this key assigns copies independently, so a
    group of copies holding a third of the rows is still split 70/30.
    ``monotonically_increasing_id`` is fixed by the input split and the row's
    place in it: the same on every evaluation and task retry while files and
    split settings stay, but another with other files, splits or core counts.
    For splits that don't depend on those, key by columns."""
    return df.withColumn(name, F.monotonically_increasing_id())


def random_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42):
    """Spark's sampling split, kept for parity; depends on the partitioning."""
    return df.randomSplit(list(weights), seed)


def _hash60(keys: Sequence[str]):
    """60 bits of the md5 of the keys (joined by '|', nulls skipped), as a long."""
    text = F.concat_ws("|", *[qcol(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


#: Bits of the hash that one round of the selection looks at (2^BITS counts per label and task at most), and rows of a
#: bucket whose hashes are then counted one by one.
BITS, FEW = 12, 65_536


def exact_split(df: DataFrame, keys: Sequence[str] | str, label: str | None = None, train_percent: int = 70, name: str = "split") -> DataFrame:
    """``df`` with ``name``: 'train' for exactly ``floor(n * train_percent / 100)`` of the n rows of each value of ``label``
    (null is one of them; without a label: of the table), else 'test'.

    Rows are taken by the hash of their ``keys`` in rising order, so the same rows go to the same side on any layout. The hash at
    which a label's share is reached is found by selection: counts by the highest bits say in which bucket it lies, the next
    round looks at the next bits of that bucket alone; one small row per label and bucket moves, and one bracket per
    label reaches the driver. Rows that share the very hash at the bound (equal keys) are numbered in the order of
    all their columns, so copies are cut exactly as well, however many they are.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    of = F.lit(None).cast("string") if label is None else qcol(label)
    held = df.select(*[qcol(c) for c in df.columns], of.alias("_of"), _hash60(keys).alias("_h"))
    kind = held.schema["_of"].dataType
    want = {r["_of"]: (r["n"] * train_percent) // 100 for r in held.groupBy("_of").agg(F.count("*").alias("n")).collect()}
    if not want:
        return df.withColumn(name, F.lit("train"))
    # first hash of the bracket, rows still wanted inside it, rows inside
    bracket = {v: (0, n, 0) for v, n in want.items()}
    width = 60

    def narrow(step: int) -> None:
        nonlocal width
        inside = F.shiftright("_h", width) == F.shiftright(_per_label(bracket, 0, kind), width)
        counts = held.where(inside).groupBy("_of", F.shiftright("_h", width - step).alias("bucket")).agg(F.count("*").alias("n"))
        upto = F.expr("sum(n) over (partition by _of order by bucket rows between unbounded preceding and current row)")
        reached = counts.withColumn("upto", upto).where(F.col("upto") >= _per_label(bracket, 1, kind)).groupBy("_of").agg(F.min(F.struct("upto", "bucket", "n")).alias("m"))
        width -= step
        for r in reached.collect():
            m = r["m"]
            bracket[r["_of"]] = (m["bucket"] << width, bracket[r["_of"]][1] - (m["upto"] - m["n"]), m["n"])

    narrow(BITS)
    while width and max(n for _, _, n in bracket.values()) > FEW:
        narrow(min(BITS, width))
    if width:
        narrow(width)
    bound, wanted = _per_label(bracket, 0, kind), _per_label(bracket, 1, kind)
    sure = held.where(F.col("_h") != bound).withColumn(name, F.when(F.col("_h") < bound, "train").otherwise("test"))
    # a row per label, unless keys repeat; the tied rows of a label have consecutive numbers
    tied = row_numbers(held.where(F.col("_h") == bound), ["_of", *df.columns], "_n")
    first = {r["_of"]: r["n"] for r in tied.groupBy("_of").agg(F.min("_n").alias("n")).collect()}
    place = F.col("_n") - _per_label({v: (first[v],) for v in bracket}, 0, kind)
    cut = tied.withColumn(name, F.when(place < wanted, "train").otherwise("test")).drop("_n")
    return sure.unionByName(cut).drop("_of", "_h")


def _per_label(values: dict, i: int, kind):
    """The number of a row's label, from one per label."""
    known = [(v, t[i]) for v, t in values.items() if v is not None]
    out = F.lit(None).cast("bigint")
    if known:
        out = F.element_at(F.map_from_arrays(F.array(*[F.lit(v).cast(kind) for v, _ in known]), F.array(*[F.lit(n).cast("bigint") for _, n in known])), F.col("_of"))
    return F.when(F.col("_of").isNull(), F.lit(values[None][i]).cast("bigint")).otherwise(out) if None in values else out


__all__ = ["ROW_KEY", "exact_split", "hash_bucket", "hash_split", "random_split", "with_folds", "with_row_key",
           "with_split"]
