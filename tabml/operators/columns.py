"""Column selection, cleaning and stable samples."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.expressions import is_missing, numeric_fields, qname


def qcol(name: str):
    """A column reference that tolerates any name (dots, blanks, backticks)."""
    return F.col(qname(name))


def sql_str(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: Copies of a row that stay together in a layout, and chunks of them that are listed at once.
CHUNK, CHUNKS = 64, 65_536


def fixed_layout(df: DataFrame, keys: Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """``df`` dealt out over ``partitions`` (default: ``spark.sql.shuffle.partitions``) by a hash
    of ``keys``, or by default evenly (:func:`copies_apart`), each partition in the order of all columns.

    What a partition holds then depends on the rows alone, not on files, splits
    or tasks: work that is sensitive to it (a forest samples its rows by
    partition and place) gives the same result on any layout of the input.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not keys:
        return copies_apart(df, n)
    return df.repartition(n, *[qcol(k) for k in keys]).sortWithinPartitions(*[qcol(c) for c in df.columns])


def copies_apart(df: DataFrame, partitions: int) -> DataFrame:
    """``df`` dealt out by its rows alone, with the copies of a row in chunks of ``CHUNK`` by their ordinal.

    Equal rows are counted (combined before the shuffle, so that a row which a third of the table repeats is one row per
    task), and their chunks are dealt out like any other rows: copies are spread over all partitions, and the same number
    of them lies in each on any layout of the input. -0.0 and 0.0 are equal here and become 0.0; so are all NaN.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    counted = df.toDF(*names).groupBy(*names).agg(F.count("*").alias("n"))
    wide = CHUNK * CHUNKS
    blocks = counted.select(*names, "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {wide})")).alias("block"))
    blocks = blocks.select(*names, "block", F.expr(f"least(n - block * {wide}, {wide}L)").alias("n"))
    chunks = blocks.select(*names, "block", "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {CHUNK})")).alias("chunk"))
    dealt = chunks.repartition(partitions, *names, "block", "chunk")
    copies = dealt.select(*names, F.explode(F.expr(f"sequence(1L, least(n - chunk * {CHUNK}, {CHUNK}L))")).alias("copy"))
    return copies.select(*names).sortWithinPartitions(*names).toDF(*df.columns)


def feature_columns(df: DataFrame, label: str, by: str = "type") -> list[str]:
    """Feature names for ``label``.

    ``by="type"``: every numeric column except the label, in schema order.
    ``by="position"``: every column except the label, in schema order (the
    label is passed by name, not assumed to be last).
    """
    if label not in df.columns:
        raise ValueError(f"label {label!r} not in {df.columns}")
    if by == "type":
        return numeric_fields(df, exclude=[label])
    if by == "position":
        return [c for c in df.columns if c != label]
    raise ValueError(f"unknown selection {by!r}")


def select_features(df: DataFrame, label: str, by: str = "type", keep: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` to ``keep`` + the features + the label (column pruning
    reaches the scan)."""
    cols = [*keep, *[c for c in feature_columns(df, label, by) if c not in keep], label]
    return df.select(*[qcol(c) for c in cols])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names that are absent raise, so typos are not silent."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"columns not present: {absent}")
    return df.drop(*names)


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of ``subset`` (default: all).
    Plain conjuncts, so that the null tests reach the scan."""
    keep = F.lit(True)
    for c in subset or df.columns:
        keep = keep & ~is_missing(df, c)
    return df.where(keep)


def sample_rows(df: DataFrame, order_by: Sequence[str], n: int = 10,
                columns: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows by a unique key: a stable replacement for
    ``show(n)``/``head(n)``. Plans as TakeOrderedAndProject (a per-partition
    top-n, then one merge of at most n rows per partition)."""
    out = df.orderBy(*order_by).limit(n)
    return out.select(*columns) if columns else out


@contextmanager
def multipass(df: DataFrame, keys: Sequence[str] | None = None, partitions: int | None = None,
              persist: bool = True) -> Iterator[DataFrame]:
    """Input for work that reads it several times and must not depend on the
    input's layout (pipeline fits, searches): ``fixed_layout``, kept
    (MEMORY_AND_DISK) for the work unless ``persist`` is False, in which case
    every pass runs the input and its shuffle again. The same at every size;
    give it the narrow frame that the work needs.
    """
    laid = fixed_layout(df, keys, partitions)
    if not persist:
        yield laid
        return
    with persisted(laid) as kept:
        yield kept


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for a multi-pass step (a pipeline fit reads its input once
    per fitted stage) and release it afterwards. Blocks spill to disk rather
    than fail, and a lost executor's blocks are recomputed from lineage."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
