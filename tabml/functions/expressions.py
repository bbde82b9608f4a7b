"""Scalar expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen and push down where Catalyst can push them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.FloatType, T.DoubleType)

# Decimal places for rounded floating results. Means of 2-decimal data over
# n rows have few exact decimals; 7 places keeps such values off the
# half-way points where engines round ties differently.
DIGITS = 7


def qname(name: str) -> str:
    """The name quoted for a SQL expression string."""
    return "`" + name.replace("`", "``") + "`"


def numeric_fields(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns of ``df`` in schema order."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def is_missing(df: DataFrame, name: str) -> Column:
    """True when a value is null, or NaN for float/double columns.

    ``isnan`` is applied by type only: under ANSI mode it raises on strings and
    fails analysis on timestamps.
    """
    c = F.col(qname(name))
    dtype = df.schema[name].dataType
    if isinstance(dtype, _FLOATING):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def round_half_up(c: Column | str) -> Column:
    """Round to 0 digits, half away from zero (4.5 -> 5, -4.5 -> -5), as double."""
    return F.round(F.col(c) if isinstance(c, str) else c, 0).cast("double")


def hash_bucket(keys: Sequence[str] | str, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) from the md5 of the key.

    The first 32 bits of ``md5(key)`` decide the bucket, so the assignment is
    independent of partitioning, file layout and retries. Composite keys are
    joined with '|' (nulls skipped); a null single key counts as ''.
    """
    if isinstance(keys, str):
        keys = [keys]
    if len(keys) == 1:
        # a null key hashes like '' (it must land on a side, not vanish)
        text = F.coalesce(F.col(qname(keys[0])).cast("string"), F.lit(""))
    else:
        text = F.concat_ws("|", *[F.col(qname(k)).cast("string") for k in keys])
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(buckets)).cast("int")


def split_label(keys: Sequence[str] | str, train_percent: int = 70) -> Column:
    """'train' for the first ``train_percent`` hash buckets, else 'test'."""
    return F.when(hash_bucket(keys) < train_percent, F.lit("train")).otherwise(
        F.lit("test")
    )
