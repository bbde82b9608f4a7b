"""Column types from all values of a text table, in one aggregate.

Types form a lattice: every value is accepted by some of them, and a column can have the types that accept all of its
values. A value's accepting types are the bits of a number; the column's are the bitwise and of all rows, which combines
in any order and needs one number per column and task, so the last row of a file counts as much as the first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.operators.columns import qcol

#: From the narrowest type to the one that accepts everything; the first one left is the column's.
TYPES = ("boolean", "int", "bigint", "double", "date", "timestamp", "string")
_ALL = (1 << len(TYPES)) - 1
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(Infinity|NaN)$"
_TIME = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?$"


def accepting(text: Column) -> Column:
    """The types that accept a text, as bits in the order of ``TYPES``; a null is accepted by all.

    The kinds of text exclude each other, so the first that fits is the last that is tried; the first character rules most out.
    """
    def bits(*kinds: str) -> Column:
        return F.lit(sum(1 << TYPES.index(t) for t in kinds))

    def readable(kind: str) -> Column:
        return F.when(text.try_cast(kind).isNotNull(), bits(kind)).otherwise(0)

    first, only = F.substring(text, 1, 1), bits("string")
    return (F.when(text.isNull(), F.lit(_ALL))
            .when(first.isin(*"tTfF"), F.when(text.rlike("^(?i)(true|false)$"), bits("boolean", "string")).otherwise(only))
            .when(~first.isin(*"+-.0123456789IN"), only)
            .when(text.rlike(r"^[+-]?\d+$"), bits("double", "string") + readable("int") + readable("bigint"))
            .when(text.rlike(_NUMBER), bits("double", "string"))
            .when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.when(text.try_cast("date").isNotNull(), bits("date", "timestamp", "string")).otherwise(only))
            .when(text.rlike(_TIME) & text.try_cast("timestamp").isNotNull(), bits("timestamp", "string"))
            .otherwise(only))


def infer_types(df: DataFrame, columns: Sequence[str] | None = None, nulls: Sequence[str] = ("",)) -> dict[str, str]:
    """The narrowest type of each text column of ``df`` that reads every value in all rows: {column: type}.

    ``nulls`` are texts that stand for a missing value. A column without any value is a string. Blanks around a number make it a
    text. One row of numbers reaches the driver.
    """
    cols = list(columns or df.columns)
    if not cols:
        return {}
    text = [F.when(~qcol(c).cast("string").isin(*nulls), qcol(c).cast("string")) for c in cols]
    left = df.agg(*[F.bit_and(accepting(t)).alias(f"t{i}") for i, t in enumerate(text)], *[F.count(t).alias(f"n{i}") for i, t in enumerate(text)]).first()
    return {c: next(t for k, t in enumerate(TYPES) if left[f"t{i}"] >> k & 1) if left[f"n{i}"] else "string" for i, c in enumerate(cols)}


def typed(df: DataFrame, columns: Sequence[str] | None = None, nulls: Sequence[str] = ("",), kinds: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` with its text columns in the types of :func:`infer_types`; ``kinds`` are those, where they are known already."""
    kinds = infer_types(df, columns, nulls) if kinds is None else kinds
    return df.select(*[F.when(~qcol(c).isin(*nulls), qcol(c)).cast(kinds[c]).alias(c) if kinds.get(c, "string") != "string" else qcol(c) for c in df.columns])


def inferred_schema(df: DataFrame, nulls: Sequence[str] = ("",)) -> T.StructType:
    """The schema of :func:`typed`, to read the next file of the kind without a look at its values."""
    kinds = infer_types(df, nulls=nulls)
    return T.StructType.fromDDL(", ".join(f"`{c}` {kinds[c]}" for c in df.columns))
