"""Interquartile-range outliers: bounds ``Q1 - f*IQR`` and ``Q3 + f*IQR``,
strict on both sides.

Two scans for any number of columns: the quartiles (see ``quantiles``), then
one aggregate with a ``count_if`` per column against the bounds, which are
bounded statistics (two numbers per column) folded in as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.expressions import DIGITS

from tabml.operators.columns import qcol
from tabml.operators.profile import _stack
from tabml.operators.quantiles import quartiles


def iqr_bounds(q: DataFrame, factor: float = 1.5) -> DataFrame:
    """``(column, q1, q3, lower, upper)`` from a quartile table."""
    iqr = F.col("q3") - F.col("q1")
    return q.select("column", "q1", "q3",
                    (F.col("q1") - F.lit(factor) * iqr).alias("lower"),
                    (F.col("q3") + F.lit(factor) * iqr).alias("upper"))


def _bounds(df: DataFrame, columns: Sequence[str], exact: bool, factor: float, **kw) -> dict:
    """``column -> (q1, q3, lower, upper)``: one row per column, collected
    once, so nothing after it recomputes the quantile passes."""
    b = iqr_bounds(quartiles(df, columns, exact=exact, **kw), factor)
    return {r["column"]: (r["q1"], r["q3"], r["lower"], r["upper"]) for r in b.collect()}


def _outside(name: str, lower, upper):
    x = qcol(name).cast("double")
    if lower is None or upper is None:
        return F.lit(False)
    return (x < F.lit(lower)) | (x > F.lit(upper))


def iqr_outlier_counts(df: DataFrame, columns: Sequence[str], *, exact: bool = True,
                       factor: float = 1.5, digits: int | None = DIGITS, **kw) -> DataFrame:
    """``(column, q1, q3, lower, upper, outliers)``. The bounds are literals
    of the one counting aggregate, so the result needs no join."""
    lim = _bounds(df, columns, exact, factor, **kw)
    none = (None, None, None, None)
    fields = {"q1": "q1_", "q3": "q3_", "lower": "lo_", "upper": "hi_"}
    aggs = []
    for i, c in enumerate(columns):
        q1, q3, lo, hi = lim.get(c, none)
        aggs.append(F.count_if(_outside(c, lo, hi)).alias(f"o{i}"))
        for v, prefix in zip((q1, q3, lo, hi), fields.values()):
            aggs.append(F.lit(v).cast("double").alias(f"{prefix}{i}"))
    out = _stack(df.agg(*aggs), columns, {**fields, "outliers": "o"})
    if digits is not None:
        out = out.select("column", *[F.round(c, digits).alias(c)
                                     for c in ("q1", "q3", "lower", "upper")], "outliers")
    return out


def iqr_outlier_rows(df: DataFrame, column: str, *, exact: bool = True,
                     factor: float = 1.5, **kw) -> DataFrame:
    """Rows of ``df`` whose ``column`` lies outside the IQR bounds. The bounds
    are literals, so the filter pushes down into the Parquet scan."""
    _, _, lo, hi = _bounds(df, [column], exact, factor, **kw).get(column, (None,) * 4)
    return df.where(_outside(column, lo, hi))
