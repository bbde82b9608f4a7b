"""Profiling aggregates: label distribution, missing values, summary
statistics, per-label means.

Each profile scans its table once for all requested columns, with partial
aggregation on the map side, and returns a long table. Hot label
values cost nothing extra: partial aggregation collapses them before the
shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.expressions import DIGITS, is_missing, numeric_fields, qname
from tabml.operators.columns import qcol, sql_str


def label_distribution(df: DataFrame, label: str, count_col: str = "count") -> DataFrame:
    """Rows per label value, ordered by label."""
    return df.groupBy(qcol(label)).agg(F.count(F.lit(1)).alias(count_col)).orderBy(qcol(label))


def _stack(one_row: DataFrame, columns: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turn a one-row frame with columns ``{prefix}{i}`` into one row per
    input column: ``column`` plus one output field per ``fields`` entry.
    Built as one SQL expression (one call, however many columns)."""
    structs = []
    for i, name in enumerate(columns):
        parts = [f"'column', {sql_str(name)}"]
        parts += [f"{sql_str(out)}, {prefix}{i}" for out, prefix in fields.items()]
        structs.append(f"named_struct({', '.join(parts)})")
    return one_row.selectExpr(f"inline(array({', '.join(structs)}))")


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing)``: nulls (and NaN for floating columns) per column."""
    cols = list(columns or df.columns)
    return _stack(df.select(*[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(cols)]), cols, {"missing": "m"})


def _long(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """``(column, value)`` rows: one per input row and column, cast to
    ``kind``. Aggregates per column over it have one set of buffers however
    many columns there are, where one aggregate over all columns outgrows
    code generation."""
    structs = ", ".join(f"named_struct('column', {sql_str(c)}, 'value', CAST({qname(c)} AS {kind}))" for c in columns)
    return df.selectExpr(f"inline(array({structs}))")


def describe_columns(df: DataFrame, columns: Sequence[str], digits: int | None = DIGITS) -> DataFrame:
    """``(column, count, mean, stddev, min, max)`` of numeric columns as typed
    values (sample standard deviation), one scan for all. Values are doubles:
    whole numbers beyond 2^53 lose their last digits."""
    v = F.col("value")
    out = _long(df, columns, "DOUBLE").groupBy("column").agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("stddev"), F.min(v).alias("min"), F.max(v).alias("max"))
    # columns of an empty table have a row as well
    names = "array(" + ", ".join(sql_str(c) for c in columns) + ")"
    every = df.sparkSession.range(1, numPartitions=1).select(F.explode(F.expr(names)).alias("column"))
    out = every.join(out, "column", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    if digits is None:
        return out
    return out.select("column", "count", *[F.round(c, digits).alias(c)
                                           for c in ("mean", "stddev", "min", "max")])


def describe_all(df: DataFrame, columns: Sequence[str] | None = None, digits: int | None = DIGITS) -> DataFrame:
    """``(column, count, mean, stddev, min, max)`` of columns of any type:
    count, and min and max as text; mean and stddev for numeric columns, null
    for others. Min and max of a number are those of its value, of a date,
    time or boolean those of its text, in binary order."""
    cols = list(columns or df.columns)
    numeric = [c for c in cols if c in set(numeric_fields(df))]
    other = [c for c in cols if c not in numeric]
    parts = []
    if numeric:
        d = describe_columns(df, numeric, digits)
        parts.append(d.select("column", "count", "mean", "stddev", F.col("min").cast("string").alias("min"), F.col("max").cast("string").alias("max")))
    if other:
        none = F.lit(None).cast("double")
        text = _long(df, other, "STRING").groupBy("column").agg(F.count("value").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"))
        names = "array(" + ", ".join(sql_str(c) for c in other) + ")"
        every = df.sparkSession.range(1, numPartitions=1).select(F.explode(F.expr(names)).alias("column"))
        parts.append(every.join(text, "column", "left").select("column", F.coalesce("count", F.lit(0)).alias("count"), none.alias("mean"), none.alias("stddev"), "min", "max"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def group_mean_ci(df: DataFrame, group: str, value: str, z: float = 1.96,
                  digits: int | None = DIGITS) -> DataFrame:
    """Per group: ``(group, n, mean, ci)`` where ``ci = z * stddev / sqrt(n)``
    is the half-width of a normal interval around the mean."""
    x = qcol(value).cast("double")
    out = df.groupBy(qcol(group)).agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        (F.lit(z) * F.stddev_samp(x) / F.sqrt(F.count(x))).alias("ci"),
    )
    if digits is None:
        return out
    return out.select(group, "n", F.round("mean", digits).alias("mean"),
                      F.round("ci", digits).alias("ci"))


#: A prime below 2^31: hashes of a row and a replicate are whole numbers below it, and their products fit in 63 bits.
PRIME = 2_147_483_647
#: Distribution of how often a row is drawn when n of n rows are drawn with replacement, n large: Poisson with mean 1.
DRAWS = 12
DRAWN_BELOW = [int(PRIME * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(DRAWS)]


def draws(key, replicate, seed: int):
    """How often a replicate draws the row with a key (both arrays of whole numbers, or both numbers): 0 to ``DRAWS``."""
    import numpy as np

    x = (np.mod(key, PRIME) * 48_271 + np.mod(replicate + seed * 7_919 + 1, PRIME) * 69_621) % PRIME
    for _ in range(3):
        x = (x * x + replicate + 1) % PRIME
        x = (x * 16_807 + 12_345) % PRIME
    return np.searchsorted(np.array(DRAWN_BELOW), x, side="right")


def group_mean_bootstrap(df: DataFrame, group: str, value: str, key: str, replicates: int = 1000, level: float = 0.95,
                         seed: int = 1, digits: int | None = DIGITS) -> DataFrame:
    """Per group ``(group, n, mean, low, high)``: the mean and its percentile interval over bootstrap samples.

    Each replicate draws each row a Poisson number of times that a hash of the row's ``key`` (a whole number) and
    the replicate decides, so the interval is the same on any layout. No sample is made: in each Arrow batch the
    draws are a matrix (rows by replicates) whose products with the values and with one are the sums of all
    replicates, and a task returns a row per group and replicate that it has met. Rows whose value is null, NaN or infinite
    don't count; nor do replicates that draw no row of a group. A null key is 0.
    """
    import numpy as np

    x = qcol(value).cast("double")
    rows = df.select(qcol(group).alias("g"), F.coalesce(qcol(key).cast("long"), F.lit(0)).alias("k"), x.alias("x")).where(F.abs(F.col("x")) < float("inf"))
    kind = rows.schema["g"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        sums: dict = {}
        each = np.arange(replicates)
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                w = draws(part.column(1).to_numpy(zero_copy_only=False)[:, None], each[None, :], seed).astype(float)
                v = part.column(2).to_numpy(zero_copy_only=False)
                groups = part.column(0).dictionary_encode(null_encoding="encode")
                of = groups.indices.to_numpy(zero_copy_only=False)
                for i, g in enumerate(groups.dictionary):
                    own = of == i
                    if own.any():
                        total = sums.setdefault(g, np.zeros((2, replicates)))
                        total += np.stack([w[own].sum(axis=0), v[own] @ w[own]])
        for g, (n, s) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([g.as_py()] * replicates, g.type), pa.array(each, pa.int32()), pa.array(n), pa.array(s)], ["g", "r", "n", "s"])

    parts = rows.mapInArrow(run, f"g {kind}, r int, n double, s double").groupBy("g", "r").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    means = parts.where("n > 0").select("g", (F.col("s") / F.col("n")).alias("m"))
    tail = (1 - level) / 2
    # a group has one value per replicate; between two of them lies a share of the way
    bounds = means.groupBy("g").agg(F.array_sort(F.collect_list("m")).alias("m"))
    for side, p in (("low", tail), ("high", 1 - tail)):
        at = (F.size("m") - 1) * F.lit(p)
        below, above = (F.element_at("m", (f(at) + 1).cast("int")) for f in (F.floor, F.ceil))
        bounds = bounds.withColumn(side, below + (above - below) * (at - F.floor(at)))
    plain = rows.groupBy("g").agg(F.count("*").alias("n"), F.avg("x").alias("mean"))
    out = plain.join(bounds.select(F.col("g").alias("h"), "low", "high"), F.col("g").eqNullSafe(F.col("h")), "left")
    out = out.select(F.col("g").alias(group), "n", "mean", "low", "high")
    return out if digits is None else out.select(qcol(group), "n", *[F.round(c, digits).alias(c) for c in ("mean", "low", "high")])


def value_counts(df: DataFrame, column: str, count_col: str = "count") -> DataFrame:
    """Rows per value of any column (e.g. predicted classes), ordered by value."""
    return label_distribution(df, column, count_col)
