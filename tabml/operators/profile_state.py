"""Profiles that are kept and merged: a new part of a table is scanned, the old ones are not.

The state of a part has, for each numeric column, a row per magnitude bucket (64 per octave, ``quantiles``) with its rows, sum,
least and largest value, and a row for the nulls. Buckets of two parts add up, so states of disjoint parts
are merged by one small grouped sum, whatever the size of the parts, and any union of them is profiled as one table: rows,
missing values, mean, standard deviation, extremes, and quantiles within a bucket (1.1 % of the value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabml.functions.expressions import DIGITS, qname
from tabml.operators.columns import sql_str
from tabml.operators.quantiles import _magnitude_key

STATE = "`column` string, bucket int, n bigint, mean double, squares double, low double, high double"


def profile_state(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, bucket, n, mean, squares, low, high)`` of the numeric ``columns``: rows per bucket, their mean and squared deviations from
    it, and their extremes. NaN counts as missing; missing values have no bucket."""
    structs = ", ".join(f"named_struct('column', {sql_str(c)}, 'x', nanvl(CAST({qname(c)} AS DOUBLE), NULL))" for c in columns)
    long = df.selectExpr(f"inline(array({structs}))").withColumn("bucket", F.expr(f"if(x is null, null, {_magnitude_key('x')})"))
    finite = F.when(F.abs("x") < float("inf"), F.col("x"))
    return long.groupBy("column", "bucket").agg(
        F.count("*").alias("n"), F.avg(finite).alias("mean"), (F.var_pop(finite) * F.count(finite)).alias("squares"), F.min("x").alias("low"), F.max("x").alias("high"))


def merge_states(states: DataFrame) -> DataFrame:
    """One state of any union of states. Within a bucket, deviations of the parts are those around the parts' means plus the
    means' own, so nothing cancels (values of a bucket are within 1.1 % of each other)."""
    one = states.groupBy("column", "bucket")
    total = one.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum(F.when(F.col("mean").isNotNull(), F.col("n")))).alias("mean"),
                    F.sum("squares").alias("inner"), F.collect_list(F.struct("n", "mean")).alias("parts"),
                    F.min("low").alias("low"), F.max("high").alias("high"))
    between = F.aggregate("parts", F.lit(0.0), lambda a, p: a + F.coalesce(p["n"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean")), F.lit(0.0)))
    return total.select("column", "bucket", "n", "mean", (F.col("inner") + between).alias("squares"), "low", "high")


def add_part(spark: SparkSession, path: str, part: str, df: DataFrame, columns: Sequence[str]) -> None:
    """Scans ``df`` and keeps its state under ``path`` as the part named ``part``; one of that name is replaced."""
    profile_state(df, columns).write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={part}")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The states of all parts kept under ``path``."""
    return spark.read.schema(STATE + ", part string").parquet(path).drop("part")


def profile_of(states: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75), digits: int | None = DIGITS) -> DataFrame:
    """``(column, rows, missing, mean, stddev, min, max, quantiles)`` of the union of ``states``.

    ``mean`` and ``stddev`` (sample) are those of the finite values; a quantile is the middle of the bucket's extremes in which
    the value of its rank (the smallest with at least that share of values up to it) lies.
    """
    merged = merge_states(states)
    values, finite = F.col("bucket").isNotNull(), F.col("mean").isNotNull()
    k = F.when(finite, F.col("n"))
    sums = merged.groupBy("column").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(~values, F.col("n"))), F.lit(0)).alias("missing"), F.sum(k).alias("k"),
        (F.sum(k * F.col("mean")) / F.sum(k)).alias("mean"), F.sum("squares").alias("inner"), F.min("low").alias("min"), F.max("high").alias("max"))
    apart = merged.where(finite).join(sums.select("column", F.col("mean").alias("centre")), "column")
    apart = apart.groupBy("column").agg(F.sum(F.col("n") * (F.col("mean") - F.col("centre")) * (F.col("mean") - F.col("centre"))).alias("outer"))
    # a few thousand buckets a column, whatever the rows
    upto = Window.partitionBy("column").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.where(values).withColumn("upto", F.sum("n").over(upto)).withColumn("of", F.sum("n").over(Window.partitionBy("column")))
    middle = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") / 2 + F.col("high") / 2)
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.col("of") * p), F.struct("bucket", middle.alias("v")))).alias(f"q{i}") for i, p in enumerate(probabilities)]
    quantiles = ranked.groupBy("column").agg(*at).select("column", F.array(*[F.col(f"q{i}.v") for i in range(len(probabilities))]).alias("quantiles"))
    out = sums.join(apart, "column", "left").join(quantiles, "column", "left")
    stddev = F.when(F.col("k") > 1, F.sqrt((F.col("inner") + F.col("outer")) / (F.col("k") - 1)))
    out = out.select("column", "rows", "missing", "mean", stddev.alias("stddev"), "min", "max", "quantiles")
    if digits is None:
        return out
    return out.select("column", "rows", "missing", *[F.round(c, digits).alias(c) for c in ("mean", "stddev", "min", "max")],
                      F.transform("quantiles", lambda v: F.round(v, digits)).alias("quantiles"))
