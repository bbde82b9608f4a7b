"""Dense global row numbers without a single-task window, and what they make possible.

Rows are dealt out by ranges of their order, each partition is sorted, numbered and stored; the counts of the partitions
give the offset of each (one number per partition, whatever the rows). The order is completed by a hash of the
whole row, and copies, which no order tells apart, by a number that changes nothing in the result: so a value or a copy
that a third of the rows share is still spread over many ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.operators.columns import qcol
from tabml.session import scratch_path

#: Bits of ``monotonically_increasing_id`` that count a partition's rows.
_PLACE = (1 << 33) - 1


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: its rows don't change if a task runs twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ordered(by: str | tuple[str, str], column: Column) -> Column:
    return getattr(column, "asc" if isinstance(by, str) else by[1])()


def row_numbers(df: DataFrame, order_by: Sequence[str | tuple[str, str]], name: str = "row_number", start: int = 1, partitions: int | None = None) -> DataFrame:
    """``df`` with a column ``name`` (long): ``start``, ``start + 1``, ... in the order of ``order_by``, as
    ``row_number() over (order by ...)`` gives. Each entry is a column, or a column and one of Spark's directions
    (``("n", "desc")``, ``("n", "asc_nulls_last")``). Rows that it leaves equal follow each other in an order that depends on
    their values alone. ``partitions``: default ``spark.sql.shuffle.partitions``. An empty table has no numbers."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = [qcol(c) for c in df.columns]
    keys = [qcol(by if isinstance(by, str) else by[0]).alias(f"o{i}") for i, by in enumerate(order_by)]
    keyed = df.select(F.struct(*every).alias("row"), *keys, F.xxhash64(*every).alias("tie"), F.monotonically_increasing_id().alias("copy"))
    order = [*(_ordered(by, F.col(f"o{i}")) for i, by in enumerate(order_by)), F.col("tie").asc(), F.col("copy").asc()]
    laid = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = stored(laid.select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(_PLACE).alias("place")), "row-numbers")
    counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    offsets, total = [], start
    for part in range(max(counts, default=0) + 1):
        offsets.append(total)
        total += counts.get(part, 0)
    base = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("part") + 1)
    return placed.select(*[F.col("row").getField(c).alias(c) for c in df.columns], (base + F.col("place")).alias(name))


def join_by_position(left: DataFrame, left_order: Sequence[str], right: DataFrame, right_order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """The first row of ``left`` beside the first of ``right``, the second beside the second, ...; rows beyond the shorter
    table go. Ids that merely grow (``monotonically_increasing_id``) fit only where both tables have one partition; numbers do always."""
    a = row_numbers(left, left_order, "_place", partitions=partitions)
    b = row_numbers(right, right_order, "_place", partitions=partitions)
    return a.join(b, "_place").drop("_place")


def key_index(df: DataFrame, column: str, output: str = "index") -> DataFrame:
    """``(column, n, output)``: the values of ``column`` by falling frequency, ties by value, numbered from 0 (double)."""
    counts = df.where(qcol(column).isNotNull()).groupBy(qcol(column)).agg(F.count("*").alias("_n"))
    numbered = row_numbers(counts, [("_n", "desc"), column], "_index", start=0)
    return numbered.select(qcol(column), F.col("_n").alias("n"), F.col("_index").cast("double").alias(output))


def index_keys(df: DataFrame, column: str, output: str = "index") -> DataFrame:
    """``df`` with the frequency rank of its ``column``, for keys of any number: counts are numbered by ranges and joined
    back, and no list of values reaches the driver (labels with few values: ``transform.index_labels``). A null gets the
    number after all others. A value that many rows share is one row of the index, so the join's other side can be split."""
    index = key_index(df, column, output).select(qcol(column).alias("_key"), qcol(output))
    kinds = F.lit(float(index.count()))
    joined = df.join(index, qcol(column) == F.col("_key"), "left")
    return joined.withColumn(output, F.coalesce(qcol(output), kinds)).drop("_key")
