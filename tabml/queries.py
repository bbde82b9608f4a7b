"""Registered queries: one per operator of the inventory, each over whole
tables of a data directory, with an equivalent DuckDB SQL oracle where SQL
can express the operator.

Fixtures (derived from the given tables, never synthesized):

* ``lineitem`` with an ordinal label 3..8 (``quality``) built from quantity
  and discount, four numeric features, and a rule prediction for metrics;
* ``events.value`` for outliers, ``orders.o_orderpriority`` for label
  indexing, derived nulls/NaN for missing-value handling.

Floating results are rounded to ``DIGITS`` (7) places on both sides so summation order
cannot flip a value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.functions.expressions import DIGITS as D
from tabml.functions.expressions import round_half_up, split_label
from tabml.jobs import score as score_job
from tabml.jobs import train as train_job
from tabml.jobs.common import read_input
from tabml.operators import columns as cols_op
from tabml.operators import correlation, metrics, numbering, outliers, profile, profile_state, quantiles, split, transform
from tabml.operators.transform import ASSEMBLED, NORMALIZED, STANDARDIZED
from tabml.plans import l1, models, search, trees, tuning
from tabml.session import scratch_path
from tabml.sources import delimited, inference, tables
from tabml.sources import models as model_io

# Fixed fixture values (must equal the oracle side exactly).
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LABEL = "quality"
KEYS = ["l_orderkey", "l_linenumber"]
LABEL_SPARK = ("cast(least(8, 3 + floor(l_quantity / 10) + "
               "case when l_discount > 0.05D then 1 else 0 end) as int)")
LABEL_SQL = ("CAST(LEAST(8, 3 + FLOOR(l_quantity / 10) + "
             "CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS INTEGER)")
RULE_RAW_SPARK = "cast(3.0 as double) + l_quantity / 10.0"
RULE_RAW_SQL = "CAST(3.0 AS DOUBLE) + l_quantity / 10.0"
SPLIT_SQL = ("CASE WHEN CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 70 "
             "THEN 'train' ELSE 'test' END")
CORR_COLUMNS = [*FEATURES, "net_price", LABEL]
OUTLIER_COLUMNS = ["event_id", "user_id", "value"]
DROPPED = ["l_partkey", "l_suppkey"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- fixtures

def labelled(spark: SparkSession, d: str) -> DataFrame:
    """lineitem keys, the four features and the ordinal label."""
    li = tables.read_table(spark, d, "lineitem")
    return li.select(*KEYS, *FEATURES, F.expr(LABEL_SPARK).alias(LABEL))


LABELLED_SQL = f"SELECT {', '.join(KEYS + FEATURES)}, {LABEL_SQL} AS {LABEL} FROM lineitem"


def ruled(spark: SparkSession, d: str) -> DataFrame:
    """Labelled lineitem with a rule prediction (a function of the row)."""
    return labelled(spark, d).withColumn("raw", F.expr(RULE_RAW_SPARK)).withColumn(
        "prediction", round_half_up("raw"))


RULED_SQL = (f"SELECT *, round(raw, 0) AS prediction FROM "
             f"(SELECT *, {RULE_RAW_SQL} AS raw FROM ({LABELLED_SQL}) s) r")


def with_nulls(spark: SparkSession, d: str) -> DataFrame:
    """lineitem with derived missing values: null discounts where 0, NaN tax
    where 0, null return flag where 'R'."""
    li = tables.read_table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("l_returnflag"),
        "l_shipdate",
    )


NULLS_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                 "l_returnflag", "l_shipdate"]
NULLS_FLOATING = {"l_quantity", "l_discount", "l_tax"}
NULLS_SQL = ("SELECT l_orderkey, l_linenumber, l_quantity, NULLIF(l_discount, 0) AS l_discount, "
             "CASE WHEN l_tax = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS l_tax, "
             "NULLIF(l_returnflag, 'R') AS l_returnflag, l_shipdate FROM lineitem")


def corr_input(spark: SparkSession, d: str) -> DataFrame:
    return labelled(spark, d).withColumn(
        "net_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))


CORR_SQL = f"SELECT *, l_extendedprice * (1 - l_discount) AS net_price FROM ({LABELLED_SQL}) s"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _miss_sql(c: str) -> str:
    cond = f"{c} IS NULL OR isnan({c})" if c in NULLS_FLOATING else f"{c} IS NULL"
    return f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {cond}) AS missing FROM t"


def _pairs_sql(cols: list[str], rounded: bool = True) -> str:
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = f"covar_samp({a}, {b}) / NULLIF(stddev_samp({a}) * stddev_samp({b}), 0)"
            if a == b:
                v = f"stddev_samp({a}) * stddev_samp({a}) / NULLIF(stddev_samp({a}) * stddev_samp({a}), 0)"
            if rounded:
                v = f"round({v}, {D})"
            parts.append(f"SELECT '{a}' AS feature_a, {i} AS pos_a, '{b}' AS feature_b, "
                         f"{j} AS pos_b, {v} AS corr FROM t")
    return _union(parts)


# ------------------------------------------------------- sources and sinks

def _csv_copy(spark: SparkSession, d: str, table: str = "lineitem", **how) -> str:
    """Write a table in the quoted-header, ';', CRLF dialect to the scratch
    folder (it goes with the application); return the path."""
    path = scratch_path(spark, "csv")
    delimited.write_delimited(tables.read_table(spark, d, table), path,
                              partitions=spark.sparkContext.defaultParallelism, **how)
    return path


@register("csv_roundtrip", "SELECT * FROM lineitem")
def q_csv_roundtrip(spark, d):
    schema = tables.read_table(spark, d, "lineitem").schema
    return delimited.read_delimited(spark, _csv_copy(spark, d), schema=schema)


@register("csv_text_roundtrip", "SELECT * FROM documents")
def q_csv_text_roundtrip(spark, d):
    # whole texts, with their line breaks, blanks, quotes and separators
    schema = tables.read_table(spark, d, "documents").schema
    return delimited.read_delimited(spark, _csv_copy(spark, d, "documents", escapes=True), schema=schema, escapes=True)


_INFERRED = {"l_orderkey": "int", "l_quantity": "double", "l_discount": "string", "l_returnflag": "string", "l_shipdate": "timestamp", "l_tax": "double",
             "l_linenumber": "int", "flag": "boolean", "day": "date", "big": "bigint"}


@register("infer_types",
          "SELECT c AS \"column\", t AS type, n.n_rows, n.n_texts FROM (VALUES " + ", ".join(f"('{c}', '{t}')" for c, t in _INFERRED.items()) + ") v(c, t), "
          f"(SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_texts FROM lineitem) n")
def q_infer_types(spark, d):
    """A delimited copy of lineitem in which one single row, the last, holds a text among the discounts."""
    li = tables.read_table(spark, d, "lineitem")
    last = li.agg(F.max(F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount"))).first()[0]
    is_last = F.lit(True)
    for c in ("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount"):
        is_last = is_last & (F.col(c) == F.lit(last[c]))
    used = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate"]
    rows = numbering.row_numbers(li.select(*used, is_last.alias("_last")), ["_last", "l_orderkey"])
    shown = rows.orderBy("row_number").select(
        "l_orderkey", "l_quantity", F.when(F.col("_last"), "none").otherwise(F.col("l_discount").cast("string")).alias("l_discount"), "l_returnflag", "l_shipdate",
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"), "l_linenumber", (F.col("l_quantity") > 5).alias("flag"), F.to_date("l_shipdate").alias("day"),
        (F.col("l_orderkey") * 10_000_000_000).alias("big"))
    path = scratch_path(spark, "untyped")
    delimited.write_delimited(shown, path)
    text = delimited.read_delimited(spark, path)
    kinds = inference.infer_types(text)
    n = inference.typed(text, kinds=kinds).agg(F.count("*").alias("n_rows"), F.count_if(F.col("l_discount") == "none").alias("n_texts")).first()
    return spark.createDataFrame([(c, t, n["n_rows"], n["n_texts"]) for c, t in kinds.items()], "column string, type string, n_rows long, n_texts long")


@register("clean_headers", "SELECT * FROM lineitem")
def q_clean_headers(spark, d):
    schema = tables.read_table(spark, d, "lineitem").schema
    raw = delimited.read_delimited(spark, _csv_copy(spark, d), clean=False)
    return delimited.apply_schema(delimited.clean_headers(raw), schema)


@register("sample_rows",
          "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem "
          "ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice LIMIT 10")
def q_sample_rows(spark, d):
    # (l_orderkey, l_linenumber) repeats in this data: order by every shown
    # column so the first ten rows are the same in any engine.
    shown = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return cols_op.sample_rows(tables.read_table(spark, d, "lineitem"), shown, 10, shown)


# ------------------------------------------------ projections and filters

_KEPT = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"]


@register("drop_columns", f"SELECT {', '.join(_KEPT)} FROM lineitem")
def q_drop_columns(spark, d):
    return cols_op.drop_columns(tables.read_table(spark, d, "lineitem"), *DROPPED)


@register("feature_columns", f"SELECT {', '.join(FEATURES)}, {LABEL} FROM ({LABELLED_SQL}) s")
def q_feature_columns(spark, d):
    li = tables.read_table(spark, d, "lineitem")
    df = li.select(*FEATURES, "l_returnflag", "l_linestatus", F.expr(LABEL_SPARK).alias(LABEL))
    return cols_op.select_features(df, LABEL, by="type")


@register("feature_position",
          f"SELECT {', '.join(FEATURES)}, l_returnflag, {LABEL_SQL} AS {LABEL} FROM lineitem")
def q_feature_position(spark, d):
    # every column but the label, in schema order; the label is named, not
    # assumed to be last (here it comes first)
    li = tables.read_table(spark, d, "lineitem")
    df = li.select(F.expr(LABEL_SPARK).alias(LABEL), *FEATURES, "l_returnflag")
    return cols_op.select_features(df, LABEL, by="position")


@register("round_prediction",
          f"SELECT l_orderkey, l_linenumber, {LABEL}, raw, prediction FROM ({RULED_SQL}) q")
def q_round_prediction(spark, d):
    # the pipelines' own rounding stage on the unrounded rule
    raw = labelled(spark, d).withColumn("raw", F.expr(RULE_RAW_SPARK))
    return models.rounding_stage("raw", "prediction").transform(raw).select(*KEYS, LABEL, "raw", "prediction")


@register("drop_missing",
          f"SELECT * FROM ({NULLS_SQL}) n WHERE "
          + " AND ".join(f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if c in NULLS_FLOATING else "")
                         for c in NULLS_COLUMNS))
def q_drop_missing(spark, d):
    return cols_op.drop_missing(with_nulls(spark, d))


# ---------------------------------------------------- profiling aggregates

@register("label_distribution",
          f"SELECT {LABEL}, count(*) AS \"count\" FROM ({LABELLED_SQL}) s GROUP BY {LABEL} ORDER BY {LABEL}")
def q_label_distribution(spark, d):
    return profile.label_distribution(labelled(spark, d), LABEL)


@register("missing_counts",
          f"WITH t AS ({NULLS_SQL})\n" + _union([_miss_sql(c) for c in NULLS_COLUMNS]))
def q_missing_counts(spark, d):
    return profile.missing_counts(with_nulls(spark, d))


_DESC_COLS = [*FEATURES, LABEL]


@register("describe_columns",
          f"WITH t AS ({LABELLED_SQL})\n" + _union([
              f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", "
              f"round(avg(CAST({c} AS DOUBLE)), {D}) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), {D}) AS stddev, "
              f"round(min(CAST({c} AS DOUBLE)), {D}) AS \"min\", round(max(CAST({c} AS DOUBLE)), {D}) AS \"max\" FROM t"
              for c in _DESC_COLS]))
def q_describe_columns(spark, d):
    return profile.describe_columns(labelled(spark, d), _DESC_COLS)


_ALL_NUMBERS, _ALL_TEXTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], ["l_returnflag"]


@register("describe_all",
          f"WITH t AS ({NULLS_SQL.replace('l_quantity,', 'l_quantity, l_extendedprice,')})\n" + _union([
              f"SELECT '{c}' AS \"column\", count({x}) AS \"count\", round(avg({x}), {D}) AS mean, round(stddev_samp({x}), {D}) AS stddev, "
              f"CAST(round(min({x}), {D}) AS VARCHAR) AS \"min\", CAST(round(max({x}), {D}) AS VARCHAR) AS \"max\" FROM t"
              for c, x in ((c, f"CAST(CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS DOUBLE)") for c in _ALL_NUMBERS)]
              + [f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, "
                 f"min({c}) AS \"min\", max({c}) AS \"max\" FROM t" for c in _ALL_TEXTS]))
def q_describe_all(spark, d):
    return profile.describe_all(
        tables.read_table(spark, d, "lineitem").select(
            "l_quantity", "l_extendedprice", F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
            F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"), F.nullif(F.col("l_returnflag"), F.lit("R")).alias("l_returnflag")))


@register("profile_parts",
          f"WITH t AS ({NULLS_SQL})\n" + _union([
              f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({x}) AS missing, round(avg({x}), {D}) AS mean, round(stddev_samp({x}), {D}) AS stddev, "
              f"round(min({x}), {D}) AS \"min\", round(max({x}), {D}) AS \"max\", TRUE AS quartiles_hold FROM t"
              for c, x in ((c, f"CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END") for c in ("l_quantity", "l_discount", "l_tax", "l_orderkey"))]))
def q_profile_parts(spark, d):
    """Two parts of a table, each scanned once and kept; the profile is that of the kept states, its quartiles are within 1.2 % of those of the whole."""
    cols = ["l_quantity", "l_discount", "l_tax", "l_orderkey"]
    whole, path = with_nulls(spark, d), scratch_path(spark, "profile")
    for part, rows in (("a", whole.where("l_linenumber < 3")), ("b", whole.where("l_linenumber >= 3"))):
        profile_state.add_part(spark, path, part, rows, cols)
    got = profile_state.profile_of(profile_state.read_states(spark, path), (0.25, 0.75))
    exact = quantiles.quartiles(whole.withColumn("l_tax", F.nanvl("l_tax", F.lit(None))), cols, exact=True)

    def near(i: int, q: str):
        return F.abs(F.col("quantiles")[i] - F.col(q)) <= 0.012 * F.abs(F.col(q)) + 1e-9

    return got.join(exact, "column").select("column", "rows", "missing", "mean", "stddev", "min", "max", (near(0, "q1") & near(1, "q3")).alias("quartiles_hold"))


@register("quartiles_exact",
          f"WITH t AS ({LABELLED_SQL})\n" + _union([
              f"SELECT '{c}' AS \"column\", round(quantile_cont(CAST({c} AS DOUBLE), 0.25), {D}) AS q1, "
              f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), {D}) AS q3 FROM t" for c in _DESC_COLS]))
def q_quartiles_exact(spark, d):
    q = quantiles.quartiles(labelled(spark, d), _DESC_COLS, exact=True)
    return q.select("column", F.round("q1", D).alias("q1"), F.round("q3", D).alias("q3"))


@register("quartiles_approx")
def q_quartiles_approx(spark, d):
    return quantiles.quartiles(labelled(spark, d), _DESC_COLS, exact=False, relative_error=0.05)


def _iqr_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS \"column\", round(q1, {D}) AS q1, round(q3, {D}) AS q3, "
            f"round(q1 - 1.5 * (q3 - q1), {D}) AS lower, round(q3 + 1.5 * (q3 - q1), {D}) AS upper, "
            f"(SELECT count(*) FROM events WHERE {x} < b.q1 - 1.5 * (b.q3 - b.q1) "
            f"OR {x} > b.q3 + 1.5 * (b.q3 - b.q1)) AS outliers "
            f"FROM (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM events) b")


@register("iqr_outlier_counts", _union([_iqr_sql(c) for c in OUTLIER_COLUMNS]))
def q_iqr_outlier_counts(spark, d):
    return outliers.iqr_outlier_counts(tables.read_table(spark, d, "events"), OUTLIER_COLUMNS)


@register("iqr_outlier_counts_approx")
def q_iqr_outlier_counts_approx(spark, d):
    """With the sketch's quartiles (rank error 0.05), as the original counts them."""
    return outliers.iqr_outlier_counts(tables.read_table(spark, d, "events"), OUTLIER_COLUMNS, exact=False, relative_error=0.05)


@register("iqr_outlier_rows",
          "SELECT event_id, ts, user_id, event_type, value FROM events, "
          "(SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events) b "
          "WHERE value < b.q1 - 1.5 * (b.q3 - b.q1) OR value > b.q3 + 1.5 * (b.q3 - b.q1)")
def q_iqr_outlier_rows(spark, d):
    ev = tables.read_table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return outliers.iqr_outlier_rows(ev, "value")


@register("group_mean_ci",
          f"SELECT {LABEL}, count(l_discount) AS n, round(avg(l_discount), {D}) AS mean, "
          f"round(1.96 * stddev_samp(l_discount) / sqrt(count(l_discount)), {D}) AS ci "
          f"FROM ({LABELLED_SQL}) s GROUP BY {LABEL}")
def q_group_mean_ci(spark, d):
    return profile.group_mean_ci(labelled(spark, d), LABEL, "l_discount")


REPLICATES = 60


_BOOT_SQL = f"""
WITH e AS (SELECT event_type, event_id, CAST(value AS DOUBLE) AS value FROM events WHERE isfinite(CAST(value AS DOUBLE))),
h0 AS (SELECT event_type, value, r, ((event_id % {profile.PRIME}) * 48271 + ((r + 7919 + 1) % {profile.PRIME}) * 69621) % {profile.PRIME} AS x
       FROM e, range({REPLICATES}) t(r)),
h1 AS (SELECT event_type, value, r, (((x * x + r + 1) % {profile.PRIME}) * 16807 + 12345) % {profile.PRIME} AS x FROM h0),
h2 AS (SELECT event_type, value, r, (((x * x + r + 1) % {profile.PRIME}) * 16807 + 12345) % {profile.PRIME} AS x FROM h1),
h3 AS (SELECT event_type, value, r, (((x * x + r + 1) % {profile.PRIME}) * 16807 + 12345) % {profile.PRIME} AS x FROM h2),
w AS (SELECT event_type, value, r, {' + '.join(f'CAST(x >= {b} AS INTEGER)' for b in profile.DRAWN_BELOW)} AS w FROM h3),
m AS (SELECT event_type, r, sum(w * value) / sum(w) AS m FROM w GROUP BY event_type, r HAVING sum(w) > 0),
q AS (SELECT event_type, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM m GROUP BY event_type)
SELECT event_type, count(*) AS n, round(avg(value), {D}) AS mean, round(any_value(low), {D}) AS low, round(any_value(high), {D}) AS high
FROM e JOIN q USING (event_type) GROUP BY event_type"""


@register("group_mean_bootstrap", _BOOT_SQL)
def q_group_mean_bootstrap(spark, d):
    return profile.group_mean_bootstrap(tables.read_table(spark, d, "events"), "event_type", "value", "event_id", replicates=REPLICATES)


@register("prediction_distribution",
          f"SELECT prediction, count(*) AS \"count\" FROM ({RULED_SQL}) q GROUP BY prediction ORDER BY prediction")
def q_prediction_distribution(spark, d):
    return profile.value_counts(ruled(spark, d), "prediction")


# ------------------------------------------------------------ correlation

def gappy_input(spark: SparkSession, d: str) -> DataFrame:
    """The correlation columns with others that miss values, each its own: null
    where the discount is 0, NaN where the tax is 0, null for returned items,
    one that has a value in few rows, and two with infinities."""
    li = tables.read_table(spark, d, "lineitem")
    q, p, disc, tax = (F.col(c) for c in FEATURES)
    return li.select(
        *FEATURES, (p * (1 - disc)).alias("net_price"), F.expr(LABEL_SPARK).alias(LABEL),
        F.nullif(disc, F.lit(0.0)).alias("some_discount"),
        F.when(tax == 0, F.lit(float("nan"))).otherwise(tax).alias("some_tax"),
        F.when(F.col("l_returnflag") != "R", p).alias("kept_price"),
        F.when(q < 5, q * tax).alias("few"), (p / q).alias("unit_price"), (q * q).alias("quantity_2"),
        F.when(disc == 0, F.lit(float("inf"))).otherwise(q / disc).alias("per_discount"),
        F.when(tax == 0, F.lit(float("-inf"))).when(q > 45, F.lit(float("inf"))).otherwise(p).alias("bounded_price"))


GAPPY_COLUMNS = [*CORR_COLUMNS, "some_discount", "some_tax", "kept_price", "few", "unit_price", "quantity_2", "per_discount", "bounded_price"]
GAPPY_SQL = (f"SELECT {', '.join(FEATURES)}, l_extendedprice * (1 - l_discount) AS net_price, {LABEL_SQL} AS {LABEL}, "
             "NULLIF(l_discount, 0) AS some_discount, CASE WHEN l_tax <> 0 THEN l_tax END AS some_tax, "
             "CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS kept_price, "
             "CASE WHEN l_quantity < 5 THEN l_quantity * l_tax END AS few, l_extendedprice / l_quantity AS unit_price, "
             "l_quantity * l_quantity AS quantity_2, CASE WHEN l_discount <> 0 THEN l_quantity / l_discount END AS per_discount, "
             "CASE WHEN l_tax <> 0 AND l_quantity <= 45 THEN l_extendedprice END AS bounded_price FROM lineitem")


def _corr_sql(cols: list[str], rounded: bool = True) -> str:
    """DuckDB's own ``corr`` of every pair: over the rows where both have a value."""
    def value(a: str, b: str) -> str:
        v = f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
        return f"round({v}, {D})" if rounded else v

    return _union([f"SELECT '{a}' AS feature_a, {i} AS pos_a, '{b}' AS feature_b, {j} AS pos_b, {value(a, b)} AS corr FROM t"
                   for i, a in enumerate(cols) for j, b in enumerate(cols)])


_PAIRS = f"WITH t AS ({GAPPY_SQL})\n" + _corr_sql(GAPPY_COLUMNS)


@register("corr_pairs", f"SELECT feature_a, feature_b, corr FROM ({_PAIRS}) p")
def q_corr_pairs(spark, d):
    return correlation.corr_pairs(gappy_input(spark, d), GAPPY_COLUMNS)


@register("corr_matrix_ml", f"SELECT feature_a, feature_b, corr FROM (WITH t AS ({CORR_SQL})\n{_pairs_sql(CORR_COLUMNS)}) p")
def q_corr_matrix_ml(spark, d):
    return correlation.corr_matrix_ml(corr_input(spark, d), CORR_COLUMNS)


@register("corr_matrix_wide",
          "SELECT feature_a AS feature, "
          + ", ".join(f"max(CASE WHEN feature_b = '{c}' THEN corr END) AS {c}" for c in GAPPY_COLUMNS)
          + f" FROM ({_PAIRS}) p GROUP BY feature_a")
def q_corr_matrix_wide(spark, d):
    pairs = correlation.corr_pairs(gappy_input(spark, d), GAPPY_COLUMNS)
    return correlation.corr_matrix_wide(pairs, GAPPY_COLUMNS)


@register("high_corr_features",
          f"SELECT DISTINCT feature_a AS feature FROM (WITH t AS ({GAPPY_SQL})\n"
          f"{_corr_sql(GAPPY_COLUMNS, rounded=False)}) p WHERE pos_b < pos_a AND abs(corr) > 0.7")
def q_high_corr_features(spark, d):
    return correlation.high_corr_features(gappy_input(spark, d), GAPPY_COLUMNS, 0.7)


# ------------------------------------------------------------ transformers

_V = [f"v_{c}" for c in FEATURES]
_S = [f"s_{c}" for c in FEATURES]
_Z = [f"z_{c}" for c in FEATURES]


@register("assemble_features",
          "SELECT l_orderkey, l_linenumber, "
          + ", ".join(f"CAST({c} AS DOUBLE) AS v_{c}" for c in FEATURES) + " FROM lineitem")
def q_assemble_features(spark, d):
    df = transform.assemble(labelled(spark, d), FEATURES)
    return transform.vector_columns(df, ASSEMBLED, _V, keep=KEYS)


def _minmax_sql(where_fit: str, where_apply: str, fixture: str = "lineitem") -> str:
    stats = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in FEATURES)
    outs = ", ".join(
        f"round(CASE WHEN mx_{c} = mn_{c} THEN 0.5 ELSE ({c} - mn_{c}) / (mx_{c} - mn_{c}) END, {D}) AS s_{c}"
        for c in FEATURES)
    return (f"WITH f AS (SELECT {stats} FROM {fixture} WHERE {where_fit}) "
            f"SELECT l_orderkey, l_linenumber, {outs} FROM {fixture}, f WHERE {where_apply}")


def _standard_sql(where_fit: str, where_apply: str, prefix: str = "z_") -> str:
    stats = ", ".join(f"avg({c}) AS mu_{c}, stddev_samp({c}) AS sd_{c}" for c in FEATURES)
    outs = ", ".join(
        f"round(CASE WHEN sd_{c} = 0 THEN 0.0 ELSE ({c} - mu_{c}) / sd_{c} END, {D}) AS {prefix}{c}"
        for c in FEATURES)
    return (f"WITH f AS (SELECT {stats} FROM lineitem WHERE {where_fit}) "
            f"SELECT l_orderkey, l_linenumber, {outs} FROM lineitem, f WHERE {where_apply}")


def _split(spark, d):
    df = labelled(spark, d)
    return split.hash_split(df, "l_orderkey", 70)


@register("minmax_scale", _minmax_sql(f"{SPLIT_SQL} = 'train'", f"{SPLIT_SQL} = 'test'"))
def q_minmax_scale(spark, d):
    train, test = _split(spark, d)
    model = transform.fit_scalers(train, FEATURES, minmax=True)
    return transform.vector_columns(model.transform(test), NORMALIZED, _S, keep=KEYS, digits=D)


@register("standard_scale", _standard_sql(f"{SPLIT_SQL} = 'train'", f"{SPLIT_SQL} = 'test'"))
def q_standard_scale(spark, d):
    train, test = _split(spark, d)
    model = transform.fit_scalers(train, FEATURES, minmax=False, standard=True)
    return transform.vector_columns(model.transform(test), STANDARDIZED, _Z, keep=KEYS, digits=D)


def _both_sql() -> str:
    stats = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}, avg({c}) AS mu_{c}, "
                      f"stddev_samp({c}) AS sd_{c}" for c in FEATURES)
    mm = ", ".join(
        f"round(CASE WHEN mx_{c} = mn_{c} THEN 0.5 ELSE ({c} - mn_{c}) / (mx_{c} - mn_{c}) END, {D}) AS s_{c}"
        for c in FEATURES)
    zz = ", ".join(
        f"round(CASE WHEN sd_{c} = 0 THEN 0.0 ELSE ({c} - mu_{c}) / sd_{c} END, {D}) AS z_{c}"
        for c in FEATURES)
    return f"WITH f AS (SELECT {stats} FROM lineitem) SELECT l_orderkey, l_linenumber, {mm}, {zz} FROM lineitem, f"


@register("scale_both", _both_sql())
def q_scale_both(spark, d):
    df = labelled(spark, d)
    model = transform.fit_scalers(df, FEATURES, minmax=True, standard=True)
    out = model.transform(df)
    mm = transform.vector_columns(out, NORMALIZED, _S, keep=[*KEYS, STANDARDIZED], digits=D)
    return transform.vector_columns(mm, STANDARDIZED, _Z, keep=[*KEYS, *_S], digits=D)


@register("index_labels",
          "WITH f AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS r "
          "FROM orders GROUP BY o_orderpriority) "
          "SELECT o_orderkey, o_orderpriority, CAST(r AS DOUBLE) AS label FROM orders JOIN f USING (o_orderpriority)")
def q_index_labels(spark, d):
    orders = tables.read_table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return transform.index_labels(orders, "o_orderpriority", "label")


@register("hash_split", f"SELECT l_orderkey, l_linenumber, {SPLIT_SQL} AS split FROM lineitem")
def q_hash_split(spark, d):
    li = tables.read_table(spark, d, "lineitem").select(*KEYS)
    return li.withColumn("split", split_label("l_orderkey", 70))


_ROW_COLUMNS = [*KEYS, *FEATURES, "l_returnflag"]


@register("row_numbers",
          f"SELECT {', '.join(_ROW_COLUMNS)}, row_number() OVER (ORDER BY l_extendedprice DESC, {', '.join(_ROW_COLUMNS)}) AS row_number FROM lineitem")
def q_row_numbers(spark, d):
    li = tables.read_table(spark, d, "lineitem").select(*_ROW_COLUMNS)
    return numbering.row_numbers(li, [("l_extendedprice", "desc"), *_ROW_COLUMNS])


@register("row_id_join", ORACLE["corr_matrix_wide"])
def q_row_id_join(spark, d):
    """The original's matrix without names, and its names, brought together by row number."""
    pairs = correlation.corr_long(gappy_input(spark, d), GAPPY_COLUMNS)
    matrix = pairs.groupBy("pos_a").pivot("feature_b", GAPPY_COLUMNS).agg(F.first("corr"))
    names = spark.createDataFrame([(i, c) for i, c in enumerate(GAPPY_COLUMNS)], "at int, feature string")
    return numbering.join_by_position(names, ["at"], matrix, ["pos_a"]).drop("at", "pos_a")


@register("index_keys",
          "WITH f AS (SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, l_partkey) - 1 AS r FROM lineitem GROUP BY l_partkey) "
          "SELECT l_orderkey, l_linenumber, l_partkey, CAST(r AS DOUBLE) AS index FROM lineitem JOIN f USING (l_partkey)")
def q_index_keys(spark, d):
    return numbering.index_keys(tables.read_table(spark, d, "lineitem").select(*KEYS, "l_partkey"), "l_partkey")


@register("exact_split",
          "WITH o AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY "
          "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT), o_orderkey) AS r, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) "
          "SELECT o_orderkey, o_orderpriority, CASE WHEN r <= (n * 70) // 100 THEN 'train' ELSE 'test' END AS split FROM o")
def q_exact_split(spark, d):
    return split.exact_split(tables.read_table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey", "o_orderpriority", 70)


@register("random_split")
def q_random_split(spark, d):
    li = tables.read_table(spark, d, "lineitem").select(*KEYS)
    train, test = split.random_split(li, (0.7, 0.3), seed=42)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@register("spec_params",
          "SELECT * FROM (VALUES ('MinMaxScaler', 'inputCol', 'assembledFeatures'), ('MinMaxScaler', 'max', '1.0'), "
          "('MinMaxScaler', 'min', '0.0'), ('MinMaxScaler', 'outputCol', 'normalizedFeatures'), "
          "('RandomForestRegressor', 'maxBins', '32'), ('RandomForestRegressor', 'maxDepth', '20'), "
          "('RandomForestRegressor', 'numTrees', '25'), ('RandomForestRegressor', 'seed', '42'), "
          "('RandomForestRegressor', 'impurity', 'variance'), ('RandomForestRegressor', 'labelCol', 'quality')) "
          "p(stage, param, value), (SELECT count(*) AS rows_scaled FROM lineitem) n")
def q_spec_params(spark, d):
    """A bare estimator and a bare scaler, saved and loaded as such: their
    parameters, and the rows that the loaded scaler scales."""
    from pyspark.ml.regression import RandomForestRegressor

    pipe = _ordinal()
    rf, scaler = models.model_stage_spec(pipe), transform.minmax_scaler()
    rf = model_io.load_spec(RandomForestRegressor, model_io.save_spec(rf, scratch_path(spark, "spec")))
    scaler = model_io.load_spec(MinMaxScaler, model_io.save_spec(scaler, scratch_path(spark, "spec")))
    vectors = transform.assemble(labelled(spark, d), FEATURES)
    n = scaler.fit(vectors).transform(vectors).filter(F.col(NORMALIZED).isNotNull()).count()
    rows = model_io.spec_params(spark, rf).unionByName(model_io.spec_params(spark, scaler))
    shown = ["inputCol", "outputCol", "min", "max", "maxBins", "maxDepth", "numTrees", "seed", "impurity", "labelCol"]
    return rows.filter(F.col("param").isin(shown)).withColumn("rows_scaled", F.lit(n).cast("long"))


@register("save_load_spec", _minmax_sql("TRUE", "TRUE"))
def q_save_load_spec(spark, d):
    """Save an unfitted assembler + scaler spec, load it back, fit and apply."""
    spec = Pipeline(stages=[transform.assembler(FEATURES), MinMaxScaler(inputCol=ASSEMBLED, outputCol=NORMALIZED)])
    path = model_io.save_spec(spec, scratch_path(spark, "spec"))
    loaded = model_io.load_spec(Pipeline, path)
    df = labelled(spark, d)
    return transform.vector_columns(loaded.fit(df).transform(df), NORMALIZED, _S, keep=KEYS, digits=D)


# ----------------------------------------------------------------- metrics

_RULED_D = f"SELECT CAST({LABEL} AS DOUBLE) AS label, prediction FROM ({RULED_SQL}) q"
_F1_SQL = (
    f"WITH s AS ({_RULED_D}), c AS (SELECT label, prediction, count(*) AS n FROM s GROUP BY label, prediction), "
    "tr AS (SELECT label, CAST(sum(n) AS DOUBLE) AS n_true, CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS DOUBLE) AS tp "
    "FROM c GROUP BY label), pr AS (SELECT prediction AS label, CAST(sum(n) AS DOUBLE) AS n_pred FROM c GROUP BY prediction), "
    "m AS (SELECT sum(n_true * 2.0 * tp / (n_true + coalesce(n_pred, 0))) / sum(n_true) AS weighted_f1, "
    "sum(tp) / sum(n_true) AS accuracy FROM tr LEFT JOIN pr USING (label)) ")


@register("confusion_counts",
          f"SELECT label, prediction, count(*) AS \"count\" FROM ({_RULED_D}) s GROUP BY label, prediction")
def q_confusion_counts(spark, d):
    return metrics.confusion_counts(ruled(spark, d), LABEL, "prediction")


@register("weighted_f1", _F1_SQL + f"SELECT round(weighted_f1, {D}) AS weighted_f1 FROM m")
def q_weighted_f1(spark, d):
    return metrics.weighted_f1(ruled(spark, d), LABEL, "prediction")


@register("accuracy",
          f"SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), {D}) AS accuracy FROM ({_RULED_D}) s")
def q_accuracy(spark, d):
    return metrics.accuracy(ruled(spark, d), LABEL, "prediction")


@register("rmse",
          f"SELECT round(sqrt(avg((label - prediction) * (label - prediction))), {D}) AS rmse FROM ({_RULED_D}) s")
def q_rmse(spark, d):
    return metrics.rmse(ruled(spark, d), LABEL, "prediction")


@register("metrics_report",
          _F1_SQL + f"SELECT 'f1' AS metric, round(weighted_f1, {D}) AS value, round(weighted_f1 * 100, 1) AS pct FROM m "
          f"UNION ALL SELECT 'accuracy' AS metric, round(accuracy, {D}) AS value, round(accuracy * 100, 1) AS pct FROM m")
def q_metrics_report(spark, d):
    return metrics.metrics_report(ruled(spark, d), LABEL, "prediction")


# ------------------------------------------------------------------ models
# Held-out rows of the hash split, scored by a pipeline fitted on the rest with
# the original's parameters. Fits read a frame that is dealt out by the key.

def _narrow(train: DataFrame) -> DataFrame:
    return train.select(*KEYS, *FEATURES, LABEL)


def _fit(pipe, train: DataFrame):
    return models.fit(pipe, _narrow(train), keys=["l_orderkey"])


def _scored(model, test: DataFrame, extra: list[str] = ()) -> DataFrame:
    return model.transform(test).select(*KEYS, LABEL, "prediction", *extra)


@register("lr_classify")
def q_lr_classify(spark, d):
    train, test = _split(spark, d)
    return _scored(_fit(models.logistic_regression(FEATURES, LABEL, max_iter=10), train), test, ["label"])


@register("lr_l1_classify")
def q_lr_l1_classify(spark, d):
    train, test = _split(spark, d)
    pipe = models.logistic_regression(FEATURES, LABEL, reg=0.01, elastic_net=1.0, scale="minmax")
    return _scored(_fit(pipe, train), test, ["label"])


def _l1(train: DataFrame) -> l1.L1Model:
    return l1.fit_logistic(_narrow(train), FEATURES, LABEL, reg=0.01, elastic_net=1.0)


@register("lr_l1_newton")
def q_lr_l1_newton(spark, d):
    """The same model as ``lr_l1_classify`` by the library's own solver, to its optimum; predictions are labels."""
    train, test = _split(spark, d)
    return _l1(train).predict(test, probability="probability").select(*KEYS, LABEL, "prediction", "probability")


@register("lr_l1_kkt",
          f"SELECT CAST(c.{LABEL} AS VARCHAR) AS class, f.feature, n.n_rows, TRUE AS optimal, TRUE AS few_passes "
          f"FROM (SELECT DISTINCT {LABEL} FROM ({LABELLED_SQL}) s WHERE {SPLIT_SQL} = 'train') c, "
          f"(VALUES {', '.join(f'({chr(39)}{c}{chr(39)})' for c in FEATURES)}, (NULL)) f(feature), "
          f"(SELECT count(*) AS n_rows FROM ({LABELLED_SQL}) s WHERE {SPLIT_SQL} = 'train') n")
def q_lr_l1_kkt(spark, d):
    """Optimality of every coefficient and intercept, from gradients that built-in aggregates compute anew over the training rows."""
    train, _ = _split(spark, d)
    model = _l1(train)
    p = model.predict(train, probability="p").where("p is not null")
    sums = []
    for k, label in enumerate(model.labels):
        off = F.col("p")[k] - F.when(F.col(LABEL) == label, 1.0).otherwise(0.0)
        sums += [F.avg(off * (F.col(c) / float(s))).alias(f"g{k}_{j}") for j, (c, s) in enumerate(zip(FEATURES, model.deviations))]
        sums.append(F.avg(off).alias(f"g{k}_{len(FEATURES)}"))
    one = p.agg(F.count("*").alias("n_rows"), *sums).first()
    rows = []
    for r in model.certificate(spark).collect():
        k, j = [str(x) for x in model.labels].index(r["class"]), FEATURES.index(r["feature"]) if r["feature"] else len(FEATURES)
        g, w, bound = one[f"g{k}_{j}"], r["coefficient"], 0.01 if r["feature"] else 0.0
        optimal = abs(g + bound * ((w > 0) - (w < 0))) if w or not r["feature"] else max(0.0, abs(g) - bound)
        rows.append((r["class"], r["feature"], one["n_rows"], optimal < 1e-6 and r["residual"] < 1e-6, model.passes <= 15))
    return spark.createDataFrame(rows, "class string, feature string, n_rows long, optimal boolean, few_passes boolean")


@register("rf_classify")
def q_rf_classify(spark, d):
    train, test = _split(spark, d)
    return _scored(_fit(models.forest_classifier(FEATURES, LABEL), train), test)


@register("rf_classify_proba")
def q_rf_classify_proba(spark, d):
    train, test = _split(spark, d)
    pipe = models.forest_classifier(FEATURES, LABEL, num_trees=30, max_depth=30, index_label=True)
    out = _fit(pipe, train).transform(test)
    from pyspark.ml.functions import vector_to_array
    return out.select(*KEYS, LABEL, "label", "prediction",
                      vector_to_array("probability").alias("probability"))


@register("rf_regress")
def q_rf_regress(spark, d):
    train, test = _split(spark, d)
    return _scored(_fit(models.forest_regressor(FEATURES, LABEL, ordinal=False), train), test)


def _ordinal():
    return models.forest_regressor(FEATURES, LABEL, num_trees=25, max_depth=20, seed=42)


@register("rf_ordinal")
def q_rf_ordinal(spark, d):
    train, test = _split(spark, d)
    return _scored(_fit(_ordinal(), train), test, [models.ORDINAL])


@register("model_summary")
def q_model_summary(spark, d):
    train, _ = _split(spark, d)
    return models.model_summary(spark, _fit(_ordinal(), train))


@register("save_load_score")
def q_save_load_score(spark, d):
    train, test = _split(spark, d)
    path = model_io.save_pipeline(_fit(_ordinal(), train), scratch_path(spark, "model"))
    return _scored(model_io.load_pipeline(path), test, [models.ORDINAL])


#: The original's grid; its 15 and 20 folds are a parameter here, as 3 folds already take 28 fits.
GRID = {"numTrees": [10, 20, 30], "maxDepth": [5, 10, 15]}
FOLDS = 3


def _cv(spark, d, evaluator, folds: int = FOLDS, max_depth: int = 5):
    train, test = _split(spark, d)
    train = split.with_folds(_narrow(train), "l_orderkey", folds)
    pipe = models.forest_regressor(FEATURES, LABEL, num_trees=20, max_depth=max_depth)  # M8: 20 trees, 32 bins
    cvm = tuning.cross_validate(pipe, tuning.param_grid(models.model_stage_spec(pipe), GRID), evaluator, train, fold_col="fold",
                                folds=folds, parallelism=4, keys=["l_orderkey"])
    return cvm, test


@register("cv_f1")
def q_cv_f1(spark, d):
    cvm, test = _cv(spark, d, tuning.f1_evaluator(LABEL))
    return _scored(cvm.bestModel, test, [models.ORDINAL])


@register("cv_rmse")
def q_cv_rmse(spark, d):
    cvm, test = _cv(spark, d, tuning.rmse_evaluator(LABEL))
    return _scored(cvm.bestModel, test, [models.ORDINAL])


def _search(spark, d, metric: str, folds: int):
    train, test = _split(spark, d)
    pipe = models.forest_regressor(FEATURES, LABEL, num_trees=20, max_depth=5)
    return search.search_forest(pipe, GRID, _narrow(train), metric=metric, folds=folds, fold_keys="l_orderkey", keys=["l_orderkey"], parallelism=4), test


@register("search_f1_15")
def q_search_f1_15(spark, d):
    """The original's search by F1 with its 15 folds: one fit per fold gives all points."""
    found, test = _search(spark, d, "f1", 15)
    return _scored(found.best_model, test, [models.ORDINAL])


@register("search_rmse_20")
def q_search_rmse_20(spark, d):
    """The original's search by RMSE with its 20 folds."""
    found, test = _search(spark, d, "rmse", 20)
    return _scored(found.best_model, test, [models.ORDINAL])


# Binary label on text shape: documents joined with labels (whole texts).
# One explicit whitespace class for both engines (Java and RE2 disagree on \s).
_WS = r"[ \t\n\r\f]+"
DOC_FEATURES = ["n_chars", "words", "distinct_words", "digits", "lines"]


def doc_shape(spark: SparkSession, d: str) -> DataFrame:
    """``documents`` inner join ``labels`` on doc_id with text-shape features.
    The join is planned by Catalyst/AQE from table sizes (labels grows with
    the data, so it is not forced into a broadcast)."""
    docs = tables.read_table(spark, d, "documents").select("doc_id", "text", "n_chars")
    labels = tables.read_table(spark, d, "labels").select("doc_id", "quality")
    docs = docs.withColumn("tokens", F.filter(F.split("text", _WS), lambda t: t != ""))
    tokens = F.col("tokens")
    return docs.join(labels, "doc_id").select(
        "doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(tokens).cast("double").alias("words"),
        F.size(F.array_distinct(tokens)).cast("double").alias("distinct_words"),
        F.length(F.regexp_replace("text", "[^0-9]", "")).cast("double").alias("digits"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"))


_TOK_SQL = f"list_filter(string_split_regex(text, '{_WS}'), lambda x: x <> '')"
DOC_SHAPE_SQL = (
    "SELECT d.doc_id, l.quality, CAST(d.n_chars AS DOUBLE) AS n_chars, "
    f"CAST(len({_TOK_SQL}) AS DOUBLE) AS words, "
    f"CAST(len(list_distinct({_TOK_SQL})) AS DOUBLE) AS distinct_words, "
    "CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE) AS digits, "
    "CAST(len(string_split(text, chr(10))) AS DOUBLE) AS lines "
    "FROM documents d JOIN labels l USING (doc_id)")


@register("doc_shape_features", DOC_SHAPE_SQL)
def q_doc_shape_features(spark, d):
    return doc_shape(spark, d)


@register("doc_quality_classify")
def q_doc_quality_classify(spark, d):
    """Random forest on the binary quality label of documents, held out by a
    hash of doc_id."""
    train, test = split.hash_split(doc_shape(spark, d), "doc_id", 70)
    pipe = models.forest_classifier(DOC_FEATURES, "quality", num_trees=20, max_depth=6)
    # the narrow features are dealt out and kept: the join and its texts are read once for the fit
    return models.fit(pipe, train, keys=["doc_id"]).transform(test).select(
        "doc_id", "quality", "prediction")


# ------------------------------------------------- properties of the above
# What SQL can say about results that it cannot compute: rows, labels and the
# properties every right result has, over all rows of the operator's output.

HELD_SQL = f"FROM ({LABELLED_SQL}) s WHERE {SPLIT_SQL} = 'test'"


def _held_out(scored: DataFrame, good: str, label: str = LABEL, pred: str = "prediction", compare: str = LABEL,
              floor: float = 0.0) -> DataFrame:
    """Rows, sum of labels, rows against the property ``good``, and whether
    weighted F1 of ``pred`` against ``compare`` reaches ``floor``."""
    # one pass: the confusion table carries what the other columns add up, so the rows are scored once
    y, p = cols_op.qcol(compare).cast("double").alias("label"), cols_op.qcol(pred).cast("double").alias("prediction")
    cells = scored.groupBy(y, p).agg(F.count("*").alias("count"), F.sum(label).cast("long").alias("label_sum"),
                                     F.count_if(~F.coalesce(F.expr(good), F.lit(False))).alias("bad_rows"))
    cells = numbering.stored(cells, "held-out")
    f1 = metrics.metrics_from_confusion(cells).first()["weighted_f1"]
    one = cells.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"), F.sum("label_sum").alias("label_sum"), F.coalesce(F.sum("bad_rows"), F.lit(0)).alias("bad_rows"))
    return one.withColumn("f1_reached", F.lit(f1 is not None and f1 >= floor))


def _held_out_sql(label: str = LABEL, held: str = HELD_SQL) -> str:
    return (f"SELECT count(*) AS n_rows, CAST(sum({label}) AS BIGINT) AS label_sum, CAST(0 AS BIGINT) AS bad_rows, "
            f"TRUE AS f1_reached {held}")


@register("lr_classify_check", _held_out_sql())
def q_lr_classify_check(spark, d):
    return _held_out(q_lr_classify(spark, d), "prediction between 0 and 5 and prediction = floor(prediction)", compare="label", floor=0.55)


@register("lr_l1_classify_check", _held_out_sql())
def q_lr_l1_classify_check(spark, d):
    return _held_out(q_lr_l1_classify(spark, d), "prediction between 0 and 5 and prediction = floor(prediction)", compare="label", floor=0.4)


@register("lr_l1_newton_check", _held_out_sql())
def q_lr_l1_newton_check(spark, d):
    good = ("prediction between 3 and 8 and size(probability) = 6 and abs(aggregate(probability, 0D, (a, x) -> a + x) - 1) < 1e-9 "
            "and probability[prediction - 3] = array_max(probability)")
    return _held_out(q_lr_l1_newton(spark, d), good, floor=0.4)


@register("rf_classify_check", _held_out_sql())
def q_rf_classify_check(spark, d):
    return _held_out(q_rf_classify(spark, d), "prediction between 3 and 8 and prediction = floor(prediction)", floor=0.6)


@register("rf_classify_proba_check", _held_out_sql())
def q_rf_classify_proba_check(spark, d):
    return _held_out(
        q_rf_classify_proba(spark, d),
        "size(probability) = 6 and abs(aggregate(probability, 0D, (a, x) -> a + x) - 1) < 1e-9 "
        "and element_at(probability, cast(prediction as int) + 1) = array_max(probability)", compare="label", floor=0.8)


@register("rf_regress_check", _held_out_sql())
def q_rf_regress_check(spark, d):
    out = q_rf_regress(spark, d).withColumn("rounded", round_half_up("prediction"))
    return _held_out(out, "prediction between 3 and 8", pred="rounded", floor=0.5)


_ORDINAL_GOOD = f"{models.ORDINAL} = round(prediction, 0) and prediction between 3 and 8"


@register("rf_ordinal_check", _held_out_sql())
def q_rf_ordinal_check(spark, d):
    return _held_out(q_rf_ordinal(spark, d), _ORDINAL_GOOD, pred=models.ORDINAL, floor=0.8)


@register("save_load_score_check", _held_out_sql())
def q_save_load_score_check(spark, d):
    """The loaded pipeline against the fitted one that was saved, row by row."""
    train, test = _split(spark, d)
    fitted = _fit(_ordinal(), train)
    loaded = model_io.load_pipeline(model_io.save_pipeline(fitted, scratch_path(spark, "model")))
    both = loaded.transform(fitted.transform(test).select(*KEYS, *FEATURES, LABEL, F.col("prediction").alias("before")))
    return _held_out(both, "prediction = before", pred=models.ORDINAL, floor=0.8)


@register("model_summary_check",
          "SELECT 2 AS stage, 'RandomForestRegressionModel' AS kind, 25 AS trees, 4 AS features, TRUE AS depth_in_bounds, "
          "count(*) > 0 AS has_nodes FROM lineitem")
def q_model_summary_check(spark, d):
    return q_model_summary(spark, d).select("stage", "kind", "trees", "features", F.col("max_depth").between(1, 20).alias("depth_in_bounds"),
                                            (F.col("total_nodes") > 25).alias("has_nodes"))


@register("model_nodes_check", "SELECT t.tree, TRUE AS sound, TRUE AS all_nodes FROM (SELECT unnest(range(25))::INTEGER AS tree) t, (SELECT count(*) AS n FROM lineitem) n WHERE n.n > 0")
def q_model_nodes_check(spark, d):
    """Every tree's node table: numbered without gaps, one more leaf than inner nodes, children of the right rows."""
    train, _ = _split(spark, d)
    model = _fit(_ordinal(), train)
    nodes = trees.model_nodes(spark, model)
    child = nodes.select("tree", F.col("node").alias("child"), F.col("rows").alias("child_rows"))
    inner = nodes.where("left is not null").select("tree", "node", "rows", F.explode(F.array("left", "right")).alias("child"))
    split_rows = inner.join(child, ["tree", "child"]).groupBy("tree", "node").agg(F.first("rows").alias("rows"), F.sum("child_rows").alias("below"), F.count("*").alias("k"))
    wrong = split_rows.groupBy("tree").agg(F.count_if((F.col("rows") != F.col("below")) | (F.col("k") != 2)).alias("wrong"), F.count("*").alias("inner"))
    per_tree = nodes.groupBy("tree").agg(F.count("*").alias("n"), F.max("node").alias("last"), F.count_if(F.expr("feature between 0 and 3 and threshold between 0 and 1")).alias("splits"))
    total = nodes.count() == models.model_stage(model).totalNumNodes
    return per_tree.join(wrong, "tree").select("tree", F.expr("wrong = 0 and n = last + 1 and n = 2 * inner + 1 and splits = inner").alias("sound"), F.lit(total).alias("all_nodes"))


@register("forest_table_check", _held_out_sql())
def q_forest_table_check(spark, d):
    """Predictions from the node table against the fitted forest, row by row."""
    train, test = _split(spark, d)
    fitted = _fit(_ordinal(), train)
    both = trees.predict_by_nodes(fitted, fitted.transform(test).select(*KEYS, *FEATURES, LABEL, F.col("prediction").alias("before"), models.ORDINAL))
    return _held_out(both, "abs(prediction - before) < 1e-9", pred=models.ORDINAL, floor=0.8)


def _job_inputs(spark, d) -> tuple[str, str]:
    """Folders with the training and the held-out rows, as a job's user has them: features and label."""
    folders = []
    for name, part in zip(("job-train", "job-test"), _split(spark, d)):
        folders.append(scratch_path(spark, name) + ".parquet")
        part.select(*FEATURES, LABEL).write.parquet(folders[-1])
    return folders[0], folders[1]


def _train_job(spark, inputs: tuple[str, str], *more: str):
    """(the job's report, folder of its models) of the training job on the folders of ``_job_inputs``, run as from its command line."""
    saved = scratch_path(spark, "job-models")
    args = train_job.parse_args(["--train_dataset", inputs[0], "--test_dataset", inputs[1], "--save_model_path", saved, *more])
    return train_job.run(spark, args), saved


_JOBS = {"rf": (["--max_depth", "12", "--num_trees", "10"], 0.8), "rf_classifier": (["--model", "rf_classifier", "--max_depth", "8", "--num_trees", "10"], 0.6),
         "lr": (["--model", "lr", "--max_iter", "20"], 0.4)}


@register("train_job",
          "SELECT m.model, CAST(4 AS INTEGER) AS features, TRUE AS f1_reached, TRUE AS consistent, n.n_rows AS scored_rows "
          f"FROM (VALUES {', '.join(f'({chr(39)}{m}{chr(39)})' for m in _JOBS)}) m(model), (SELECT count(*) AS n_rows {HELD_SQL}) n")
def q_train_job(spark, d):
    """The training job with each of its models: its report, and the rows that its saved pipeline scores."""
    rows, inputs = [], _job_inputs(spark, d)
    for name, (options, floor) in _JOBS.items():
        report, saved = _train_job(spark, inputs, *options)
        scored = model_io.load_pipeline(f"{saved}/pipeline").transform(read_input(spark, inputs[1]))
        n = scored.where("prediction is not null").count()
        rows.append((report["model"], len(report["features"]), report["f1"] >= floor, 0 < report["accuracy"] <= 1 and report["features"] == FEATURES, n))
    return spark.createDataFrame(rows, "model string, features int, f1_reached boolean, consistent boolean, scored_rows long")


@register("train_job_grid", "SELECT CAST(4 AS INTEGER) AS features, TRUE AS f1_reached, TRUE AS best_saved FROM (SELECT count(*) AS n FROM lineitem) n WHERE n > 0")
def q_train_job_grid(spark, d):
    """The training job with its grid search (a small grid): the best model is saved and as good as reported."""
    inputs = _job_inputs(spark, d)
    report, saved = _train_job(spark, inputs, "--max_depth", "6", "--num_trees", "5", "--enable_grid_search", "--grid_trees", "3,5", "--grid_depth", "4,8", "--folds", "2")
    best = model_io.load_pipeline(f"{saved}/best").transform(read_input(spark, inputs[1]))
    f1 = metrics.metric_values(best, LABEL, models.ORDINAL)["f1"]
    return spark.createDataFrame([(len(report["features"]), report["f1"] >= 0.7 and report["grid_best"]["f1"] >= 0.8, abs(f1 - report["grid_best"]["f1"]) < 1e-9)],
                                 "features int, f1_reached boolean, best_saved boolean")


@register("score_job", _held_out_sql())
def q_score_job(spark, d):
    """The scoring job on a saved pipeline: its written predictions, whose F1 is the one it reports."""
    inputs = _job_inputs(spark, d)
    _, saved = _train_job(spark, inputs, *_JOBS["rf"][0])
    out = scratch_path(spark, "job-scored")
    report = score_job.run(spark, score_job.parse_args(["--model_path", f"{saved}/pipeline", "--new_data", inputs[1], "--output", out]))
    scored = spark.read.parquet(out)
    checked = _held_out(scored, _ORDINAL_GOOD, pred=models.ORDINAL, floor=0.8)
    same = abs(metrics.metric_values(scored, LABEL, models.ORDINAL)["f1"] - report["f1"]) < 1e-9
    return checked.withColumn("f1_reached", F.col("f1_reached") & F.lit(same))


@register("uri_paths", f"SELECT {', '.join(_ROW_COLUMNS)} FROM lineitem")
def q_uri_paths(spark, d):
    """Paths are URIs of any store that Hadoop knows: written under one, read by a pattern, in both formats."""
    path = scratch_path(spark, "uri")
    li = tables.read_table(spark, d, "lineitem").select(*_ROW_COLUMNS)
    halves = [li.where("l_orderkey % 2 = 0"), li.where("l_orderkey % 2 = 1")]
    halves[0].write.parquet(f"{path}/as-parquet/a")
    delimited.write_delimited(halves[1], f"{path}/as-text/b")
    text = delimited.read_delimited(spark, f"{path}/as-text/*", schema=li.schema)
    return spark.read.schema(li.schema).parquet(f"{path}/as-parquet/*").unionByName(text)


_GRID_SQL = ("SELECT CAST(row_number() OVER (ORDER BY t, m) - 1 AS INTEGER) AS point, 'maxDepth=' || m || ', numTrees=' || t AS params, "
             "TRUE AS sound FROM (VALUES (10), (20), (30)) a(t), (VALUES (5), (10), (15)) b(m)")


def _grid_check(spark, cvm, better) -> DataFrame:
    """The grid's points, each with a sound metric, the best model being the best point's."""
    table = tuning.cv_table(spark, cvm)
    best = better(cvm.avgMetrics)
    chosen = models.model_stage(cvm.bestModel)
    won = cvm.getEstimatorParamMaps()[cvm.avgMetrics.index(best)]
    as_chosen = {p.name: v for p, v in won.items()} == {"numTrees": chosen.getNumTrees, "maxDepth": chosen.getMaxDepth()}
    return table.select("point", "params", (F.col("metric").between(0, 1) & F.lit(as_chosen)).alias("sound"))


@register("cv_f1_check", _GRID_SQL)
def q_cv_f1_check(spark, d):
    return _grid_check(spark, _cv(spark, d, tuning.f1_evaluator(LABEL))[0], max)


@register("cv_rmse_check", _GRID_SQL)
def q_cv_rmse_check(spark, d):
    return _grid_check(spark, _cv(spark, d, tuning.rmse_evaluator(LABEL))[0], min)


def _search_check(spark, found, folds: int, better) -> DataFrame:
    """The grid's points with a sound metric in every fold; the model refitted is of the best point."""
    chosen = models.model_stage(found.best_model)
    won = found.points[found.averages.index(better(found.averages))]
    right = {"numTrees": chosen.getNumTrees, "maxDepth": chosen.getMaxDepth()} == found.best == won and found.fits == folds + 1 and all(len(m) == folds for m in found.metrics)
    return found.table(spark).select("point", "params", (F.col("metric").between(0, 1) & F.lit(right)).alias("sound"))


@register("search_f1_15_check", _GRID_SQL)
def q_search_f1_15_check(spark, d):
    return _search_check(spark, _search(spark, d, "f1", 15)[0], 15, max)


@register("search_rmse_20_check", _GRID_SQL)
def q_search_rmse_20_check(spark, d):
    return _search_check(spark, _search(spark, d, "rmse", 20)[0], 20, min)


_DOC_SPLIT_SQL = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 70"


@register("doc_quality_check", _held_out_sql("quality", f"FROM documents JOIN labels USING (doc_id) WHERE {_DOC_SPLIT_SQL}"))
def q_doc_quality_check(spark, d):
    return _held_out(q_doc_quality_classify(spark, d), "prediction in (0, 1)", label="quality", compare="quality", floor=0.5)


@register("random_split_check",
          "SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys, CAST(sum(l_orderkey) AS BIGINT) AS key_sum, "
          "TRUE AS about_70_percent FROM lineitem")
def q_random_split_check(spark, d):
    both = q_random_split(spark, d)
    share = F.count_if(F.col("split") == "train") / F.count("*")
    return both.agg(F.count("*").alias("n_rows"), F.count_distinct(*KEYS).alias("n_keys"), F.sum("l_orderkey").cast("long").alias("key_sum"),
                    share.between(0.67, 0.73).alias("about_70_percent"))


def _ranks_hold(df: DataFrame, columns: list[str], bounds: dict, error: float) -> DataFrame:
    """Per column whether the stated quartiles have ranks within ``error`` of 0.25 and 0.75."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        for q, p in zip(bounds[c], (0.25, 0.75)):
            # ranks of a value that repeats: from the rows below it to the rows up to it
            low, high = F.count_if(x < q) / F.count(x), F.count_if(x <= q) / F.count(x)
            aggs.append(((low <= p + error) & (high >= p - error)).alias(f"r{i}_{p}"))
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`r{i}_0.25`").alias("q1_holds"),
                                                  F.col(f"`r{i}_0.75`").alias("q3_holds")) for i, c in enumerate(columns)])))


def _ranks_sql(columns: list[str], table: str) -> str:
    return _union([f"SELECT '{c}' AS \"column\", count(*) > 0 AS q1_holds, count(*) > 0 AS q3_holds FROM {table}" for c in columns])


@register("quartiles_approx_check", _ranks_sql(_DESC_COLS, "lineitem"))
def q_quartiles_approx_check(spark, d):
    bounds = {r["column"]: (r["q1"], r["q3"]) for r in q_quartiles_approx(spark, d).collect()}
    return _ranks_hold(labelled(spark, d), _DESC_COLS, bounds, 0.05)


@register("iqr_outlier_counts_approx_check", _ranks_sql(OUTLIER_COLUMNS, "events"))
def q_iqr_outlier_counts_approx_check(spark, d):
    rows = q_iqr_outlier_counts_approx(spark, d).collect()
    ev = tables.read_table(spark, d, "events")
    held = _ranks_hold(ev, OUTLIER_COLUMNS, {r["column"]: (r["q1"], r["q3"]) for r in rows}, 0.05)
    # the counts are those of the stated bounds
    counted = ev.agg(*[F.count_if((F.col(r["column"]) < r["lower"]) | (F.col(r["column"]) > r["upper"])).alias(r["column"]) for r in rows]).first()
    right = all(counted[r["column"]] == r["outliers"] for r in rows)
    return held.withColumn("q1_holds", F.col("q1_holds") & F.lit(right))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Split, assemble, min-max scale, forest regressor, round to classes,
    confusion counts of the held-out rows."""
    train, test = _split(spark, d)
    fitted = _fit(models.forest_regressor(FEATURES, LABEL, num_trees=10, max_depth=5), train)
    return metrics.confusion_counts(fitted.transform(test), LABEL, models.ORDINAL)
