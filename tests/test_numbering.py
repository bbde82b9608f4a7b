"""Row numbers, frequency index, exact split, copy-balanced layout, bootstrap."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml import queries as Q
from tabml.operators import columns, numbering, profile, split
from tabml.plans import models

from .conftest import SF001


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 rows, a third of them equal."""
    return spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("v"))


def sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_row_numbers_with_nulls_ties_and_copies(spark):
    rows = [(None, "b", 1.0), (3, None, float("nan")), (3, "a", 2.0), (3, "a", 2.0), (1, "z", -0.0), (None, None, None), (2, "x", 5.0)] * 3
    df = spark.createDataFrame(rows, "n int, `odd.name` string, x double").repartition(5)
    out = numbering.row_numbers(df, [("n", "desc_nulls_last"), "odd.name"], "number").orderBy("number").collect()
    assert [r["number"] for r in out] == list(range(1, 22))
    assert [r["n"] for r in out] == [3] * 9 + [2] * 3 + [1] * 3 + [None] * 6
    assert [r["odd.name"] for r in out][:9] == [None] * 3 + ["a"] * 6
    again = numbering.row_numbers(df.repartition(1), [("n", "desc_nulls_last"), "odd.name"], "number").orderBy("number").collect()
    assert str(again) == str(out)
    assert numbering.row_numbers(df.where("false"), ["n"]).collect() == []
    assert sorted(r["i"] for r in numbering.row_numbers(df, ["x"], "i", start=0).collect()) == list(range(21))


def test_row_numbers_of_a_hot_key_go_to_many_tasks(spark, hot):
    out = numbering.row_numbers(hot, ["k"], "i", partitions=8)
    got = out.orderBy("i").collect()
    assert [r["i"] for r in got] == list(range(1, 30_001)) and [r["k"] for r in got] == sorted(r["k"] for r in got)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    # files are the partitions: none holds much more than its share, though a third of the rows are equal
    per_file = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) == 8 and max(per_file) < 2 * 30_000 / 8


def test_join_by_position(spark):
    a = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "i int, x string").repartition(3)
    b = spark.createDataFrame([(10,), (30,), (20,), (40,)], "y int").repartition(2)
    assert sorted(map(tuple, numbering.join_by_position(a, ["i"], b, ["y"]).collect())) == [(1, "a", 10), (2, "b", 20), (3, "c", 30)]


def test_index_keys(spark, hot):
    df = hot.withColumn("k", F.when(F.col("k") != 11, F.col("k")))
    out = numbering.index_keys(df, "k", "rank")
    n = Counter(r["k"] for r in df.collect())
    order = sorted((k for k in n if k is not None), key=lambda k: (-n[k], k))
    want = {k: float(i) for i, k in enumerate(order)} | {None: float(len(order))}
    got = out.collect()
    assert len(got) == 30_000 and all(r["rank"] == want[r["k"]] for r in got)
    assert numbering.index_keys(df.where("false"), "k").collect() == []


@pytest.mark.parametrize("few", [65_536, 1])
def test_exact_split_takes_exact_shares(spark, hot, few, monkeypatch):
    monkeypatch.setattr(split, "FEW", few)
    df = hot.withColumn("label", F.when(F.col("k") == 7, None).otherwise(F.col("k") % 4).cast("int")).withColumn("w", F.col("k") * 0.5)
    out = split.exact_split(df, ["k", "v"], "label", 70).collect()
    n = Counter(r["label"] for r in df.collect())
    train = Counter(r["label"] for r in out if r["split"] == "train")
    assert len(out) == 30_000 and sorted(map(str, (r[:-1] for r in out))) == sorted(map(str, (tuple(r) for r in df.collect())))
    assert {k: train[k] for k in n} == {k: v * 70 // 100 for k, v in n.items()}
    again = split.exact_split(df.repartition(3), ["k", "v"], "label", 70).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


def test_exact_split_edges(spark):
    df = spark.range(10).withColumn("label", F.when(F.col("id") == 9, "one").otherwise("many"))
    assert Counter((r["label"], r["split"]) for r in split.exact_split(df, "id", "label", 50).collect()) == {("many", "train"): 4, ("many", "test"): 5, ("one", "test"): 1}
    assert split.exact_split(df, "id", "label", 0).where("split = 'train'").count() == 0
    assert split.exact_split(df, "id", None, 100).where("split = 'train'").count() == 10
    assert split.exact_split(df, "id", None, 35).where("split = 'train'").count() == 3
    assert split.exact_split(df.where("false"), "id", "label").collect() == []
    doubles = df.withColumn("label", F.col("id") % 2 * 0.5)
    assert Counter((r["label"], r["split"]) for r in split.exact_split(doubles, "id", "label", 60).collect()) == {(0.0, "train"): 3, (0.0, "test"): 2, (0.5, "train"): 3, (0.5, "test"): 2}


def test_copies_are_spread_over_a_layout(spark, hot):
    many = hot.unionByName(hot.where("v = 'same'")).withColumn("x", F.lit(1.5))
    laid = columns.fixed_layout(many, partitions=16)
    rows = [r["n"] for r in laid.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(rows) == 40_000 and len(rows) == 16 and max(rows) < 2 * 40_000 / 16
    parts = [sorted(map(tuple, p)) for p in laid.rdd.glom().collect()]
    others = [sorted(map(tuple, p)) for p in columns.fixed_layout(many.repartition(3), partitions=16).rdd.glom().collect()]
    assert parts == others
    assert Counter(x for p in parts for x in p) == Counter(map(tuple, many.collect()))


@pytest.mark.parametrize("splits", [1, 4, 8])
def test_a_forest_is_the_same_on_any_splits_of_rows_with_copies(spark, splits):
    df = Q.labelled(spark, SF001).select(*Q.FEATURES, Q.LABEL)
    df = df.unionByName(df.limit(1).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("i"))
    model = models.fit(models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=3, max_depth=4), df.repartition(splits), partitions=8)
    shown = models.model_stage(model, "RandomForestRegressionModel").toDebugString
    reference = _SHOWN.setdefault("first", shown)
    assert shown.split("\n", 1)[1] == reference.split("\n", 1)[1]


_SHOWN: dict = {}


def test_only_forests_pay_for_a_layout(spark, monkeypatch):
    calls = []
    real = models.fixed_layout
    monkeypatch.setattr(models, "fixed_layout", lambda *a, **k: calls.append(a) or real(*a, **k))
    df = Q.labelled(spark, SF001)
    models.fit(models.logistic_regression(Q.FEATURES, Q.LABEL, max_iter=2), df)
    assert not calls
    models.fit(models.forest_classifier(Q.FEATURES, Q.LABEL, num_trees=1, max_depth=2), df)
    assert len(calls) == 1


def test_draws_are_poisson_and_independent():
    w = profile.draws(np.arange(4000)[:, None], np.arange(300)[None, :], 1)
    share = np.bincount(w.ravel(), minlength=6) / w.size
    assert np.allclose(share[:6], [math.exp(-1) / math.factorial(k) for k in range(6)], atol=2e-3)
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.06 and abs(np.corrcoef(w[0], w[1])[0, 1]) < 0.2
    assert abs(w.mean(axis=0).std() - math.sqrt(1 / 4000)) < 0.004  # as the spread of such means is
    assert abs(w.mean(axis=1).std() - math.sqrt(1 / 300)) < 0.006


def test_bootstrap_interval_against_numpy(spark):
    rng = np.random.default_rng(6)
    data = {"a": rng.exponential(3, 900), "b": rng.normal(10, 2, 60), None: rng.normal(size=40)}
    rows = [(g, i * 31 + 5, float(v)) for g, x in data.items() for i, v in enumerate(x)]
    rows += [("a", 1, None), ("a", 2, float("nan")), ("b", 3, float("inf")), ("empty", 4, None), ("single", None, 4.0)]
    df = spark.createDataFrame(rows, "g string, k long, v double").repartition(4)
    got = {r["g"]: r for r in profile.group_mean_bootstrap(df, "g", "v", "k", replicates=1500, digits=None).collect()}
    assert set(got) == {"a", "b", None, "single"} and got["single"].low == got["single"].high == 4.0
    for g, x in data.items():
        means = rng.choice(x, (4000, len(x))).mean(axis=1)
        low, high = np.quantile(means, [0.025, 0.975])
        width = high - low
        assert got[g].n == len(x) and got[g]["mean"] == pytest.approx(x.mean())
        assert abs(got[g].low - low) < 0.12 * width and abs(got[g].high - high) < 0.12 * width
    again = {r["g"]: r for r in profile.group_mean_bootstrap(df.repartition(1), "g", "v", "k", replicates=1500).collect()}
    assert {g: (round(r.low, 7), round(r.high, 7)) for g, r in got.items()} == {g: (r.low, r.high) for g, r in again.items()}
