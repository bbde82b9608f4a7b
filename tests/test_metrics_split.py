"""Metrics equal Spark's evaluators; splits are disjoint, complete and
independent of partitioning."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from tabml import queries as Q
from tabml.operators import metrics, split

from .conftest import SF01


def _eval(df, name, label="quality", pred="prediction"):
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=pred, metricName=name).evaluate(
        df.withColumn(label, F.col(label).cast("double")))


def test_metrics_equal_evaluators(spark):
    df = Q.ruled(spark, SF01)
    m = metrics.metrics_from_confusion(metrics.confusion_counts(df, "quality", "prediction"), digits=None).first()
    assert m["weighted_f1"] == pytest.approx(_eval(df, "f1"), abs=1e-12)
    assert m["accuracy"] == pytest.approx(_eval(df, "accuracy"), abs=1e-12)
    rm = RegressionEvaluator(labelCol="quality", predictionCol="raw", metricName="rmse").evaluate(
        df.withColumn("quality", F.col("quality").cast("double")))
    assert metrics.rmse(df, "quality", "raw", digits=None).first()["rmse"] == pytest.approx(rm, abs=1e-12)
    assert m["weighted_f1"] == pytest.approx(0.508274, abs=1e-6)  # value stated for the fixture


def test_one_pass_report_with_rmse_equals_evaluators(spark):
    df = Q.ruled(spark, SF01)
    rep = metrics.metrics_report(df, "quality", "prediction", raw="raw")
    got = {r["metric"]: r["value"] for r in rep.collect()}
    rm = RegressionEvaluator(labelCol="quality", predictionCol="raw", metricName="rmse").evaluate(
        df.withColumn("quality", F.col("quality").cast("double")))
    assert got["rmse"] == pytest.approx(rm, abs=1e-6)
    assert got["f1"] == pytest.approx(_eval(df, "f1"), abs=1e-6)
    assert got["accuracy"] == pytest.approx(_eval(df, "accuracy"), abs=1e-6)
    plan = rep._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1


def test_single_class_and_predicted_only_class(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 1.0)], "label double, prediction double")
    m = metrics.metrics_from_confusion(metrics.confusion_counts(df), digits=None).first()
    assert m["weighted_f1"] == pytest.approx(_eval(df, "f1", "label"))
    assert m["accuracy"] == pytest.approx(2 / 3)


def test_metrics_report_percent(spark):
    rep = {r["metric"]: r for r in metrics.metrics_report(Q.ruled(spark, SF01), "quality", "prediction").collect()}
    assert rep["f1"]["pct"] == round(rep["f1"]["value"] * 100, 1)


def test_hash_split_disjoint_complete_partition_independent(spark):
    li = Q.labelled(spark, SF01)
    tr, te = split.hash_split(li, "l_orderkey", 70)
    n, ntr, nte = li.count(), tr.count(), te.count()
    assert ntr + nte == n and ntr == 42083  # stated for the fixture
    a = {tuple(r) for r in split.with_split(li.repartition(7), "l_orderkey").groupBy("split").count().collect()}
    b = {tuple(r) for r in split.with_split(li.coalesce(1), "l_orderkey").groupBy("split").count().collect()}
    assert a == b
    # an order's lines stay on one side
    assert split.with_split(li, "l_orderkey").groupBy("l_orderkey").agg(
        F.countDistinct("split").alias("k")).where("k > 1").count() == 0


def test_folds_in_range_and_balanced(spark):
    f = split.with_folds(Q.labelled(spark, SF01), "l_orderkey", 3).groupBy("fold").count().collect()
    counts = {r["fold"]: r["count"] for r in f}
    assert set(counts) == {0, 1, 2}
    assert min(counts.values()) > 0.25 * sum(counts.values())


def test_random_split_complete(spark):
    li = Q.labelled(spark, SF01)
    tr, te = split.random_split(li, (0.7, 0.3), 42)
    assert tr.count() + te.count() == li.count()


def test_row_key_splits_a_hot_group_of_copies(spark):
    """A third of the rows are one repeated row: keyed by content alone they
    would all fall on one side; with the row key the split stays 70/30."""
    li = Q.labelled(spark, SF01).select(*Q.FEATURES)
    n = li.count()
    copies = spark.range(n // 2).select(*[F.lit(1.0).alias(c) for c in Q.FEATURES])
    data = li.unionByName(copies)
    total = data.count()
    by_content, _ = split.hash_split(data, data.columns)
    keyed = split.with_row_key(data)
    by_row, _ = split.hash_split(keyed, keyed.columns)
    share_row = by_row.count() / total
    assert abs(share_row - 0.70) < 0.02
    share_content = by_content.count() / total
    assert abs(share_content - 0.70) > 0.1  # the copies moved together


def test_metrics_property_against_evaluators(spark):
    """Random label/prediction pairs, including classes that are only
    predicted or never predicted: F1, accuracy and RMSE from one confusion
    table equal Spark's evaluators."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    pairs = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 7)), min_size=1, max_size=80)

    @settings(max_examples=10, deadline=None, derandomize=True,
              suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
    @given(pairs)
    def check(rows):
        df = spark.createDataFrame([(float(a), float(b), b + 0.25) for a, b in rows],
                                   "label double, prediction double, raw double")
        got = {r["metric"]: r["value"] for r in
               metrics.metrics_report(df, "label", "prediction", raw="raw").collect()}
        assert got["f1"] == pytest.approx(_eval(df, "f1", "label"), abs=1e-6)
        assert got["accuracy"] == pytest.approx(_eval(df, "accuracy", "label"), abs=1e-6)
        rm = RegressionEvaluator(labelCol="label", predictionCol="raw", metricName="rmse").evaluate(df)
        assert got["rmse"] == pytest.approx(rm, abs=1e-6)

    check()


def test_hash_split_keeps_rows_with_null_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(5)] + [(i, i) for i in range(200)], "k int, v int")
    train, test = split.hash_split(df, "k", 70)
    assert train.count() + test.count() == df.count()
    assert train.join(test, ["k", "v"]).count() == 0


def test_one_rule_for_rows_without_label_or_prediction(spark):
    rows = [(1.0, 1.0, 1.2), (2.0, 1.0, 1.4), (None, 1.0, 1.0), (2.0, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "y double, p double, raw double")
    report = metrics.metric_values(df, "y", "p", "raw")
    assert report["accuracy"] == metrics.accuracy(df, "y", "p").first()[0] == 0.5
    assert report["rmse"] == pytest.approx(metrics.rmse(df, "y", "raw").first()[0]) == pytest.approx(((0.04 + 0.36) / 2) ** 0.5)
    assert report["f1"] == metrics.weighted_f1(df, "y", "p").first()[0]
    none = metrics.metric_values(df.limit(0), "y", "p", "raw")
    assert none == {"f1": None, "accuracy": None, "rmse": None}
