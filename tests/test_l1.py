"""The L1 solver: optimality, parity with Spark's estimator, missing values, layouts."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabml.plans import l1

COLS = ["a", "b", "c", "flat"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 3)) * [1, 50, 0.01] + [0, 1000, 0]
    score = np.stack([x[:, 0], -x[:, 0] + 60 * x[:, 2], 0.02 * (x[:, 1] - 1000)], axis=1) + rng.gumbel(size=(1500, 3))
    y = score.argmax(axis=1)
    rows = [(float(a), float(b), float(c), 7.5, float(k), ["red", "green", "blue"][k], i) for i, ((a, b, c), k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, flat double, y double, colour string, i int").repartition(5).cache()


@pytest.mark.parametrize(("reg", "mix"), [(0.01, 1.0), (0.05, 0.5), (0.02, 0.0), (1.0, 1.0)])
def test_same_optimum_as_the_estimator(table, reg, mix):
    m = l1.fit_logistic(table, COLS, "y", reg=reg, elastic_net=mix, max_passes=40, tolerance=1e-10)
    data = VectorAssembler(inputCols=COLS, outputCol="x").transform(table)
    s = LogisticRegression(featuresCol="x", labelCol="y", regParam=reg, elasticNetParam=mix, maxIter=2000, tol=1e-14, family="multinomial").fit(data)
    w, b = s.coefficientMatrix.toArray(), s.interceptVector.toArray()
    assert m.objective[-1] <= s.summary.objectiveHistory[-1] + 1e-9
    assert np.allclose(m.coefficients * m.deviations, w * m.deviations, atol=1e-4)
    assert np.allclose(m.intercepts - m.intercepts.mean(), b - b.mean(), atol=2e-2)
    assert m.residual.max() < 1e-9 and m.passes <= 40
    assert (m.coefficients[:, 3] == 0).all()
    assert all(x >= y - 1e-12 for x, y in zip(m.objective, m.objective[1:]))


def test_full_penalty_leaves_the_class_shares(table):
    m = l1.fit_logistic(table, COLS, "y", reg=10.0)
    assert not m.coefficients.any()
    shares = np.array([r["count"] for r in table.groupBy("y").count().orderBy("y").collect()]) / 1500
    assert np.allclose(np.exp(m.intercepts) / np.exp(m.intercepts).sum(), shares, atol=1e-7)


def test_predictions_in_built_in_expressions(table):
    m = l1.fit_logistic(table, COLS, "colour")
    assert m.labels == ["blue", "green", "red"]
    out = m.predict(table, "guess", "p")
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    x = np.array([[r[c] for c in COLS] for r in rows])
    z = x @ m.coefficients.T + m.intercepts
    p = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose([r["p"] for r in rows], p / p.sum(axis=1, keepdims=True))
    assert [r["guess"] for r in rows] == [m.labels[k] for k in z.argmax(axis=1)]
    assert np.mean([r["guess"] == r["colour"] for r in rows]) > 0.6


def test_missing_features_and_labels(spark, table):
    odd = table.withColumn("a", F.when(F.col("i") % 7 == 0, None).when(F.col("i") % 7 == 1, float("nan")).when(F.col("i") % 7 == 2, float("inf")).otherwise(F.col("a")))
    odd = odd.withColumn("colour", F.when(F.col("i") % 5 != 0, F.col("colour")))
    m = l1.fit_logistic(odd, COLS, "colour")
    clean = l1.fit_logistic(odd.where("i % 7 > 2 and i % 5 != 0"), COLS, "colour")
    assert m.rows == clean.rows == table.where("i % 7 > 2 and i % 5 != 0").count()
    assert np.allclose(m.coefficients, clean.coefficients) and m.residual.max() < 1e-8
    with pytest.raises(ValueError, match="missing"):
        l1.fit_logistic(odd, COLS, "colour", missing="error")
    assert m.predict(odd).where("i % 7 <= 2 and prediction is not null").count() == 0
    with pytest.raises(ValueError, match="no row"):
        l1.fit_logistic(odd.where("false"), COLS, "colour")
    with pytest.raises(ValueError, match="class label"):
        l1.fit_logistic(table, COLS, "i")


def test_layout_does_not_matter_and_a_third_may_be_copies(spark, table):
    many = table.unionByName(table.where("i = 3").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(700)))).drop("k"))
    a = l1.fit_logistic(many.repartition(1), COLS, "y")
    b = l1.fit_logistic(many.repartition(11), COLS, "y")
    assert a.rows == 2200 and np.allclose(a.coefficients, b.coefficients, rtol=1e-5, atol=1e-9)


def test_one_class_and_certificate(spark, table):
    m = l1.fit_logistic(table.where("y = 1"), COLS, "y")
    assert m.labels == [1.0] and not m.coefficients.any()
    c = l1.fit_logistic(table, COLS, "y", max_passes=2)
    assert c.passes == 2 and c.residual.max() > 1e-8  # the certificate tells that it isn't there yet
    rows = c.certificate(spark).collect()
    assert len(rows) == 15 and sum(r["feature"] is None for r in rows) == 3


def test_shares_are_computed_once_a_row(table):
    """A margin named inside a lambda is computed again for each class, and its exponential for each class of each class."""
    m = l1.fit_logistic(table, COLS, "y", reg=0.01)
    plan = m.predict(table, probability="p").select("p")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("exp(") == 1 and plan.count("array_max(") == 1
    z = np.array([[r[c] for c in COLS] for r in table.collect()]) @ m.coefficients.T + m.intercepts
    e = np.exp(z - z.max(axis=1, keepdims=True))
    got = np.array([r.p for r in m.predict(table, probability="p").select("p").collect()])
    assert np.allclose(got, e / e.sum(axis=1, keepdims=True), atol=1e-12)
