"""Type inference, profile states, forests as node tables, over edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml import queries as Q
from tabml.operators import profile_state
from tabml.plans import models, trees
from tabml.sources import inference

from .conftest import SF001


def kinds(spark, values, **how):
    return inference.infer_types(spark.createDataFrame([(v,) for v in values], "c string").repartition(4), **how)["c"]


@pytest.mark.parametrize(("values", "kind"), [
    (["1", "-2", "+3", None, ""], "int"), (["1", "3000000000"], "bigint"), (["1", "99999999999999999999"], "double"), (["1", "2.5", "1e9", ".5", "-Infinity", "NaN"], "double"),
    (["1", "2", "x"], "string"), (["1", " 2"], "string"), (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["2024-01-02", "1999-12-31"], "date"),
    (["2024-01-02", "2024-01-02 03:04:05"], "timestamp"), (["2024-01-02T03:04:05.123Z"], "timestamp"), (["2024-02-30"], "string"), (["2024-01-02", "5"], "string"), ([None, ""], "string"), ([], "string"),
    (["1d"], "string"), (["0x1"], "string"), (["é"], "string")])
def test_narrowest_type_of_all_values(spark, values, kind):
    assert kinds(spark, values) == kind


def test_one_text_among_many_numbers_decides(spark):
    df = spark.range(200_000, numPartitions=8).select(F.when(F.col("id") == 199_999, "n/a").otherwise(F.col("id").cast("string")).alias("`a.b`"), F.lit("7").alias("d"))
    assert inference.infer_types(df) == {"`a.b`": "string", "d": "int"}
    assert inference.infer_types(df, nulls=("", "n/a")) == {"`a.b`": "int", "d": "int"}
    out = inference.typed(df, nulls=("", "n/a"))
    assert dict(out.dtypes) == {"`a.b`": "int", "d": "int"} and out.where(F.col("```a.b```").isNull()).count() == 1
    assert inference.inferred_schema(df.select("d")).simpleString() == "struct<d:int>"


def test_profile_of_parts_is_that_of_the_whole(spark, tmp_path):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.lognormal(3, 2, 4000), -rng.exponential(5, 2000), np.zeros(300), np.full(3000, 1e6 + 0.25)])
    rng.shuffle(x)
    rows = [(float(v), float(1e9 + i % 3), None if i % 4 else (float("nan") if i % 8 else float("inf")), i) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, `far off` double, odd double, i int").repartition(6)
    cols = ["x", "far off", "odd"]
    for k in range(3):
        profile_state.add_part(spark, str(tmp_path / "p"), f"{k}", df.where(F.col("i") % 3 == k), cols)
    states = profile_state.read_states(spark, str(tmp_path / "p"))
    got = {r["column"]: r for r in profile_state.profile_of(states, (0.0, 0.1, 0.5, 0.9, 1.0), digits=None).collect()}
    whole = {r["column"]: r for r in profile_state.profile_of(profile_state.profile_state(df, cols), (0.0, 0.1, 0.5, 0.9, 1.0), digits=None).collect()}
    for c in ("x", "far off"):
        assert (got[c].rows, got[c].missing) == (9300, 0)
        v = np.array([r[cols.index(c)] for r in rows])
        for k, want in (("mean", v.mean()), ("stddev", v.std(ddof=1)), ("min", v.min()), ("max", v.max())):
            assert got[c][k] == pytest.approx(want, rel=1e-8) and whole[c][k] == pytest.approx(want, rel=1e-8)
    order = np.sort(x)
    for p, q in zip((0.0, 0.1, 0.5, 0.9, 1.0), got["x"].quantiles):
        exact = order[max(0, math.ceil(p * len(x)) - 1)]
        assert abs(q - exact) <= 0.011 * abs(exact) + 1e-12
    odd = got["odd"]
    assert odd.rows == 9300 and odd.missing == sum(r[2] is None or math.isnan(r[2]) for r in rows) and odd["max"] == float("inf") and odd["mean"] is None
    # a part of the same name is replaced, and only it is scanned again
    profile_state.add_part(spark, str(tmp_path / "p"), "2", df.where("false"), cols)
    again = {r["column"]: r for r in profile_state.profile_of(profile_state.read_states(spark, str(tmp_path / "p"))).collect()}
    assert again["x"].rows == 6200


def test_nodes_of_classifiers_and_regressors_predict_as_the_forest(spark):
    df = Q.labelled(spark, SF001)
    for pipe in (models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=4, max_depth=6), models.forest_classifier(Q.FEATURES, Q.LABEL, num_trees=5, max_depth=5),
                 models.forest_classifier(Q.FEATURES, Q.LABEL, num_trees=3, max_depth=4, index_label=True), models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=1, max_depth=0)):
        m = models.fit(pipe, df)
        both = trees.predict_by_nodes(m, m.transform(df).select(*Q.KEYS, *Q.FEATURES, Q.LABEL, F.col("prediction").alias("before")))
        assert both.count() == df.count()
        assert both.where("abs(prediction - before) > 1e-9").count() == 0
        assert "Python" not in both._jdf.queryExecution().executedPlan().toString()


def test_nodes_with_categories(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler, VectorIndexer
    from pyspark.ml.regression import RandomForestRegressor
    df = spark.range(600).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 50 * 1.0).alias("b")).withColumn("y", F.when(F.col("a").isin(1.0, 4.0, 6.0), 5.0).otherwise(F.col("b") / 10))
    m = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v"), VectorIndexer(inputCol="v", outputCol="x", maxCategories=10),
                         RandomForestRegressor(featuresCol="x", labelCol="y", numTrees=3, maxDepth=5, seed=1)]).fit(df)
    assert trees.model_nodes(spark, m).where("categories is not null").count() > 0
    both = trees.predict_by_nodes(m, m.transform(df).select("a", "b", "y", F.col("prediction").alias("before")))
    assert both.count() == 600 and both.where("abs(prediction - before) > 1e-9").count() == 0


def test_known_types_are_not_inferred_again(spark):
    unread = spark.range(1).select(F.raise_error(F.lit("read")).cast("string").alias("c"))
    assert inference.typed(unread, kinds={"c": "int"}).schema.simpleString() == "struct<c:int>"


def test_a_text_is_matched_until_its_kind_is_found(spark):
    """The kinds exclude each other: five patterns at most, each in one branch."""
    df = spark.createDataFrame([("7",), ("-0.5",), ("2020-01-01",), ("2020-01-01 10:00",), ("true",), ("n",), ("",), (None,)], "c string")
    bits = df.select("c", inference.accepting(F.col("c")).alias("b"))
    assert bits._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") <= 5
    kinds = {r.c: {t for i, t in enumerate(inference.TYPES) if r.b >> i & 1} for r in bits.collect()}
    assert kinds == {"7": {"int", "bigint", "double", "string"}, "-0.5": {"double", "string"}, "2020-01-01": {"date", "timestamp", "string"},
                     "2020-01-01 10:00": {"timestamp", "string"}, "true": {"boolean", "string"}, "n": {"string"}, "": {"string"}, None: set(inference.TYPES)}
