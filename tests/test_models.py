"""Models: held-out quality floors on the learnable fixture, determinism,
save/load equality, summaries, grid search on hash folds."""

import pytest
from pyspark.sql import functions as F

from tabml import queries as Q
from tabml.operators import metrics, split
from tabml.plans import models, tuning
from tabml.sources import models as model_io
from tabml.session import scratch_path

from .conftest import SF01


@pytest.fixture(scope="module")
def data(spark):
    return split.hash_split(Q.labelled(spark, SF01), "l_orderkey")


def _f1(df, label, pred):
    return metrics.weighted_f1(df, label, pred, digits=None).first()["weighted_f1"]


def test_ordinal_forest_beats_constant_guess(spark, data):
    train, test = data
    fitted = models.fit(models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=10, max_depth=8), train)
    scored = fitted.transform(test)
    f1 = _f1(scored, Q.LABEL, models.ORDINAL)
    constant = _f1(test.withColumn("p", F.lit(5.0)), Q.LABEL, "p")
    assert f1 > 0.9 and constant < 0.1
    # the raw regression output stays for RMSE, the rounded one is whole
    assert scored.where(f"{models.ORDINAL} != round(prediction, 0)").count() == 0


def test_logistic_regression_floor_and_l1(spark, data):
    train, test = data
    m = models.fit(models.logistic_regression(Q.FEATURES, Q.LABEL, scale="minmax"), train)
    assert _f1(m.transform(test), "label", "prediction") > 0.7
    l1 = models.fit(models.logistic_regression(Q.FEATURES, Q.LABEL, reg=0.01, elastic_net=1.0,
                                               scale="minmax"), train)
    assert _f1(l1.transform(test), "label", "prediction") > 0.6


def test_classifier_probabilities_sum_to_one(spark, data):
    train, test = data
    m = models.fit(models.forest_classifier(Q.FEATURES, Q.LABEL, num_trees=5, max_depth=5), train)
    from pyspark.ml.functions import vector_to_array
    s = m.transform(test).select(F.aggregate(vector_to_array("probability"), F.lit(0.0),
                                             lambda a, b: a + b).alias("s"))
    assert s.agg(F.min("s"), F.max("s")).first() == pytest.approx((1.0, 1.0))


def test_same_seed_same_model_and_save_load(spark, data):
    train, test = data
    pipe = models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=5, max_depth=6, seed=7)
    a, b = models.fit(pipe, train), models.fit(pipe, train)
    pa = a.transform(test).select(*Q.KEYS, "l_quantity", "prediction")
    pb = b.transform(test).select(*Q.KEYS, "l_quantity", F.col("prediction").alias("pb"))
    path = model_io.save_pipeline(a, scratch_path(spark, "model-test"))
    pc = model_io.load_pipeline(path).transform(test).select(F.col("prediction").alias("pc"))
    assert sorted(r[0] for r in pa.select("prediction").collect()) == sorted(r[0] for r in pb.select("pb").collect())
    assert sorted(r[0] for r in pa.select("prediction").collect()) == sorted(r[0] for r in pc.collect())


def test_spec_save_load_params(spark):
    pipe = models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=25, max_depth=20)
    path = model_io.save_spec(pipe, scratch_path(spark, "spec-test"))
    from pyspark.ml import Pipeline
    loaded = model_io.load_spec(Pipeline, path)
    params = {(r["stage"], r["param"]): r["value"] for r in model_io.spec_params(spark, loaded).collect()}
    assert params[("RandomForestRegressor", "numTrees")] == "25"
    assert params[("RandomForestRegressor", "maxDepth")] == "20"
    assert params[("MinMaxScaler", "outputCol")] == "normalizedFeatures"


def test_model_summary(spark, data):
    train, _ = data
    fitted = models.fit(models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=4, max_depth=3), train)
    row = models.model_summary(spark, fitted).first()
    assert row["kind"] == "RandomForestRegressionModel" and row["trees"] == 4 and row["features"] == 4
    assert row["max_depth"] <= 3


def test_cross_validation_on_hash_folds_is_repeatable(spark, data):
    train, _ = data
    train = split.with_folds(train, "l_orderkey", 3)
    pipe = models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=3, max_depth=3)
    grid = tuning.param_grid(pipe.getStages()[2], {"maxDepth": [2, 4]})
    runs = [tuning.cross_validate(pipe, grid, tuning.f1_evaluator(Q.LABEL), train, folds=3).avgMetrics
            for _ in range(2)]
    assert runs[0] == runs[1]
    assert runs[0][1] > runs[0][0]  # deeper trees score better on rounded F1
    assert tuning.cv_table(spark, tuning.cross_validate(
        pipe, grid, tuning.rmse_evaluator(Q.LABEL), train, folds=3)).count() == 2


def test_document_quality_beats_majority_class(spark):
    from .conftest import SF01
    scored = Q.QUERIES["doc_quality_classify"](spark, SF01)
    f1 = _f1(scored, "quality", "prediction")
    majority = _f1(scored.withColumn("p", F.lit(1.0)), "quality", "p")
    assert f1 > majority + 0.03, (f1, majority)


def _labelled(spark, n=300):
    return spark.range(n).selectExpr("id", "cast(id % 7 as double) a", "cast(id % 11 as double) b", "if(id % 3 = 0, null, cast(id % 7 > 3 as int)) y")


def test_null_labels_are_no_class_and_a_binary_label_has_two(spark):
    df = _labelled(spark)
    fitted = models.fit(models.logistic_regression(["a", "b"], "y", max_iter=20), df)
    lr = models.model_stage(fitted)
    assert lr.numClasses == 2 and lr.coefficientMatrix.numRows == 1
    scored = fitted.transform(df.unionByName(df.limit(1).withColumn("y", F.lit(9))))
    assert scored.count() == 301 and {r["prediction"] for r in scored.select("prediction").distinct().collect()} <= {0.0, 1.0}
    forest = models.fit(models.forest_classifier(["a", "b"], "y", num_trees=3, index_label=True), df)
    assert models.model_stage(forest, "RandomForestClassificationModel").numClasses == 2
    assert models.fit(models.forest_regressor(["a", "b"], "y", num_trees=2), df).transform(df).count() == 300


@pytest.mark.parametrize("persist", [True, False])
def test_a_model_depends_on_the_rows_and_not_on_their_layout(spark, persist):
    df = _labelled(spark, 2000).na.drop()
    sums = set()
    for n in (1, 4, 8):
        pipe = models.forest_regressor(["a", "b"], "y", num_trees=5, max_depth=6)
        fitted = models.fit(pipe, df.repartition(n), keys=["id"], partitions=4, persist=persist)
        sums.add(fitted.transform(df).agg(F.sum("prediction")).first()[0])
    assert len({round(s, 9) for s in sums}) == 1


def test_a_fit_keeps_what_its_pipeline_reads(spark, data, monkeypatch):
    train, _ = data
    kept, persisted = [], models.persisted
    monkeypatch.setattr(models, "persisted", lambda df: (kept.append(df.columns), persisted(df))[1])
    wide = train.select(*Q.KEYS, *Q.FEATURES, Q.LABEL)
    models.fit(models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=2, max_depth=2), wide, keys=["l_orderkey"])
    models.fit(models.logistic_regression(Q.FEATURES, Q.LABEL, max_iter=2), wide)
    assert kept == [[*Q.FEATURES, Q.LABEL]] * 2


def test_checks_score_the_held_out_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def scored(x):
        seen.add(1)
        return float(x % 3)

    rows = spark.range(300).select((F.col("id") % 2).cast("int").alias("y"), F.udf(scored, "double")("id").alias("prediction"))
    got = Q._held_out(rows, "prediction < 2", label="y", compare="y", floor=0.9).collect()
    assert seen.value == 300
    assert [tuple(r) for r in got] == [(300, 150, 100, False)]
    none = Q._held_out(rows.limit(0), "prediction < 2", label="y", compare="y")
    assert [tuple(r) for r in none.collect()] == [(0, None, 0, False)]


def test_train_job_writes_its_inputs_once(spark, monkeypatch):
    from .conftest import SF001
    written, inputs = [], Q._job_inputs
    monkeypatch.setattr(Q, "_job_inputs", lambda *a: (written.append(a), inputs(*a))[1])
    got = {r["model"]: r["scored_rows"] for r in Q.q_train_job(spark, SF001).collect()}
    assert len(written) == 1 and len(got) == 3 and len(set(got.values())) == 1


def test_a_deep_forest_keeps_its_rows_nodes_only_where_the_memory_holds_them(spark, data, monkeypatch):
    train, _ = data
    pipe = models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=5, max_depth=12, seed=7)
    assert models.storage_memory(spark) > 1 << 28
    kept = models.model_stage(models.fit(pipe, train))
    monkeypatch.setattr(models, "storage_memory", lambda spark: 1 << 20)
    walked = models.model_stage(models.fit(pipe, train))
    assert kept._java_obj.getCacheNodeIds() and not walked._java_obj.getCacheNodeIds()
    assert kept.toDebugString.split("\n", 1)[1] == walked.toDebugString.split("\n", 1)[1]
    assert models.model_stage_spec(pipe).getCacheNodeIds()
    # a shallow forest walks anyway, and a regression has no such choice
    assert models.node_params(models.forest_regressor(Q.FEATURES, Q.LABEL, max_depth=5), train) == {}
    assert models.node_params(models.logistic_regression(Q.FEATURES, Q.LABEL), train) == {}


def test_memory_of_a_forests_rows_grows_with_rows_and_trees():
    assert models.node_ids_fit(1_000_000, 25, 4, 1 << 30) and not models.node_ids_fit(3_000_000, 25, 4, 1 << 30)
    assert not models.node_ids_fit(1_000_000, 100, 4, 1 << 30) and models.node_ids_fit(0, 25, 4, 0)
