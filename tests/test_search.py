"""One-fit-per-fold forest search against plain walks and direct fits."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabml import queries as Q
from tabml.operators import metrics, split
from tabml.plans import models, search, trees, tuning

from .conftest import SF001

GRID = {"numTrees": [2, 5], "maxDepth": [0, 2, 6]}


@pytest.fixture(scope="module")
def data(spark):
    return Q.labelled(spark, SF001)


def pipe(trees=3):
    return models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=trees, max_depth=3)


def test_points_are_parts_of_the_forest(spark, data):
    """Every point's RMSE and F1 by walking each tree in plain Python, cut at the depth."""
    m = models.fit(models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=5, max_depth=6), data.where("l_quantity < 45"))
    held = m.transform(data.where("l_orderkey % 9 = 0")).select(F.monotonically_increasing_id().alias("id"), F.col(Q.LABEL).cast("double").alias("y"), vector_to_array("normalizedFeatures").alias("x"), "prediction")
    held = held.cache()
    nodes = trees.model_nodes(spark, m)
    at = {(r.tree, r.node): r for r in nodes.collect()}

    def reached(x, tree, depth):
        n = at[tree, 0]
        for _ in range(depth):
            if n.left is None:
                break
            n = at[tree, n.left if x[n.feature] <= n.threshold else n.right]
        return n.prediction

    rows = held.collect()
    points = [{"numTrees": n, "maxDepth": d} for n in GRID["numTrees"] for d in GRID["maxDepth"]]
    want = {"rmse": [], "f1": []}
    for p in points:
        guess = [sum(reached(r.x, t, p["maxDepth"]) for t in range(p["numTrees"])) / p["numTrees"] for r in rows]
        want["rmse"].append(math.sqrt(sum((g - r.y) ** 2 for g, r in zip(guess, rows)) / len(rows)))
        judged = spark.createDataFrame([(r.y, float(math.floor(g + 0.5))) for g, r in zip(guess, rows)], "label double, prediction double")
        want["f1"].append(metrics.metric_values(judged, "label", "prediction")["f1"])
    assert search._fold_metrics(held.drop("prediction"), nodes, points, "rmse") == pytest.approx(want["rmse"])
    assert search._fold_metrics(held.drop("prediction"), nodes, points, "f1") == pytest.approx(want["f1"], abs=1e-6)
    # the whole forest is the last point
    assert want["rmse"][-1] == pytest.approx(held.select(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0])


def test_search_keeps_the_best_point(spark, data):
    train = data.unionByName(data.limit(3).withColumn(Q.LABEL, F.lit(None).cast("int")))
    for metric, better in (("f1", max), ("rmse", min)):
        found = search.search_forest(pipe(), GRID, train, metric=metric, folds=3, fold_keys="l_orderkey", keys=["l_orderkey"])
        assert found.best == found.points[found.averages.index(better(found.averages))] == {"numTrees": found.best["numTrees"], "maxDepth": 6}
        forest = models.model_stage(found.best_model)
        assert (forest.getNumTrees, forest.getMaxDepth()) == (found.best["numTrees"], 6) and found.fits == 4
        assert [len(m) for m in found.metrics] == [3] * 6
        assert models.ORDINAL in found.best_model.transform(data).columns
        table = found.table(spark).collect()
        assert sum(r.best for r in table) == 1 and table[0].params == "maxDepth=0, numTrees=2"


def test_held_out_rows_do_not_reach_their_fit(spark, data):
    """A label that can only be known from the row itself: its held-out error stays that of a guess."""
    noise = data.withColumn(Q.LABEL, F.expr("cast(pmod(xxhash64(l_orderkey, l_linenumber, l_extendedprice), 6) as int) + 3"))
    found = search.search_forest(pipe(), {"numTrees": [5], "maxDepth": [12]}, noise, metric="rmse", folds=3, fold_keys="l_orderkey")
    spread = noise.select(F.stddev_pop(Q.LABEL)).first()[0]
    assert found.averages[0] > 0.95 * spread
    seen = models.fit(models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=5, max_depth=12), noise).transform(noise)
    assert seen.select(F.sqrt(F.avg((F.col("prediction") - F.col(Q.LABEL)) ** 2))).first()[0] < 0.9 * spread


def test_what_can_be_searched(data):
    with pytest.raises(ValueError, match="f1 or rmse"):
        search.search_forest(pipe(), GRID, data, metric="accuracy", fold_keys="l_orderkey")
    with pytest.raises(ValueError, match="numTrees and maxDepth"):
        search.search_forest(pipe(), {"numTrees": [1]}, data, fold_keys="l_orderkey")
    with pytest.raises(ValueError, match="regression forests"):
        search.search_forest(models.forest_classifier(Q.FEATURES, Q.LABEL), GRID, data, fold_keys="l_orderkey")


def test_deep_points_keep_the_nodes_of_their_rows(spark, data):
    """How a fit finds a row's node goes by the depth of the point, not of the spec that is searched; the trees are the same."""
    shallow, deep = {"numTrees": [2], "maxDepth": [2]}, {"numTrees": [2], "maxDepth": [models.DEEP + 2]}
    spec = models.model_stage_spec(pipe())
    assert not spec.getOrDefault("cacheNodeIds")
    found = {n: search.search_forest(pipe(), g, data, metric="rmse", folds=2, fold_keys="l_orderkey", keys=["l_orderkey"]) for n, g in (("shallow", shallow), ("deep", deep))}
    assert not models.model_stage(found["shallow"].best_model)._java_obj.getCacheNodeIds() and models.model_stage(found["deep"].best_model)._java_obj.getCacheNodeIds()
    searched = pipe()
    grid = tuning.param_grid(models.model_stage_spec(searched), deep)
    cvm = tuning.cross_validate(searched, grid, tuning.rmse_evaluator(Q.LABEL), split.with_folds(data, "l_orderkey", 2), folds=2, keys=["l_orderkey"])
    assert models.model_stage(cvm.bestModel)._java_obj.getCacheNodeIds()
    assert cvm.getEstimatorParamMaps() == grid and tuning.cv_table(spark, cvm).first().params == f"maxDepth={models.DEEP + 2}, numTrees=2"
    walked = models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=2, max_depth=models.DEEP + 2)
    models.model_stage_spec(walked).setCacheNodeIds(False)
    m = models.fit(walked, data, keys=["l_orderkey"])
    nodes = [trees.model_nodes(spark, x).drop("stats", "gain").orderBy("tree", "node").collect() for x in (m, found["deep"].best_model)]
    assert nodes[0] == nodes[1]


def test_walk_of_arrays_is_that_of_the_node_table(spark):
    """Splits by threshold and by categories, NaN, leaves above the cut, a first tree that is a root alone."""
    nodes = spark.createDataFrame([
        (1, 0, 1, 4, 0, 0.5, None, 1.0), (1, 1, 2, 3, 1, None, [0.0, 2.0], 2.0), (1, 2, None, None, None, None, None, 3.0),
        (1, 3, None, None, None, None, None, 4.0), (1, 4, None, None, None, None, None, 5.0), (0, 0, None, None, None, None, None, 10.0),
    ], "tree int, node int, left int, right int, feature int, threshold double, categories array<double>, prediction double")
    nodes = nodes.withColumn("stats", F.lit(None).cast("array<double>")).repartition(3)
    xs = [[0.1, 0.0], [0.5, 1.0], [0.2, 2.0], [0.6, 0.0], [math.nan, 1.0]]
    held = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, x array<double>").repartition(2)
    with trees.depth_predictions(held, nodes, [3, 0, 1], [2, 1]) as walked:
        assert walked.columns == ["id", "p"]
        got = {r.id: r.p for r in walked.collect()}
    deep, shallow = [3.0, 4.0, 3.0, 5.0, 5.0], [2.0, 2.0, 2.0, 5.0, 5.0]
    assert got == {i: [10.0, 5.5, 10.0, (10 + shallow[i]) / 2, 10.0, (10 + deep[i]) / 2] for i in range(len(xs))}
    rows = held.select("id", "x", F.explode(F.array(F.lit(0), F.lit(1))).alias("tree"))
    joined = trees.walk(rows, nodes, [1, 3]).groupBy("id").agg(F.avg("at_1.prediction").alias("a"), F.avg("at_3.prediction").alias("b")).collect()
    assert {r.id: (r.a, r.b) for r in joined} == {i: (p[3], p[5]) for i, p in got.items()}


def test_metrics_need_no_row_per_tree(spark, data):
    """Held-out rows walk down all trees where they are: no id, no join, one shuffle of the points' sums."""
    m = models.fit(pipe(2), data)
    held = m.transform(data.limit(50)).select(F.col(Q.LABEL).cast("double").alias("y"), vector_to_array("normalizedFeatures").alias("x"))
    nodes = trees.model_nodes(spark, m)
    with trees.depth_predictions(held, nodes, [3], [2]) as walked:
        plan = walked._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning" not in plan
    assert len(search._fold_metrics(held, nodes, [{"numTrees": 2, "maxDepth": 3}], "rmse")) == 1


@pytest.mark.parametrize("metric", ["f1", "rmse"])
def test_depths_share_a_fit_and_keep_their_metrics(spark, data, metric, monkeypatch):
    """Each point's metrics are those of Spark's own cross validation, which fits every point on every fold."""
    from pyspark.ml.regression import RandomForestRegressor

    evaluator = tuning.f1_evaluator(Q.LABEL) if metric == "f1" else tuning.rmse_evaluator(Q.LABEL)
    rows, spec = split.with_folds(data, "l_orderkey", 2), pipe()
    grid = tuning.param_grid(models.model_stage_spec(spec), {"numTrees": [2, 4], "maxDepth": [2, 12, 5]})
    fits, real = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, *a: fits.append(self.getMaxDepth()) or real(self, *a))
    found = tuning.cross_validate(spec, grid, evaluator, rows, folds=2, keys=["l_orderkey"])
    assert sorted(fits) == [12] * 5
    monkeypatch.setattr(tuning, "_by_depth", lambda stage, grid: [[i] for i in range(len(grid))])
    plain = tuning.cross_validate(spec, grid, evaluator, rows, folds=2, keys=["l_orderkey"])
    assert len(fits) == 5 + 13
    assert found.avgMetrics == pytest.approx(plain.avgMetrics, abs=1e-12) and found.stdMetrics == pytest.approx(plain.stdMetrics, abs=1e-12)
    assert found.getEstimatorParamMaps() == plain.getEstimatorParamMaps() == grid
    a, b = (trees.model_nodes(spark, m.bestModel).drop("stats", "gain").orderBy("tree", "node").collect() for m in (found, plain))
    assert a == b
