"""Forests on the cells of their bins against the rows that the cells stand for."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabml import queries as Q
from tabml.operators import metrics, split
from tabml.plans import cells, models, search, trees, tuning
from tabml.session import scratch_path
from tabml.sources import models as model_io

from .conftest import SF01


@pytest.fixture(scope="module")
def data(spark):
    return split.hash_split(Q.labelled(spark, SF01), "l_orderkey")


@pytest.fixture
def many(monkeypatch):
    """All tables count as large, and their cells as few."""
    monkeypatch.setattr(cells, "FROM_ROWS", 1)
    monkeypatch.setattr(cells, "EACH", 0)


def _f1(df, pred):
    return metrics.weighted_f1(df, Q.LABEL, pred, digits=None).first()["weighted_f1"]


def test_a_bin_is_a_value_or_a_quantile(spark):
    rows = spark.range(5000, numPartitions=7).select(F.array(F.expr("cast(id % 4 as double)"), F.expr("cast(id as double)"), F.lit(7.0)).alias("x"))
    few, many, one = cells.bin_values(rows, 3, 32)
    assert few == [0.0, 1.0, 2.0, 3.0] and one == [7.0]
    assert len(many) == 32 and all(abs(v - (k + 0.5) / 32 * 5000) < 5 for k, v in enumerate(many))
    for odd in (float("inf"), float("nan")):
        assert cells.bin_values(rows.unionByName(spark.createDataFrame([([odd, 1.0, 2.0],)], "x array<double>")), 3, 32) is None


def test_cells_do_not_grow_with_the_rows_and_draw_what_their_rows_would(spark):
    rows = spark.range(3000).select(F.array(F.expr("cast(id % 5 as double)"), F.expr("cast(id % 7 as double)")).alias("x"), F.expr("cast(id % 5 > 2 as double)").alias("y"))
    for times in (1, 40):
        with cells.cells_of(rows.crossJoin(spark.range(times)).drop("id"), 2, 32) as found:
            assert found.count == 35 and found.table.agg(F.sum("n")).first()[0] == 3000 * times
            assert {(tuple(r.x), r.y) for r in found.table.collect()} == {((float(a), float(b)), float(a > 2)) for a in range(5) for b in range(7)}
            w = [r.w for r in found.drawn(F.col("n"), 200, 3).collect()]
            flat = [v for row in w for v in row]
            mean = sum(flat) / len(flat)
            # Poisson: the mean is the rows of a cell, and so is the variance
            assert abs(mean - 3000 * times / 35) < 0.02 * mean and abs(sum((v - mean) ** 2 for v in flat) / len(flat) / mean - 1) < 0.1
            assert w[0][:5] != w[1][:5] and found.drawn(F.col("n"), 200, 3).first().w == w[0]
    with cells.cells_of(spark.range(100).select(F.array(F.col("id").cast("double")).alias("x"), F.lit(1.0).alias("y")), 1, 32) as found:
        assert found is None  # 32 cells of 100 rows


def test_a_forest_of_cells_is_a_forest(spark, data, many):
    train, test = data
    spec = models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=10, max_depth=8)
    fitted = models.fit(spec, train, by_cells=True)
    forest = models.model_stage(fitted)
    assert forest._java_obj.getNumTrees() == forest.getNumTrees == len(forest.trees) == 10 and forest.getMaxDepth() == 8 and max(t.depth for t in forest.trees) == 8
    scored = fitted.transform(test)
    assert _f1(scored, models.ORDINAL) > 0.9
    again = model_io.load_pipeline(model_io.save_pipeline(fitted, scratch_path(spark, "cells-test"))).transform(test)
    assert sorted(r[0] for r in again.select("prediction").collect()) == sorted(r[0] for r in scored.select("prediction").collect())
    # nodes have the rows that were drawn, some as many as there are
    nodes = trees.model_nodes(spark, fitted)
    n = train.count()
    roots = [r.rows for r in nodes.where("node = 0").collect()]
    assert len(set(roots)) > 1 and all(abs(r - n) < 6 * math.sqrt(n) for r in roots)
    # the same rows in other places give the same trees
    other = models.model_stage(models.fit(spec, train.repartition(3), by_cells=True))
    assert other.toDebugString.split("\n", 1)[1] == forest.toDebugString.split("\n", 1)[1]


def test_a_classifier_of_cells_knows_all_classes(spark, data, many):
    train, test = data
    for index in (False, True):
        spec = models.forest_classifier(Q.FEATURES, Q.LABEL, num_trees=6, max_depth=9, index_label=index)
        fitted = models.fit(spec, train, by_cells=True)
        forest = models.model_stage(fitted)
        assert forest.numClasses == (6 if index else 9)
        scored = fitted.transform(test)
        share = scored.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, v: a + v).alias("s")).agg(F.min("s"), F.max("s")).first()
        assert share == pytest.approx((1.0, 1.0))
        assert metrics.weighted_f1(scored, "label" if index else Q.LABEL, "prediction", digits=None).first()["weighted_f1"] > 0.8


def test_held_out_cells_have_the_metrics_of_their_rows(spark, data):
    train, _ = data
    spec = models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=4, max_depth=7)
    stage = models.model_stage_spec(spec)
    rows = split.with_folds(train, "l_orderkey", 3, "_fold")
    _, ready, features, _ = cells.prepared(spec, stage, Q.LABEL, rows, "_fold")
    points = [{"numTrees": n, "maxDepth": d} for n in (2, 4) for d in (3, 7)]
    each, cells.EACH = cells.EACH, 0
    try:
        with cells.cells_of(ready, features, 32, "_fold") as found, cells.threads(rows) as pool:
            assert found.folds == [0, 1, 2]
            assert found.table.agg(F.sum(found.train(1))).first()[0] == rows.where("_fold != 1").count()
            nodes = trees.nodes_of(spark, cells.grow(stage, found, found.train(1), 0, pool))
            for metric in ("rmse", "f1"):
                of_cells = search._fold_metrics(found.held(1), nodes, points, metric)
                assert of_cells == pytest.approx(search._fold_metrics(ready.where("_fold = 1").select("y", "x"), nodes, points, metric), abs=1e-9)
    finally:
        cells.EACH = each


@pytest.mark.parametrize("metric", ["f1", "rmse"])
def test_searches_by_cells_find_what_searches_by_rows_find(spark, data, many, metric, monkeypatch):
    train, test = data
    spec, grid = models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=3, max_depth=3), {"numTrees": [2, 6], "maxDepth": [2, 8]}
    evaluator = tuning.f1_evaluator(Q.LABEL) if metric == "f1" else tuning.rmse_evaluator(Q.LABEL)
    points = tuning.param_grid(models.model_stage_spec(spec), grid)
    by = {}
    for kind, rows in (("cells", 1), ("rows", 1 << 40)):
        monkeypatch.setattr(cells, "FROM_ROWS", rows)
        found = search.search_forest(spec, grid, train, metric=metric, folds=3, fold_keys="l_orderkey", keys=["l_orderkey"])
        cvm = tuning.cross_validate(spec, points, evaluator, split.with_folds(train, "l_orderkey", 3), folds=3, keys=["l_orderkey"])
        assert found.best["maxDepth"] == 8 and found.fits == 4 and cvm.getEstimatorParamMaps() == points
        assert models.model_stage(cvm.bestModel).getMaxDepth() == 8 and models.ORDINAL in cvm.bestModel.transform(test).columns
        by[kind] = (found.averages, cvm.avgMetrics)
    # other draws, so near and not equal; two trees may differ much
    for a, b in zip(by["cells"], by["rows"]):
        assert a[2:] == pytest.approx(b[2:], abs=0.12)
