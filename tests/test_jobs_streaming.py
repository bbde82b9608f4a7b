"""End-to-end jobs on a delimited file and streaming scoring."""

import json

import pytest

from pyspark.sql import functions as F

from tabml import queries as Q
from tabml.jobs import score, train
from tabml.jobs.common import read_input
from tabml.plans import models
from tabml.sources import delimited
from tabml.streaming import score_stream

from .conftest import SF001


def _write_fixture_csv(spark, path):
    df = Q.labelled(spark, SF001).select(*Q.FEATURES, Q.LABEL)
    delimited.write_delimited(df.coalesce(1), path)
    return df.count()


def test_train_then_score_jobs(spark, tmp_path, capsys):
    data = str(tmp_path / "data")
    n = _write_fixture_csv(spark, data)
    args = train.parse_args(["--train_dataset", data, "--save_model_path", str(tmp_path / "m"),
                             "--max_depth", "6", "--num_trees", "5", "--enable_grid_search",
                             "--grid_trees", "3", "--grid_depth", "2,6", "--folds", "2"])
    res = train.run(spark, args)
    assert res["f1"] > 0.8 and res["grid_best"]["f1"] > 0.8
    out = str(tmp_path / "scored")
    sres = score.run(spark, score.parse_args(["--model_path", str(tmp_path / "m" / "pipeline"),
                                              "--new_data", data, "--output", out]))
    assert sres["f1"] > 0.8
    scored = spark.read.parquet(out)
    assert scored.count() == n and models.ORDINAL in scored.columns
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert any(x.get("step") == "score" for x in lines)


def test_lr_job_with_holdout_file(spark, tmp_path):
    data = str(tmp_path / "data")
    _write_fixture_csv(spark, data)
    res = train.run(spark, train.parse_args(["--train_dataset", data, "--test_dataset", data,
                                             "--model", "lr"]))
    assert res["f1"] > 0.6


def test_stream_scoring_matches_batch(spark, tmp_path):
    src = tmp_path / "incoming"
    df = Q.labelled(spark, SF001)
    df.where("l_orderkey % 2 = 0").write.parquet(str(src / "a"))
    df.where("l_orderkey % 2 = 1").write.parquet(str(src / "b"))
    model = models.fit(models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=3, max_depth=4), df)
    q = score_stream(spark, model, str(src / "*"), df.schema, str(tmp_path / "sink"),
                     checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "sink"))
    assert out.count() == df.count()
    batch = model.transform(df).agg(F.sum(models.ORDINAL)).first()[0]
    assert out.agg(F.sum(models.ORDINAL)).first()[0] == batch


def test_stream_restart_neither_skips_nor_repeats(spark, tmp_path):
    src, sink, ckpt = tmp_path / "incoming", str(tmp_path / "sink"), str(tmp_path / "ckpt")
    df = Q.labelled(spark, SF001)
    model = models.fit(models.forest_regressor(Q.FEATURES, Q.LABEL, num_trees=3, max_depth=4), df)
    first, second = df.where("l_orderkey % 2 = 0"), df.where("l_orderkey % 2 = 1")
    first.write.parquet(str(src / "a"))
    score_stream(spark, model, str(src / "*"), df.schema, sink, checkpoint=ckpt).awaitTermination(120)
    assert spark.read.parquet(sink).count() == first.count()
    second.write.parquet(str(src / "b"))  # files arriving after the first run
    score_stream(spark, model, str(src / "*"), df.schema, sink, checkpoint=ckpt).awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.count() == df.count()
    assert out.select(*Q.KEYS, "l_quantity").distinct().count() == df.select(*Q.KEYS, "l_quantity").distinct().count()


def _train_args(path, out, *more):
    return train.parse_args(["--train_dataset", path, "--save_model_path", out, "--num_trees", "3", "--max_depth", "4", "--split_key", "k", *more])


@pytest.fixture(scope="module")
def graded(spark):
    return spark.range(600).selectExpr("cast(id as int) k", "cast(id % 7 as double) a", "cast(id % 11 as int) b", "cast(if(id % 7 > 3, 6, 5) as int) quality")


def test_a_model_of_one_format_scores_the_other(spark, graded, tmp_path):
    delimited.write_delimited(graded, str(tmp_path / "d.csv"))
    graded.write.parquet(str(tmp_path / "d.parquet"))
    train.run(spark, _train_args(str(tmp_path / "d.csv"), str(tmp_path / "m"), "--model", "lr"))
    f1 = [score.run(spark, score.parse_args(["--model_path", str(tmp_path / "m/pipeline"), "--new_data", str(tmp_path / f"d.{x}")]))["f1"] for x in ("csv", "parquet")]
    assert f1[0] == f1[1] > 0.9
    # a column that happens to be called "label" is no matter; labels that the pipeline has never seen are an error
    graded.selectExpr("*", "'other' label").write.parquet(str(tmp_path / "l.parquet"))
    named = score.run(spark, score.parse_args(["--model_path", str(tmp_path / "m/pipeline"), "--new_data", str(tmp_path / "l.parquet")]))
    assert named["f1"] == f1[0]
    graded.withColumn("quality", F.lit("nothing like it")).write.parquet(str(tmp_path / "x.parquet"))
    with pytest.raises(ValueError, match="among the labels"):
        score.run(spark, score.parse_args(["--model_path", str(tmp_path / "m/pipeline"), "--new_data", str(tmp_path / "x.parquet")]))


def test_dotted_names_empty_input_and_missing_values(spark, graded, tmp_path):
    gaps = graded.selectExpr("k", "if(k % 50 = 0, null, a) `l.q`", "b `x``y`", "if(k % 40 = 0, null, quality) quality")
    gaps.write.parquet(str(tmp_path / "d.parquet"))
    with pytest.raises(Exception):
        train.run(spark, _train_args(str(tmp_path / "d.parquet"), str(tmp_path / "m")))
    for missing in ("skip",):
        done = train.run(spark, _train_args(str(tmp_path / "d.parquet"), str(tmp_path / missing), "--missing", missing, "--model", "rf"))
        assert done["f1"] > 0.8 and set(done["features"]) == {"k", "l_q", "x_y"}
    gaps.limit(0).write.parquet(str(tmp_path / "none.parquet"))
    out = score.run(spark, score.parse_args(["--model_path", str(tmp_path / "skip/pipeline"), "--new_data", str(tmp_path / "none.parquet")]))
    assert out == {"f1": None, "accuracy": None}
    with pytest.raises(ValueError, match="distinct"):
        read_input(spark, _written(gaps.selectExpr("`l.q`", "quality as l_q"), tmp_path))


def _written(df, tmp_path):
    df.write.parquet(str(tmp_path / "clash.parquet"))
    return str(tmp_path / "clash.parquet")


def test_defaults_of_the_regression_job():
    args = train.parse_args(["--train_dataset", "x"])
    assert (args.reg, args.elastic_net, args.max_iter, args.max_depth, args.num_trees, args.folds) == (0.01, 1.0, 100, 20, 25, 10)
