"""Profiling and correlation edge cases: nulls, NaN, timestamps, constant
columns, single-row groups."""

import datetime as dt
import math

import numpy as np
import pytest

from tabml.operators import correlation, profile


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [
        (1, 1.0, "a", dt.datetime(2024, 1, 1), 5.0),
        (2, float("nan"), None, dt.datetime(2024, 1, 2), 5.0),
        (None, 3.0, "b", None, 5.0),
        (4, None, "c", dt.datetime(2024, 1, 4), 5.0),
    ]
    return spark.createDataFrame(rows, "i int, x double, s string, t timestamp, k double")


def test_missing_counts_types(mixed):
    got = {r["column"]: r["missing"] for r in profile.missing_counts(mixed).collect()}
    assert got == {"i": 1, "x": 2, "s": 1, "t": 1, "k": 0}


def test_describe_constant_and_nan(mixed):
    got = {r["column"]: r for r in profile.describe_columns(mixed, ["k", "i"]).collect()}
    assert got["k"]["stddev"] == 0.0 and got["k"]["mean"] == 5.0
    assert got["i"]["count"] == 3 and got["i"]["min"] == 1.0 and got["i"]["max"] == 4.0


def test_label_distribution_sorted(spark):
    df = spark.createDataFrame([(5,), (3,), (5,), (8,)], "quality int")
    assert [tuple(r) for r in profile.label_distribution(df, "quality").collect()] == [(3, 1), (5, 2), (8, 1)]


def test_group_mean_ci_single_row_group(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 1.0), (2, 3.0)], "g int, v double")
    got = {r["g"]: r for r in profile.group_mean_ci(df, "g", "v").collect()}
    assert got[1]["ci"] is None and got[1]["n"] == 1
    assert got[2]["mean"] == 2.0
    assert got[2]["ci"] == pytest.approx(round(1.96 * math.sqrt(2.0) / math.sqrt(2), 7))


def test_corr_matches_numpy_and_constant_is_null(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=500)
    b = 0.8 * a + rng.normal(scale=0.3, size=500)
    rows = [(float(x), float(y), float(-x), 1.0) for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, "a double, b double, neg double, const double")
    cols = ["a", "b", "neg", "const"]
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in correlation.corr_pairs(df, cols).collect()}
    assert got[("a", "b")] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-7)
    assert got[("a", "neg")] == pytest.approx(-1.0)
    assert got[("a", "a")] == 1.0
    assert got[("const", "a")] is None and got[("const", "const")] is None
    ml = {(r["feature_a"], r["feature_b"]): r["corr"] for r in correlation.corr_matrix_ml(df, cols).collect()}
    for k, v in got.items():
        if v is not None and "const" not in k:
            assert ml[k] == pytest.approx(v, abs=1e-6)
    high = {r["feature"] for r in correlation.high_corr_features(df, cols, 0.7).collect()}
    assert high == {"b", "neg"}  # each named once, only against an earlier column
    wide = correlation.corr_matrix_wide(correlation.corr_pairs(df, cols), cols)
    assert wide.columns == ["feature", *cols] and wide.count() == 4


def _pandas_agrees(df, pdf, cols):
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in correlation.corr_pairs(df, cols).collect()}
    want = pdf.corr()
    assert len(got) == len(cols) ** 2
    for (a, b), v in got.items():
        w = want.loc[a, b]
        assert (v is None and w != w) or v == pytest.approx(w, abs=1e-6), (a, b, v, w)


def test_pairs_run_over_their_complete_rows_as_in_pandas(spark):
    import pandas as pd

    rng = np.random.default_rng(5)
    p = pd.DataFrame({"a": rng.normal(size=600) + 1e9, "b": rng.normal(size=600), "constant": 7.1})
    p["c"] = p.a * 2 + p.b * 0.1
    p.loc[rng.random(600) < 0.9, "b"] = np.nan
    p.loc[3:580, "c"] = np.nan
    p["d.x"] = np.arange(600) % 3 + 0.0
    p["none"] = np.nan
    p.loc[p.b.isna(), "constant"] = rng.normal(size=int(p.b.isna().sum()))  # constant only beside b
    rows = [tuple(None if x != x else float(x) for x in r) for r in p.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in p.columns)).repartition(5)
    _pandas_agrees(df, p, list(p.columns))


def test_two_complete_rows_decide(spark):
    rows = [(1.0, 100.0)] + [(float(i), None) for i in range(2, 7)] + [(9.0, 300.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert {r["corr"] for r in correlation.corr_pairs(df, ["a", "b"]).collect()} == {1.0}
    nan = spark.createDataFrame([(a, float("nan") if b is None else b) for a, b in rows], "a double, b double")
    assert {r["corr"] for r in correlation.corr_pairs(nan, ["a", "b"]).collect()} == {1.0}
    none = spark.createDataFrame([], "a double, b double")
    for corr in (correlation.corr_pairs, correlation.corr_matrix_ml):
        assert [r["corr"] for r in corr(none, ["a", "b"]).collect()] == [None] * 4


def test_many_columns_take_the_same_route(spark):
    import pandas as pd

    rng = np.random.default_rng(6)
    base = rng.normal(size=(300, 80))
    base[rng.random(base.shape) < 0.2] = np.nan
    p = pd.DataFrame(base, columns=[f"c{i}" for i in range(80)])
    rows = [tuple(None if x != x else float(x) for x in r) for r in base]
    _pandas_agrees(spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(80))), p, list(p.columns))


def test_ml_route_uses_rows_complete_in_all_columns(spark):
    df = spark.createDataFrame([(float(i), float(i * i), None if i % 3 else float(-i), 4.0) for i in range(30)],
                               "a double, b double, c double, k double")
    complete = df.na.drop()
    ml = {(r["feature_a"], r["feature_b"]): r["corr"] for r in correlation.corr_matrix_ml(df, df.columns).collect()}
    same = {(r["feature_a"], r["feature_b"]): r["corr"] for r in correlation.corr_pairs(complete, df.columns).collect()}
    assert ml.keys() == same.keys()
    for key, v in same.items():
        assert (ml[key] is None) == (v is None) and (v is None or ml[key] == pytest.approx(v, abs=1e-6)), key


def test_describe_all_types_and_many_columns(spark):
    df = spark.sql("select cast(id as int) i, id * 0.5D x, if(id % 2 = 0, concat('t', id), null) `a text`, date '2024-01-01' d, id % 3 = 0 b from range(10)")
    got = {r["column"]: tuple(r)[1:] for r in profile.describe_all(df).collect()}
    assert got["i"][:2] == (10, 4.5) and got["i"][3:] == ("0.0", "9.0")
    assert got["a text"] == (5, None, None, "t0", "t8") and got["d"] == (10, None, None, "2024-01-01", "2024-01-01")
    assert got["b"] == (10, None, None, "false", "true")
    empty = {r["column"]: tuple(r)[1:] for r in profile.describe_all(df.limit(0)).collect()}
    assert empty["x"] == (0, None, None, None, None) and empty["a text"] == (0, None, None, None, None)
    wide = spark.range(50).selectExpr(*[f"id * {i} as c{i}" for i in range(100)])
    assert {r["column"]: r["max"] for r in profile.describe_columns(wide, wide.columns).collect()} == {f"c{i}": 49.0 * i for i in range(100)}



def _corr_table(df, cols):
    got = {(r.feature_a, r.feature_b): r["corr"] for r in correlation.corr_pairs(df, cols, digits=None).collect()}
    return [[float("nan") if got[a, b] is None else got[a, b] for b in cols] for a in cols]


def test_correlation_with_infinities_as_pandas(spark):
    import numpy as np
    import pandas as pd
    inf, nan = float("inf"), float("nan")
    small = pd.DataFrame({"a": [1.0, 2, 3, 4, inf], "b": [1.0, 2, 5, 4, nan], "c": [2.0, 1, -inf, 3, 9]})
    rng = np.random.default_rng(3)
    big = pd.DataFrame(rng.normal(size=(3000, 6)) * [1, 1e-6, 1e9, 1, 1, 1] + [0, 5, 1e12, 1e6, 0, 0], columns=list("abcdef"))
    big["e"] = big["a"] * 2 + big["b"]
    big["f"] = 7.5
    for c, bad in (("a", inf), ("b", -inf), ("c", nan), ("d", inf)):
        big.loc[rng.integers(0, 3000, 400), c] = bad
    for p in (small, big):
        want = p.corr().to_numpy()
        df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(p.itertuples(index=False))],
                                   ", ".join(f"{c} double" for c in p.columns)).repartition(7)
        got = np.array(_corr_table(df, list(p.columns)))
        off = ~np.eye(len(want), dtype=bool)
        assert np.allclose(got[off], want[off], atol=1e-9, equal_nan=True)


def test_pair_moments_of_parts_merge_to_those_of_the_whole(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(correlation, "FAN_IN", 3)
    rng = np.random.default_rng(5)
    rows = [(float(x), float(x * 3 + y), None if x > 1 else float(y)) for x, y in rng.normal(size=(500, 2)) + 1e5]
    cols = ["a", "b", "c"]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    whole = correlation.corr_of_moments(correlation.pair_moments(df.repartition(2), cols), cols).collect()
    parts = [correlation.pair_moments(spark.createDataFrame(rows[i::4], df.schema).repartition(5), cols) for i in range(4)]
    states = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    assert states.count() >= 48
    assert sorted(map(tuple, correlation.corr_of_moments(states, cols).collect()), key=str) == sorted(map(tuple, whole), key=str)


def test_correlation_reads_its_input_once(spark, tmp_path):
    spark.range(50).selectExpr("cast(id as double) a", "cast(id * id as double) b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = correlation.corr_pairs(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
