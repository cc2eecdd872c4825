import math

import numpy as np
import pytest
from helpers import column, months, series
from pyspark.sql import functions as F

from tidetable.operators import stationarity, stats


def _predictions(spark, pairs):
    rows = [("a", "m", d, a, p) for d, (a, p) in zip(months("2020-01", len(pairs)), pairs)]
    return spark.createDataFrame(rows, "series_key string, model string, month date, actual double, prediction double")


def test_scores_skip_zero_actuals_and_missing_pairs(spark):
    df = _predictions(spark, [(0.0, 1.0), (None, 5.0), (2.0, 1.0), (2.0, 1.0), (4.0, None), (1.0, 3.0)])
    r = stats.scores(df, ["series_key", "model"]).first()
    assert r["n_obs"] == 4
    assert r["mae"] == pytest.approx((1 + 1 + 1 + 2) / 4)
    assert r["rmse"] == pytest.approx(math.sqrt((1 + 1 + 1 + 4) / 4))
    assert r["mape"] == pytest.approx(100 * (0.5 + 0.5 + 2.0) / 3)
    # changes over the complete pairs: (2, 0), (0, 0), (-1, 2); equal signs include 0 and 0
    assert r["directional_accuracy"] == pytest.approx(1 / 3)


def test_scores_of_one_row(spark):
    r = stats.scores(_predictions(spark, [(0.0, 1.0)]), ["series_key", "model"]).first()
    assert r["directional_accuracy"] is None and r["mape"] is None and r["n_obs"] == 1


def test_fit_quality_and_bands(spark):
    pairs = [(1.0, 1.5), (2.0, 2.0), (3.0, 2.0), (5.0, 5.5)]
    df = _predictions(spark, pairs)
    r = stats.fit_quality(df, ["series_key", "model"]).first()
    a, p = np.array(pairs).T
    assert r["r2"] == pytest.approx(1 - ((a - p) ** 2).sum() / ((a - a.mean()) ** 2).sum())
    assert r["bias"] == pytest.approx((p - a).mean())
    band = stats.residual_band(df, ["series_key", "model"]).orderBy("month").first()
    assert band["upper_bound"] - band["prediction"] == pytest.approx(1.96 * (a - p).std(ddof=1))


def test_lag_correlation_matches_numpy_and_constant_gives_zero(spark):
    rng = np.random.default_rng(1)
    y, x = rng.normal(size=30), rng.normal(size=30)
    df = series(spark, [float(v) for v in y], name="y").join(series(spark, [float(v) for v in x]), ["series_key", "month"])
    df = df.withColumn("flat", F.lit(1.0))
    out = {(r["feature"], r["lag"]): r["correlation"] for r in stats.lag_correlation(df, "y", ["x", "flat"], max_lag=3).collect()}
    assert out["x", 2] == pytest.approx(np.corrcoef(y[2:], x[:-2])[0, 1])
    assert out["flat", 1] == 0.0
    lead = {r["lag"]: r["correlation"] for r in stats.lag_correlation(df, "y", ["x"], max_lag=1, direction="lead").collect()}
    assert lead[1] == pytest.approx(np.corrcoef(y[:-1], x[1:])[0, 1])


def test_cross_correlation_uses_whole_sample_moments(spark):
    rng = np.random.default_rng(2)
    y, x = rng.normal(size=25), rng.normal(size=25)
    df = series(spark, [float(v) for v in y], name="y").join(series(spark, [float(v) for v in x]), ["series_key", "month"])
    out = {r["lag"]: r["correlation"] for r in stats.cross_correlation(df, "y", ["x"], max_lag=4).collect()}
    yc, xc = y - y.mean(), x - x.mean()
    for k in range(5):
        assert out[k] == pytest.approx((xc[k:] * yc[: 25 - k]).sum() / (25 * y.std() * x.std()))


def test_partial_autocorrelation_of_an_ar1(spark):
    r = 0.6 ** np.arange(6)
    out = stationarity.partial_from_autocorrelation(r)
    assert out[1] == pytest.approx(0.6) and np.allclose(out[2:], 0)


def test_unit_root_decisions():
    rng = np.random.default_rng(3)
    noise = rng.normal(size=200)
    stationary, _, _ = stationarity.unit_root_statistic(noise)
    walk, _, _ = stationarity.unit_root_statistic(np.cumsum(noise))
    assert stationary < -5 and walk > -2.8
    assert math.isnan(stationarity.unit_root_statistic(np.ones(30))[0])


def test_stationarity_and_its_lag0_form_agree(spark):
    rng = np.random.default_rng(4)
    df = series(spark, [float(v) for v in np.cumsum(rng.normal(size=80))])
    grouped = stationarity.stationarity(df, "x", max_lag=0).first()
    built_in = stats.dickey_fuller_lag0(df, "x").first()
    assert grouped["statistic"] == pytest.approx(built_in["df_statistic"])
    assert grouped["critical_1pct"] < grouped["critical_5pct"] < grouped["critical_10pct"]
    short = stationarity.stationarity(series(spark, [1.0]), "x").first()
    assert short["statistic"] is None and short["is_stationary"] is None


def test_decomposition_recovers_trend_and_season(spark):
    season = [float(v) for v in (3, 1, -2, 0, 2, -4, 1, 1, -1, 0, -3, 2)]
    df = series(spark, [10 + 0.5 * i + season[i % 12] for i in range(48)])
    rows = stats.seasonal_decompose(df, "x").orderBy("month").collect()
    assert rows[5]["trend"] is None and rows[42]["trend"] is None
    assert rows[20]["trend"] == pytest.approx(20.0)
    assert [r["seasonal"] for r in rows[:12]] == pytest.approx(season)
    assert rows[20]["resid"] == pytest.approx(0.0, abs=1e-9)


def test_scaling_with_zero_spread(spark):
    df = series(spark, [2.0, 2.0]).unionByName(series(spark, [1.0, 3.0], key="b"))
    z = stats.apply_scaler(df, stats.fit_scaler(df, ["x"]), ["x"])
    assert column(z, "x_z") == [0.0, 0.0, -1.0, 1.0]
    assert column(stats.min_max(df, ["x"]), "x_norm") == [None, None, 0.0, 1.0]


def test_quality_profile_counts_repeats(spark):
    rows = [("a", None, 1.0), ("a", None, 1.0), ("a", months("2020-01", 1)[0], None), ("a", months("2020-01", 1)[0], 2.0)]
    df = spark.createDataFrame(rows, "series_key string, month date, x double")
    r = stats.quality_profile(df, "series_key", "month", "x").first().asDict()
    assert r == {"series_key": "a", "rows": 4, "missing_date": 2, "missing_target": 1, "duplicate_rows": 1, "duplicate_dates": 2}


def test_histogram_keeps_every_row(spark):
    df = series(spark, [float(i) for i in range(100)]).unionByName(series(spark, [5.0, 5.0], key="flat"))
    out = stats.histogram(df, "x", "series_key", bins=20).collect()
    assert sum(r["n"] for r in out) == 102
    assert {r["bin"] for r in out if r["series_key"] == "a"} == set(range(1, 21))
    assert [(r["bin"], r["n"]) for r in out if r["series_key"] == "flat"] == [(1, 2)]


def test_correlation_matrix_uses_complete_rows(spark):
    df = series(spark, [1.0, 2.0, 3.0, 9.0]).withColumn("y", F.when(F.col("x") < 9, F.col("x") * 2))
    out = {(r["var1"], r["var2"]): r["correlation"] for r in stats.correlation_matrix(df, ["x", "y"], "series_key").collect()}
    assert out["x", "y"] == pytest.approx(1.0) and out["x", "x"] == 1.0 and len(out) == 4
