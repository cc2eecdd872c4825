import numpy as np
import pytest
from helpers import months, series
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tidetable.operators import backtest, regression, trees
from tidetable.plans import modelling


def test_fold_arguments():
    for args in ((0, 1, None), (5, 0, None), (5, 1, 0), (5, 1, 5)):
        with pytest.raises(ValueError):
            backtest.check_fold_arguments(*args)
    backtest.check_fold_arguments(5, 1, 6)


def test_folds_and_short_series(spark):
    df = series(spark, [float(i) for i in range(10)]).unionByName(series(spark, [1.0], key="short"))
    folds = backtest.fold_table(df, initial_window=6, horizon=2).orderBy("fold").collect()
    assert [(r["fold"], r["train_end"]) for r in folds] == [(1, 6), (2, 7), (3, 8)]
    counts = {r["series_key"]: r["is_excluded"] for r in backtest.row_counts(df, minimum=9).collect()}
    assert counts == {"a": False, "short": True}


def test_naive_backtest_matches_a_loop(spark):
    rng = np.random.default_rng(5)
    y = [float(v) for v in rng.normal(size=30)]
    out = backtest.naive_backtest(series(spark, y), "x", initial_window=14, horizon=3).collect()
    got = {(r["fold"], r["step"], r["model"]): (r["actual"], r["prediction"]) for r in out}
    want = {}
    for fold, end in enumerate(range(14, 30 - 3 + 1), start=1):
        for step in range(1, 4):
            want[fold, step, "naive"] = (y[end + step - 1], y[end - 1])
            want[fold, step, "seasonal_naive"] = (y[end + step - 1], y[end - 12])
    assert got == want


def _loop_forecast(y, x, start, t):
    rows, target = [], []
    for i in range(13, t):
        rows.append([1.0, y[i - 1], y[i - 12], y[i - 13], *x[i]])
        target.append(y[i])
    beta = np.linalg.lstsq(np.array(rows), np.array(target), rcond=None)[0]
    return float(np.array([1.0, y[t - 1], y[t - 12], y[t - 13], *x[t]]) @ beta)


def _driven(spark, n=60, seed=6):
    rng = np.random.default_rng(seed)
    d = rng.normal(size=n)
    y = list(rng.normal(size=13) + 10)
    for i in range(13, n):
        y.append(2 + 0.5 * y[i - 1] + 0.3 * y[i - 12] + 0.8 * d[i] + 0.1 * rng.normal())
    df = series(spark, [float(v) for v in y], name="y").join(series(spark, [float(v) for v in d], name="d"), ["series_key", "month"])
    return df, y, d.reshape(-1, 1)


def test_regression_backtest_matches_a_refit_per_fold(spark):
    df, y, x = _driven(spark)
    spec = regression.RegressionSpec("y", ("d",), initial_window=40)
    rows = regression.one_step_backtest(df, spec).orderBy("month").collect()
    assert len(rows) == 20
    for i, r in enumerate(rows):
        assert r["prediction"] == pytest.approx(_loop_forecast(y, x, 40, 40 + i), rel=1e-5)
        assert not r["is_fallback"]
    assert all(r["lower_bound"] <= r["prediction"] <= r["upper_bound"] for r in rows[2:])


def test_regression_does_not_look_ahead(spark):
    df, _, _ = _driven(spark)
    spec = regression.RegressionSpec("y", ("d",), initial_window=40)
    cut = months("2020-01", 60)[50]
    disturbed = df.withColumns({c: F.when(F.col("month") > F.lit(cut), F.col(c) * 7).otherwise(F.col(c)) for c in ("y", "d")})
    past = [
        [r["prediction"] for r in regression.one_step_backtest(f, spec).filter(F.col("month") <= F.lit(cut)).orderBy("month").collect()]
        for f in (df, disturbed)
    ]
    assert past[0] == past[1]


def test_regression_of_a_constant_and_the_range_guard(spark):
    flat = series(spark, [4.0] * 50)
    out = regression.one_step_backtest(flat, regression.RegressionSpec("x", initial_window=30)).collect()
    assert all(r["prediction"] == pytest.approx(4.0, abs=1e-6) for r in out)
    guarded = regression.one_step_backtest(flat, regression.RegressionSpec("x", initial_window=30, high=3.0)).collect()
    assert all(r["is_fallback"] and r["prediction"] == 4.0 and r["lower_bound"] is None for r in guarded)


def test_forecast_repeats_an_exact_recursion(spark):
    y = [10.0 + i % 12 for i in range(13)]
    for i in range(13, 60):
        y.append(1.0 + 0.4 * y[i - 1] + 0.5 * y[i - 12])
    history = series(spark, y, name="y")
    future = spark.createDataFrame([("a", m) for m in months("2025-01", 4)], "series_key string, month date")
    out = regression.forecast(history, future, regression.RegressionSpec("y", initial_window=40)).orderBy("month").collect()
    for i in range(60, 64):
        y.append(1.0 + 0.4 * y[i - 1] + 0.5 * y[i - 12])
    assert [r["prediction"] for r in out] == pytest.approx(y[60:], rel=1e-3)
    assert all(r["lower_bound"] <= r["prediction"] <= r["upper_bound"] for r in out)


def test_a_short_series_is_forecast_by_its_last_value(spark):
    history = series(spark, [1.0, 2.0, 3.0], name="y").unionByName(series(spark, [1.0 + i % 12 + 0.01 * i for i in range(60)], key="b", name="y"))
    future = spark.createDataFrame([(k, m) for k in "abc" for m in months("2025-01", 2)], "series_key string, month date")
    out = regression.forecast(history, future, regression.RegressionSpec("y", initial_window=40)).collect()
    got = {k: [(r["is_fallback"], r["prediction"]) for r in out if r["series_key"] == k] for k in "abc"}
    assert got["a"] == [(True, 3.0)] * 2 and got["c"] == [(True, None)] * 2
    assert [f for f, _ in got["b"]] == [False, False]


def test_log_target_needs_positive_values(spark):
    df = series(spark, [float(np.exp(0.01 * i)) for i in range(50)] + [-1.0])
    out = regression.one_step_backtest(df, regression.RegressionSpec("x", initial_window=30, log_target=True)).orderBy("month").collect()
    assert out[5]["prediction"] == pytest.approx(out[5]["actual"], rel=1e-3)


def test_imputed_drivers(spark):
    df = series(spark, [float(i) for i in range(14)]).withColumn("c", F.col("x"))
    rows = backtest.imputation_gap(backtest.impute_drivers(df, ["x"], ["c"]), ["x", "c"]).orderBy("month").collect()
    assert rows[13]["x_imputed"] == 1.0 and rows[13]["c_imputed"] == 12.0
    assert rows[13]["x_diff"] == -12.0 and rows[0]["c_imputed"] is None


def test_common_periods_restrict_every_model(spark):
    rows = [("a", f, 1, m, 1.0, "p", 1.0) for f, m in enumerate(months("2020-01", 3), 1)]
    rows += [("a", f, 1, m, 1.0, "q", 2.0) for f, m in enumerate(months("2020-01", 2), 1)]
    df = spark.createDataFrame(rows, "series_key string, fold int, step int, month date, actual double, model string, prediction double")
    out = {r["model"]: (r["n_obs"], r["n_folds"]) for r in backtest.compare_models(df, common_only=True).collect()}
    assert out == {"p": (2, 2), "q": (2, 2)}
    wide = backtest.predictions_wide(df, ["p", "q"]).orderBy("month").collect()
    assert [r["q"] for r in wide] == [2.0, 2.0, None]


def test_boosted_backtest_small(spark):
    rng = np.random.default_rng(7)
    df = None
    for k in "abc":
        part = series(spark, [float(v) for v in 10 + np.sin(np.arange(40)) + 0.1 * rng.normal(size=40)], key=k, name="price")
        df = part if df is None else df.unionByName(part)
    df = trees.add_calendar_and_target_lags(df, "price").withColumn("d", F.lit(1.0)).withColumn("d_lag_1", F.lit(2.0))
    sets = trees.feature_sets(df, "price", ["d"], ["d_lag_1"])
    assert [s.name for s in sets] == ["calendar_and_target", "with_drivers", "lagged_drivers", "selected"]
    assert sets[1].features[-1] == "d" and sets[2].features[0] == "d_lag_1"
    quick = GBTRegressor(featuresCol="_features", labelCol="_label", predictionCol="_fit", maxIter=3, maxDepth=2, seed=1)
    predictions, importance = trees.boosted_backtest(df, "price", sets[0], folds=2, model=quick)
    rows = predictions.collect()
    assert len(rows) == 6 and {r["fold"] for r in rows} == {1, 2}
    assert all(r["prediction"] == pytest.approx(r["actual"], rel=0.2) for r in rows)
    sums = importance.groupBy("fold").agg(F.sum("importance").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in sums)
    assert trees.regressor().getMaxIter() == 200


def test_final_comparison(spark):
    df, _, _ = _driven(spark)
    spec = regression.RegressionSpec("y", initial_window=40)
    out = modelling.final_comparison(df.select("series_key", "month", "y"), "y", {"seasonal_regression": spec}, initial_window=40)
    rows = {r["model"]: r for r in out.collect()}
    assert set(rows) == {"naive", "seasonal_naive", "seasonal_regression"}
    assert {r["n_obs"] for r in rows.values()} == {20}
