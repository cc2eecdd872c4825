"""Trees over all folds, bounds that grow, the unit-root test and partial autocorrelation against plain forms."""

import numpy as np
import pytest
from helpers import months, series
from pyspark.sql import functions as F

from tidetable.operators import fold_trees, regression, stationarity, stats, trees
from tidetable.operators.fold_trees import Boosting
from tidetable.plans import modelling


def _loop_tree(x, slope, rows, columns, depth, ridge):
    """One tree by plain recursion: nested (column, border, left, right) or a leaf value; and its gains."""
    gains = []

    def grow(own, level):
        best = None
        total = slope[own].sum()
        if level < depth:
            for c in columns:
                values = np.unique(x[own, c])
                for low, high in zip(values, values[1:]):
                    left = own[x[own, c] <= low]
                    s, n = slope[left].sum(), len(left)
                    gain = s**2 / (n + ridge) + (total - s) ** 2 / (len(own) - n + ridge) - total**2 / (len(own) + ridge)
                    if gain > 1e-12 and (best is None or gain > best[0] * (1 + 1e-9)):
                        best = (gain, c, (low + high) / 2)
        if best is None:
            return total / (len(own) + ridge)
        gains.append(best[:2])
        side = x[own, best[1]] > best[2]
        return (best[1], best[2], grow(own[~side], level + 1), grow(own[side], level + 1))

    return grow(rows, 0), gains


def _walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] > tree[1] else tree[2]
    return tree


def _loop_fit(x, y, test, how):
    share, picks = fold_trees._drawn(len(y), x.shape[1], how)
    fit, ahead = np.full(len(y), y.sum() / len(y)), y.sum() / len(y)
    total, count = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(how.trees):
        rows = np.flatnonzero(share[t])
        tree, gains = _loop_tree(x, y - fit, rows, picks[t], how.depth, how.ridge)
        fit = fit + how.rate * np.array([_walk(tree, r) for r in x])
        ahead += how.rate * _walk(tree, test)
        for gain, c in gains:
            total[c] += gain
            count[c] += 1
    mean = total / np.maximum(count, 1)
    return ahead, mean / mean.sum()


def test_folds_together_equal_separate_plain_fits():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=46), rng.integers(0, 4, 46), rng.normal(size=46)]).astype(float)
    y = np.sin(2 * x[:, 0]) + 0.5 * x[:, 1] + 0.1 * rng.normal(size=46)
    how = Boosting(trees=12, initial_window=40)
    predicted, shares = fold_trees.fit_folds(x, y, how)
    for f in range(6):
        want, importance = _loop_fit(x[: 40 + f], y[: 40 + f], x[40 + f], how)
        assert predicted[f] == pytest.approx(want, abs=1e-9)
        assert shares[f] == pytest.approx(importance, abs=1e-9)


def test_folds_do_not_see_later_rows(monkeypatch):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(90, 4)), rng.normal(size=90)
    how = Boosting(trees=20, initial_window=50)
    whole, shares = fold_trees.fit_folds(x, y, how)
    for end in (51, 70):
        part, part_shares = fold_trees.fit_folds(x[:end], y[:end], how)
        assert np.array_equal(part, whole[: end - 50]) and np.array_equal(part_shares, shares[: end - 50])
    monkeypatch.setattr(fold_trees, "_CELLS", 1)  # a fold at a time
    assert np.array_equal(fold_trees.fit_folds(x, y, how)[0], whole)
    assert fold_trees.fit_folds(x[:50], y[:50], how)[0].size == 0


def test_trees_of_a_panel(spark):
    rng = np.random.default_rng(7)
    df = None
    for k in "ab":
        level = 10 + 2 * np.sin(np.arange(60) * np.pi / 6) + 0.1 * rng.normal(size=60)
        part = series(spark, [float(v) for v in level], key=k, name="price")
        df = part if df is None else df.unionByName(part)
    df = df.unionByName(series(spark, [1.0, 2.0], key="short", name="price"))
    df = trees.add_calendar_and_target_lags(df, "price").withColumn("d", F.lit(1.0)).withColumn("d_lag_1", F.lit(2.0))
    sets = trees.feature_sets(df, "price", ["d"], ["d_lag_1"])
    predictions, importance = modelling.backtest_models(df, "price", sets, how=Boosting(trees=60, rate=0.1, initial_window=36))
    rows = predictions.collect()
    # twelve rows have no lags; the selected set has none of them
    sizes = {s.name: 12 for s in sets} | {"selected": 24}
    for s in sets:
        for k in "ab":
            own = sorted((r for r in rows if (r["model"], r["series_key"]) == (s.name, k)), key=lambda r: r["fold"])
            assert [r["fold"] for r in own] == list(range(1, sizes[s.name] + 1))
            if s.name != "selected":
                assert np.mean([abs(r["prediction"] / r["actual"] - 1) for r in own]) < 0.06
    assert {r["series_key"] for r in rows} == {"a", "b"}
    sums = importance.groupBy("series_key", "model").agg(F.sum("importance").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in sums if r["model"] != "selected")


def test_written_predictions_are_scored_alike_by_duckdb(spark, tmp_path):
    import duckdb

    rng = np.random.default_rng(1)
    df = series(spark, [float(v) for v in 10 + rng.normal(size=40).cumsum() * 0.1], name="price").withColumn("d", F.rand(3))
    sets = [trees.FeatureSet("one", ("d",))]
    predictions, _ = modelling.backtest_models(df, "price", sets, how=Boosting(trees=10, initial_window=24))
    predictions.write.parquet(f"file://{tmp_path}/p")
    from tidetable.operators import backtest

    (got,) = backtest.compare_models(predictions).collect()
    mae, rmse, n = duckdb.sql(f"SELECT avg(abs(actual - prediction)), sqrt(avg((actual - prediction) ** 2)), count(*) FROM '{tmp_path}/p/*.parquet'").fetchall()[0]
    assert (got["mae"], got["rmse"], got["n_obs"]) == (pytest.approx(mae), pytest.approx(rmse), n) and n == 16


def test_error_weights_are_those_of_the_recursion(spark):
    beta, lags = [0.3, 0.5, -0.2, 0.25], (1, 3, 12)
    c = F.array(*[F.lit(b) for b in beta])
    got = spark.range(1).select(regression.error_weights(c, lags, F.lit(20)).alias("w")).first()["w"]
    path = [0.0] * 12 + [1.0]  # one error of 1, then nothing but the lags
    for _ in range(19):
        path.append(sum(b * path[-k] for b, k in zip(beta[1:], lags)))
    assert got == pytest.approx(path[12:])
    assert spark.range(1).select(regression.error_weights(c, lags, F.lit(0)).alias("w")).first()["w"] == [1.0]


def test_bounds_grow_as_simulated(spark):
    rng = np.random.default_rng(11)
    y = [0.0]
    for _ in range(399):
        y.append(0.8 * y[-1] + rng.normal())
    history = series(spark, [float(v) for v in y], start="1990-01", name="y")
    ahead = months("2023-05", 8)
    future = spark.createDataFrame([("a", m) for m in ahead], "series_key string, month date")
    out = regression.forecast(history, future, regression.RegressionSpec("y", lags=(1,), initial_window=200)).orderBy("month").collect()
    assert [r["step"] for r in out] == list(range(1, 9))
    half = np.array([r["upper_bound"] - r["prediction"] for r in out])
    shocks = rng.normal(size=(40_000, 8))
    paths = np.zeros((40_000, 8))
    for s in range(8):
        paths[:, s] = shocks[:, s] + (0.8 * paths[:, s - 1] if s else 0)
    assert half / half[0] == pytest.approx(paths.std(axis=0) / paths[:, 0].std(), rel=0.12)


def test_unit_root_equals_the_numpy_form(spark):
    rng = np.random.default_rng(5)
    made = {"walk": rng.normal(size=90).cumsum() + 1000, "noise": rng.normal(size=60), "short": rng.normal(size=9), "tiny": rng.normal(size=4), "flat": np.ones(30)}
    made |= {f"s{i}": rng.normal(size=int(rng.integers(12, 130))).cumsum() * rng.choice([1, 50]) for i in range(25)}
    made["season"] = np.tile(rng.normal(size=12), 6) + 0.01 * rng.normal(size=72)
    df = None
    for k, values in made.items():
        part = [(k, m, float(v)) for m, v in zip(months("2000-01", len(values)), values)]
        df = part if df is None else df + part
    frame = spark.createDataFrame(df, "series_key string, month date, x double")
    for max_lag in (None, 0, 3):
        got = {r["series_key"]: r for r in stationarity.stationarity(frame, "x", max_lag=max_lag).collect()}
        assert set(got) == set(made)
        for k, values in made.items():
            statistic, lags, n = stationarity.unit_root_statistic(values, max_lag)
            r = got[k]
            if np.isfinite(statistic):
                assert (r["lags"], r["n_obs"]) == (lags, n) and r["statistic"] == pytest.approx(statistic, rel=1e-6, abs=1e-8), k
                critical = sum(b / n**i for i, b in enumerate(stationarity.CRITICAL_VALUES["critical_5pct"]))
                assert r["is_stationary"] == (statistic < critical)
            else:
                assert r["statistic"] is None and r["is_stationary"] is None
    plan = stationarity.stationarity(frame, "x")._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Python" not in plan


def test_partial_autocorrelation_equals_the_numpy_form(spark):
    rng = np.random.default_rng(6)
    df = series(spark, [float(v) for v in rng.normal(size=70).cumsum()]).unionByName(series(spark, [float(i % 2) for i in range(40)], key="b"))
    acf = stats.autocorrelation(df, "x").cache()
    got = {}
    for r in stationarity.partial_autocorrelation(acf).collect():
        got.setdefault(r["series_key"], {})[r["lag"]] = r["partial"]
    for k in "ab":
        r = np.array([x["correlation"] for x in acf.filter(F.col("series_key") == k).orderBy("lag").collect()])
        want = stationarity.partial_from_autocorrelation(r)
        assert [got[k][i] for i in range(25)] == pytest.approx(want.tolist(), nan_ok=True)
