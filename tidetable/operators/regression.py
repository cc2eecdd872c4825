"""Seasonal autoregression with optional drivers, fitted by least squares per series.

The normal equations of every expanding window are running sums, so the cost is
linear in the rows: Spark adds the products in one window and only the small
k x k systems go to Python, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidetable.functions import numeric
from tidetable.operators.panel import Keys, as_list, series_window

# Fixed value: half width of the central 50 % of a standard normal distribution.
Z_50 = 0.67449


@dataclass(frozen=True)
class RegressionSpec:
    """What to fit; the season is part of ``lags``."""

    value: str
    drivers: tuple[str, ...] = ()
    lags: tuple[int, ...] = (1, 12, 13)
    initial_window: int = 60
    log_target: bool = False
    low: float | None = None
    high: float | None = None
    z: float = Z_50
    predict_with: dict[str, str] = field(default_factory=dict)

    @property
    def size(self) -> int:
        return 1 + len(self.lags) + len(self.drivers)


def _solver(size: int):
    upper = np.triu_indices(size)

    @F.pandas_udf("array<double>")
    def solve(sums: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(sums), index=sums.index, dtype=object)
        usable = sums[sums.notna()]
        if usable.empty:
            return out
        flat = np.stack(usable.to_numpy()).astype(float)
        n = len(flat)
        gram = np.zeros((n, size, size))
        gram[:, upper[0], upper[1]] = flat[:, : len(upper[0])]
        gram[:, upper[1], upper[0]] = flat[:, : len(upper[0])]
        gram += 1e-8 * np.eye(size)
        cross = flat[:, len(upper[0]) :, None]
        try:
            beta = np.linalg.solve(gram, cross)[:, :, 0]
        except np.linalg.LinAlgError:
            beta = np.full((n, size), np.nan)
            for i in range(n):
                try:
                    beta[i] = np.linalg.solve(gram[i], cross[i])[:, 0]
                except np.linalg.LinAlgError:
                    pass
        good = np.isfinite(beta).all(axis=1)
        for position, ok, row in zip(usable.index, good, beta):
            if ok:
                out.at[position] = row
        return out

    return solve


def _dot(beta: Column, parts: Sequence[Column]) -> Column:
    total = beta[0] * parts[0]
    for i, part in enumerate(parts[1:], start=1):
        total = total + beta[i] * part
    return total


def error_weights(beta: Column, lags: Sequence[int], steps: Column) -> Column:
    """How much the error of a month weighs 0, 1, 2, ... months later, when forecasts feed the lags."""

    def following(weights: Column, j: Column) -> Column:
        total = F.lit(0.0)
        for i, k in enumerate(lags, start=1):
            total = total + beta[i] * F.coalesce(F.when(j >= k, F.get(weights, j - k)), F.lit(0.0))
        return F.concat(weights, F.array(total))

    later = F.filter(F.sequence(F.lit(0), F.greatest(steps - 1, F.lit(0))), lambda j: j > 0)
    return F.aggregate(later, F.array(F.lit(1.0)), following)


def _design(df: DataFrame, spec: RegressionSpec, keys: list[str], time: str) -> DataFrame:
    """Rows with target ``_y``, regressors ``_x*``, products ``_g*`` and cross products ``_b*``.

    Lags and drivers are scaled by the first window of their own series: the same
    constants for every fold, and none of them looks ahead.
    """
    w = series_window(keys, time)
    whole = Window.partitionBy(*keys)
    y = numeric.safe_ln(spec.value) if spec.log_target else F.col(spec.value).cast("double")
    rows = df.withColumn("_y", y).withColumn("_rn", F.row_number().over(w))
    scale = {}
    for j, d in (("y", "_y"), *enumerate(spec.drivers)):
        early = F.when(F.col("_rn") <= spec.initial_window, F.col(d))
        scale[f"_m{j}"] = F.coalesce(F.avg(early).over(whole), F.lit(0.0))
        scale[f"_d{j}"] = F.coalesce(F.nullif(F.stddev_pop(early).over(whole), F.lit(0.0)), F.lit(1.0))
    rows = rows.withColumns(scale)
    parts: dict[str, Column] = {"_x0": F.lit(1.0)}
    for i, k in enumerate(spec.lags, start=1):
        parts[f"_x{i}"] = (F.lag("_y", k).over(w) - F.col("_my")) / F.col("_dy")
    first_driver = 1 + len(spec.lags)
    for j, d in enumerate(spec.drivers):
        parts[f"_x{first_driver + j}"] = (F.col(d) - F.col(f"_m{j}")) / F.col(f"_d{j}")
        used = spec.predict_with.get(d, d)
        parts[f"_u{first_driver + j}"] = (F.col(used) - F.col(f"_m{j}")) / F.col(f"_d{j}")
    rows = rows.withColumns(parts)
    x = [F.col(f"_x{i}") for i in range(spec.size)]
    complete = F.col("_y").isNotNull()
    for c in x[1:]:
        complete = complete & c.isNotNull()
    rows = rows.withColumn("_ok", complete)
    products = {}
    n = 0
    for i in range(spec.size):
        for j in range(i, spec.size):
            products[f"_g{n}"] = F.when(F.col("_ok"), x[i] * x[j])
            n += 1
    for i in range(spec.size):
        products[f"_b{i}"] = F.when(F.col("_ok"), x[i] * F.col("_y"))
    return rows.withColumns(products)


def _product_names(spec: RegressionSpec) -> list[str]:
    return [f"_g{i}" for i in range(spec.size * (spec.size + 1) // 2)] + [f"_b{i}" for i in range(spec.size)]


def _backtest_frame(df: DataFrame, spec: RegressionSpec, keys: list[str], time: str) -> DataFrame:
    w = series_window(keys, time)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = _design(df, spec, keys, time)
    names = _product_names(spec)
    n_train = F.count(F.when(F.col("_ok"), 1)).over(past)
    ready = (F.col("_rn") > spec.initial_window) & (n_train >= spec.size)
    sums = F.when(ready, F.array(*[F.sum(c).over(past) for c in names]))
    rows = rows.withColumn("_sums", sums).withColumn("_last_value", F.last(spec.value, True).over(past))
    rows = rows.withColumn("_beta", _solver(spec.size)(F.col("_sums"))).drop("_sums")
    used = [
        F.col(f"_u{i}") if i > len(spec.lags) else F.col(f"_x{i}") for i in range(spec.size)
    ]
    rows = rows.withColumn("_fit", _dot(F.col("_beta"), used))
    raw = F.exp("_fit") if spec.log_target else F.col("_fit")
    testable = F.col("_rn") > spec.initial_window
    plausible = F.col("_raw").isNotNull()
    if spec.low is not None:
        plausible = plausible & (F.col("_raw") >= spec.low)
    if spec.high is not None:
        plausible = plausible & (F.col("_raw") <= spec.high)
    rows = rows.withColumn("_raw", raw).withColumn("is_fallback", testable & ~plausible)
    error = F.when(~F.col("is_fallback"), F.col("_y") - F.col("_fit"))
    return rows.withColumn("_error", error).withColumn("_sigma", F.stddev_samp("_error").over(past))


def one_step_backtest(
    df: DataFrame, spec: RegressionSpec, key: Keys = "series_key", time: str = "month"
) -> DataFrame:
    """One-step forecasts of every row after the first window, each fitted on earlier rows only.

    ``df`` must be on a regular calendar.  A failed solve or a forecast outside
    ``low..high`` falls back to the last known value with NULL bounds.
    ``predict_with`` names columns that stand in for drivers at the forecast
    month, while the fit still uses the drivers themselves.
    """
    keys = as_list(key)
    rows = _backtest_frame(df, spec, keys, time).filter(F.col("_rn") > spec.initial_window)
    ok = ~F.col("is_fallback")
    lower, upper = F.col("_fit") - spec.z * F.col("_sigma"), F.col("_fit") + spec.z * F.col("_sigma")
    if spec.log_target:
        lower, upper = F.exp(lower), F.exp(upper)
    return rows.select(
        *keys,
        time,
        (F.col("_rn") - spec.initial_window).alias("fold"),
        F.lit(1).alias("step"),
        F.col(spec.value).alias("actual"),
        F.when(ok, F.col("_raw")).otherwise(F.col("_last_value")).alias("prediction"),
        F.when(ok, lower).alias("lower_bound"),
        F.when(ok, upper).alias("upper_bound"),
        "is_fallback",
    )


def forecast(
    history: DataFrame,
    future: DataFrame,
    spec: RegressionSpec,
    key: Keys = "series_key",
    time: str = "month",
) -> DataFrame:
    """Several steps ahead: fit on all history, then feed each forecast into the next.

    ``future`` holds one row per series and month with the driver columns.  The
    fit is one grouped sum per series, the recursion a fold over the array of
    future months; both arrays are bounded by the calendar.  An error of one
    month goes on through the lags, so the deviation at step ``s`` is that of
    the past one-step errors times the root of the squared weights that the
    errors of the first ``s`` months have; bounds are ``z`` of these deviations,
    on the fitted scale.
    """
    keys = as_list(key)
    names = _product_names(spec)
    longest = max(spec.lags, default=1)
    frame = _backtest_frame(history, spec, keys, time)
    fitted = frame.groupBy(*keys).agg(
        F.array(*[F.sum(c) for c in names]).alias("_sums"),
        F.count(F.when(F.col("_ok"), 1)).alias("_n"),
        F.stddev_samp("_error").alias("_sigma"),
        F.transform(
            F.slice(F.array_sort(F.collect_list(F.struct("_rn", "_y"))), -longest, longest), lambda p: p["_y"]
        ).alias("_tail"),
        F.count("_rn").alias("_rows"),
        *[F.first(f"_{p}{j}").alias(f"_{p}{j}") for j in ("y", *range(len(spec.drivers))) for p in "md"],
    )
    # a NULL sum cannot occur once a complete row exists
    fitted = fitted.filter((F.col("_n") >= spec.size) & (F.col("_rows") >= longest))
    fitted = fitted.withColumn("_beta", _solver(spec.size)(F.col("_sums"))).filter(F.col("_beta").isNotNull())
    ahead = future.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(time, *spec.drivers))).alias("_ahead")
    )
    rows = fitted.join(ahead, keys)

    def step(values: Column, f: Column) -> Column:
        parts = [F.lit(1.0)] + [(F.element_at(values, -k) - F.col("_my")) / F.col("_dy") for k in spec.lags]
        parts += [(f[d] - F.col(f"_m{j}")) / F.col(f"_d{j}") for j, d in enumerate(spec.drivers)]
        return F.concat(values, F.array(_dot(F.col("_beta"), parts)))

    rows = rows.withColumn("_path", F.aggregate("_ahead", F.col("_tail"), step))
    rows = rows.withColumn("_weights", error_weights(F.transform("_beta", lambda b: b / F.col("_dy")), spec.lags, F.size("_ahead")))

    def spread(step: Column) -> Column:
        """Sum of the squared weights of the errors up to this step."""
        return F.aggregate(F.slice("_weights", 1, step), F.lit(0.0), lambda total, w: total + w * w)

    points = F.transform(
        "_ahead",
        lambda f, i: F.struct(
            f[time].alias(time), (i + 1).alias("step"), F.get(F.col("_path"), i + longest).alias("_fit"), F.sqrt(spread(i + 1)).alias("_grown")
        ),
    )
    out = rows.select(*keys, "_sigma", F.inline(points))
    back = F.exp if spec.log_target else (lambda c: c)
    fit, half = F.col("_fit"), spec.z * F.col("_sigma") * F.col("_grown")
    fitted_rows = out.select(
        *keys,
        time,
        "step",
        back(fit).alias("prediction"),
        back(fit - half).alias("lower_bound"),
        back(fit + half).alias("upper_bound"),
        F.lit(False).alias("is_fallback"),
    )
    # series that cannot be fitted get their last value, without bounds
    known = history.filter(F.col(spec.value).isNotNull()).groupBy(*keys).agg(F.max_by(spec.value, time).alias("prediction"))
    others = future.select(*keys, time, F.row_number().over(series_window(keys, time)).alias("step"))
    others = others.join(fitted.select(*keys), keys, "left_anti").join(known, keys, "left")
    nothing = F.lit(None).cast("double")
    return fitted_rows.unionByName(
        others.select(
            *keys,
            time,
            "step",
            F.col("prediction").cast("double").alias("prediction"),
            nothing.alias("lower_bound"),
            nothing.alias("upper_bound"),
            F.lit(True).alias("is_fallback"),
        )
    )
