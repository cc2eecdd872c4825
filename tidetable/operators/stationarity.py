"""Unit-root test and partial autocorrelation, by sums per series and folds over small arrays.

A series has one row per period, so a group and its arrays are bounded by the calendar.  ``unit_root_statistic`` and
``partial_from_autocorrelation`` are the same for one series in numpy, for checks.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidetable.operators.panel import Keys, as_list, series_window
from tidetable.session import materialize

# Published response-surface coefficients of the Dickey-Fuller
# distribution with a constant; powers of 1/n from the zeroth upwards.
CRITICAL_VALUES = {
    "critical_1pct": (-3.43035, -6.5393, -16.786, -79.433),
    "critical_5pct": (-2.86154, -2.8903, -4.234, -40.040),
    "critical_10pct": (-2.56677, -1.5384, -2.809, 0.0),
}


def _regress(y: np.ndarray, lags: int, start: int) -> tuple[float, float, int]:
    """t statistic of the level term, AIC and row count of one Dickey-Fuller regression."""
    dy = np.diff(y)
    rows = np.arange(start, len(dy))
    x = np.column_stack([np.ones(len(rows)), y[rows], *[dy[rows - k] for k in range(1, lags + 1)]])
    beta, _, rank, _ = np.linalg.lstsq(x, dy[rows], rcond=None)
    n, k = x.shape
    rss = float(((dy[rows] - x @ beta) ** 2).sum())
    if rank < k or n <= k or rss <= 0:
        return float("nan"), float("inf"), n
    se = np.sqrt(rss / (n - k) * np.linalg.inv(x.T @ x)[1, 1])
    aic = n * (np.log(2 * np.pi * rss / n) + 1) + 2 * k
    return float(beta[1] / se), float(aic), n


def unit_root_statistic(values: np.ndarray, max_lag: int | None = None) -> tuple[float, int, int]:
    """(statistic, lags used, rows used); lags are chosen by AIC on a common sample."""
    y = np.asarray(values, dtype=float)
    n = len(y)
    if n < 6 or np.ptp(y) == 0:
        return float("nan"), 0, n
    limit = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2) if max_lag is None else max_lag
    limit = max(limit, 0)
    best = min(range(limit + 1), key=lambda p: _regress(y, p, limit)[1])
    statistic, _, rows = _regress(y, best, best)
    return statistic, best, rows


def _swept(gram: Column, size: int, k: Column) -> Column:
    """The symmetric matrix ``gram`` (rows one behind the other) swept at its k-th diagonal cell.

    Afterwards the cells beside the swept ones hold the coefficients of a regression on them, and the swept ones the
    negative of an inverse.  A diagonal that has nothing left makes every cell NULL.
    """
    cell = lambda i, j: F.get(gram, i * size + j)
    pivot = cell(k, k)

    def one(at: Column) -> Column:
        i, j = F.floor(at / size).cast("int"), F.pmod(at, F.lit(size)).cast("int")
        return (
            F.when((i == k) & (j == k), -1.0 / pivot)
            .when((i == k) | (j == k), F.get(gram, at) / pivot)
            .otherwise(F.get(gram, at) - cell(i, k) * cell(k, j) / pivot)
        )

    whole = F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), one)
    return F.when(pivot > 0, whole)


def _sweeps(gram: Column, size: int, steps: Column, scale: Column) -> Column:
    """What the last diagonal cell, the residual sum of squares, is after 1, 2, ... sweeps, and the matrix at the end.

    ``scale`` holds the first diagonal; a pivot of which next to nothing is left belongs to a column that the others give.
    """
    last = size * size - 1

    def sweep(state: Column, k: Column) -> Column:
        pivot = F.get(state["m"], k * (size + 1))
        usable = pivot > 1e-11 * F.get(scale, k)
        after = F.when(usable, _swept(state["m"], size, k))
        return F.struct(after.alias("m"), F.concat(state["rss"], F.array(F.get(after, F.lit(last)))).alias("rss"))

    return F.aggregate(steps, F.struct(gram.alias("m"), F.array().cast("array<double>").alias("rss")), sweep)


def stationarity(
    df: DataFrame, value: str, key: Keys = "series_key", time: str = "month", *, max_lag: int | None = None
) -> DataFrame:
    """Statistic, critical values and the 5 % decision for each series.

    One Gram matrix per series holds the sums for the largest lag, over the rows that have it.  Sweeping its columns one
    by one gives the fit of every shorter lag, among which the criterion chooses; a second matrix over all rows that the
    chosen lag has gives the statistic.  Sums and sweeps run in the JVM; no series is sent to Python.
    """
    keys = as_list(key)
    w, whole = series_window(keys, time), Window.partitionBy(*keys)
    rows = df.select(*keys, time, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    n = F.count(F.lit(1)).over(whole)
    rows = rows.withColumns({"_n": n, "_flat": F.min("_v").over(whole) == F.max("_v").over(whole), "_i": F.row_number().over(w) - 1})
    if max_lag is None:
        # whole numbers, so that the root is the same everywhere
        limit = F.least(F.ceil(12 * F.pow(F.col("_n") / 100.0, 0.25)), F.floor(F.col("_n") / 2) - 2)
    else:
        limit = F.lit(max_lag)
    rows = rows.withColumn("_limit", F.greatest(limit, F.lit(0)).cast("int"))
    # the level is taken from the series' mean, which changes nothing but the rounding
    rows = rows.withColumns({"_x": F.col("_v") - F.avg("_v").over(whole), "_dy": F.lead("_v").over(w) - F.col("_v")})
    short = (F.col("_n") < 6) | F.col("_flat")
    most = rows.filter(~short).agg(F.max("_limit")).first()[0]
    most = 0 if most is None else int(most)
    size = most + 3  # constant, level, lagged differences, difference
    shifted = {f"_d{k}": F.lag("_dy", k).over(w) for k in range(1, most + 1)}
    lagged = materialize(rows.withColumns(shifted), "lags")

    def gram(source: DataFrame, lags: str) -> DataFrame:
        """Sums of products over the rows that have ``lags`` lags; columns beyond a series' lags are left out as zeros."""
        own = [F.lit(1.0), F.col("_x"), *[F.when(F.col(lags) >= k, F.col(f"_d{k}")).otherwise(0.0) for k in range(1, most + 1)], F.col("_dy")]
        used = source.filter((F.col("_i") >= F.col(lags)) & F.col("_dy").isNotNull()).select(*keys, lags, *[c.alias(f"_c{i}") for i, c in enumerate(own)])
        sums = [F.sum(F.col(f"_c{i}") * F.col(f"_c{j}")).alias(f"_s{i}_{j}") for i in range(size) for j in range(i, size)]
        found = used.groupBy(*keys, lags).agg(F.count(F.lit(1)).alias("_rows"), *sums)
        cells = F.array(*[F.col(f"_s{min(i, j)}_{max(i, j)}") for i in range(size) for j in range(size)])
        scale = F.array(*[F.col(f"_s{i}_{i}") for i in range(size)])
        return found.select(*keys, lags, "_rows", cells.alias("_gram"), scale.alias("_scale"))

    usable = lagged.filter(~short)
    common = gram(usable, "_limit")
    steps = F.sequence(F.lit(0), F.col("_limit") + 1)
    common = common.withColumn("_rss", _sweeps(F.col("_gram"), size, steps, F.col("_scale"))["rss"])
    # after the constant and the level come lags 0, 1, 2, ...
    criterion = F.transform(
        F.slice("_rss", 2, F.col("_limit") + 1),
        lambda rss, p: F.struct(
            F.coalesce(F.when((rss > 0) & (F.col("_rows") > p + 2), F.col("_rows") * (F.ln(2 * F.lit(math.pi) * rss / F.col("_rows")) + 1) + 2 * (p + 2)), F.lit(math.inf)).alias("aic"),
            p.alias("p"),
        ),
    )
    chosen = common.select(*keys, F.array_min(criterion)["p"].alias("lags"))
    best = gram(usable.join(chosen, keys), "lags")
    best = best.withColumn("_end", _sweeps(F.col("_gram"), size, F.sequence(F.lit(0), F.col("lags") + 1), F.col("_scale")))
    rss, slope = F.element_at("_end.rss", -1), F.get("_end.m", F.lit(size + size - 1))
    free = F.col("_rows") - F.col("lags") - 2
    spread = F.when((rss > 0) & (free > 0), F.sqrt(rss / free * -F.get("_end.m", F.lit(size + 1))))
    tested = best.select(*keys, (slope / spread).alias("statistic"), F.col("lags").cast("long").alias("lags"), F.col("_rows").alias("n_obs"))
    every = lagged.groupBy(*keys).agg(F.max("_n").alias("_n"))
    out = every.join(tested, keys, "left").withColumns({"lags": F.coalesce("lags", F.lit(0).cast("long")), "n_obs": F.coalesce("n_obs", "_n")}).drop("_n")
    for name, powers in CRITICAL_VALUES.items():
        total = F.lit(powers[0])
        for i, b in enumerate(powers[1:], start=1):
            total = total + F.lit(b) / F.pow(F.col("n_obs").cast("double"), F.lit(float(i)))
        out = out.withColumn(name, total)
    return out.withColumn("is_stationary", F.col("statistic") < F.col("critical_5pct"))


def partial_from_autocorrelation(r: np.ndarray) -> np.ndarray:
    """Durbin-Levinson recursion; ``r[0]`` must be 1."""
    out = np.full(len(r), np.nan)
    out[0] = 1.0
    phi = np.zeros(0)
    variance = 1.0
    for k in range(1, len(r)):
        if variance <= 1e-12:
            break
        a = (r[k] - phi @ r[1:k][::-1]) / variance
        phi = np.append(phi - a * phi[::-1], a)
        variance *= 1 - a * a
        out[k] = a
    return out


def partial_autocorrelation(acf: DataFrame, key: Keys = "series_key") -> DataFrame:
    """From the autocorrelation table (key, lag, correlation): the recursion as a fold over a series' array of lags."""
    keys = as_list(key)
    points = F.array_sort(F.collect_list(F.struct("lag", "correlation")))
    grouped = acf.groupBy(*keys).agg(F.transform(points, lambda p: p["correlation"]).alias("_r"))
    empty = F.array().cast("array<double>")
    start = F.struct(empty.alias("phi"), F.lit(1.0).alias("left"), F.array(F.lit(1.0)).alias("out"))

    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        past = F.reverse(F.slice("_r", 2, k - 1))
        told = F.aggregate(F.zip_with(phi, past, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
        a = F.when(state["left"] > 1e-12, (F.get("_r", k) - told) / state["left"])
        longer = F.concat(F.zip_with(phi, F.reverse(phi), lambda x, y: x - a * y), F.array(a))
        return F.struct(longer.alias("phi"), (state["left"] * (1 - a * a)).alias("left"), F.concat(state["out"], F.array(a)).alias("out"))

    lags = F.filter(F.sequence(F.lit(0), F.size("_r") - 1), lambda k: k > 0)
    done = grouped.select(*keys, F.aggregate(lags, start, step)["out"].alias("_out"))
    return done.select(*keys, F.posexplode("_out").alias("lag", "partial")).withColumn("lag", F.col("lag").cast("long"))
