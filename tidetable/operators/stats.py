"""Profiles, correlations, scaling, scores and decomposition; all built-in aggregates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidetable.functions import numeric
from tidetable.operators.panel import Keys, as_list, series_window
from tidetable.session import broadcast_if_small


def quality_profile(df: DataFrame, key: Keys, time: str, target: str) -> DataFrame:
    """Rows, missing periods, missing targets, repeated rows and repeated periods per series.

    Three nested group-bys count repeats level by level.  A ``count(distinct ...)``
    pair would copy every row first; here copies shrink before each shuffle.
    """
    keys = as_list(key)
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    periods = rows.groupBy(*keys, time).agg(
        F.sum("_n").alias("_n"),
        F.sum(F.col("_n") - 1).alias("_dup_rows"),
        F.sum(F.when(F.col(target).isNull(), F.col("_n")).otherwise(0)).alias("_no_target"),
    )
    return periods.groupBy(*keys).agg(
        F.sum("_n").alias("rows"),
        F.sum(F.when(F.col(time).isNull(), F.col("_n")).otherwise(0)).alias("missing_date"),
        F.sum("_no_target").alias("missing_target"),
        F.sum("_dup_rows").alias("duplicate_rows"),
        F.sum(F.col("_n") - 1).alias("duplicate_dates"),
    )


def missing_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of NULLs per column in percent: one scan, one row, then unpivoted."""
    columns = list(columns or df.columns)
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in columns])
    return shares.unpivot([], columns, "column_name", "missing_pct")


def period_range(df: DataFrame, key: Keys = "series_key", time: str = "month") -> DataFrame:
    return df.groupBy(*as_list(key)).agg(F.min(time).alias("first_period"), F.max(time).alias("last_period"))


def distinct_count(df: DataFrame, column: str, key: Keys = (), *, approximate: bool = False) -> DataFrame:
    """Exact by default; the sketch is offered for columns with very many values."""
    agg = (F.approx_count_distinct if approximate else F.count_distinct)(column).alias("n_distinct")
    return df.groupBy(*as_list(key)).agg(agg) if as_list(key) else df.agg(agg)


def pearson(x: str, y: str) -> Column:
    """Aggregate: correlation of complete pairs, NULL when a side has no spread.

    Spark's own ``corr`` divides by zero there, which ANSI mode turns into an error.
    """
    sx = F.stddev_pop(F.when(F.col(y).isNotNull(), F.col(x)))
    sy = F.stddev_pop(F.when(F.col(x).isNotNull(), F.col(y)))
    return numeric.ratio(F.covar_pop(x, y), sx * sy)


def lag_correlation(
    df: DataFrame,
    target: str,
    features: Sequence[str],
    key: Keys = "series_key",
    time: str = "month",
    *,
    max_lag: int = 12,
    direction: str = "lag",
    digits: int | None = None,
) -> DataFrame:
    """Pearson correlation of the target with each feature 0..max_lag rows earlier (or later).

    Every pair uses its own overlapping rows.  Undefined correlations are 0.  The
    rows of a series, which the calendar bounds, become one array, and the moments
    of each lag are a fold over it against itself, so the group-by gets no more
    rows than the panel has.
    """
    keys = as_list(key)
    order = F.col(time).asc_nulls_first()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    values = {f"_x{i}": F.col(f).cast("double") for i, f in enumerate(features)} | {"_y": F.col(target).cast("double"), "_at": place}
    rows = df.select(*keys, *[c.alias(n) for n, c in values.items()])
    one = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_at", "_y", *[f"_x{i}" for i in range(len(features))]))).alias("_p"))
    cells = []
    for i, f in enumerate(features):
        if direction not in ("lag", "lead"):
            raise ValueError(f"unknown direction {direction!r}")
        cells.append(_labelled(F.transform(F.sequence(F.lit(0), F.lit(max_lag)), _lagged_pearson("_p", f"_x{i}", "_y", direction)), f))
    out = one.select(*keys, F.inline(F.flatten(F.array(*cells))))
    corr = numeric.null_to_zero(F.col("correlation"))
    return out.withColumn("correlation", corr if digits is None else F.round(corr, digits))


def _labelled(values: Column, feature: str) -> Column:
    return F.transform(values, lambda c, k: F.struct(F.lit(feature).alias("feature"), k.alias("lag"), c.alias("correlation")))


def _lagged_pearson(points: str, x: str, y: str, direction: str):
    """Correlation of ``y`` with ``x`` so many places earlier (or later) in an array of structs; NULL without spread."""

    def at(k: Column) -> Column:
        kept = F.greatest(F.size(points) - k, F.lit(0))
        head, tail = F.slice(points, 1, kept), F.slice(points, k + 1, kept)
        early, late = (head, tail) if direction == "lag" else (tail, head)
        pairs = F.filter(F.zip_with(early, late, lambda a, b: F.struct(a[x].alias("x"), b[y].alias("y"))), lambda p: p["x"].isNotNull() & p["y"].isNotNull())
        names = ("n", "sx", "sy", "sxx", "syy", "sxy")

        def add(m: Column, p: Column) -> Column:
            # from the first pair on, so that large levels do not cancel
            a, b = p["x"] - m["x0"], p["y"] - m["y0"]
            grown = (m["n"] + 1, m["sx"] + a, m["sy"] + b, m["sxx"] + a * a, m["syy"] + b * b, m["sxy"] + a * b)
            return F.struct(m["x0"].alias("x0"), m["y0"].alias("y0"), *[g.alias(n) for g, n in zip(grown, names)])

        def finish(m: Column) -> Column:
            vx, vy = m["n"] * m["sxx"] - m["sx"] * m["sx"], m["n"] * m["syy"] - m["sy"] * m["sy"]
            flat = (vx <= 1e-12 * m["n"] * m["sxx"]) | (vy <= 1e-12 * m["n"] * m["syy"])
            return F.when(~flat, (m["n"] * m["sxy"] - m["sx"] * m["sy"]) / F.sqrt(vx * vy))

        first = F.get(pairs, F.lit(0))
        zero = F.struct(F.coalesce(first["x"], F.lit(0.0)).alias("x0"), F.coalesce(first["y"], F.lit(0.0)).alias("y0"), *[F.lit(0.0).alias(n) for n in names])
        return F.aggregate(pairs, zero, add, finish)

    return at


def _cells_to_rows(
    rows: DataFrame, keys: list[str], cells: dict[str, tuple[str, int]], values: dict[str, Column], digits: int | None
) -> DataFrame:
    """One group-by with an aggregate per cell, then a row (feature, lag, correlation) for each."""
    aggregates = [(v if digits is None else F.round(v, digits)).alias(n) for n, v in values.items()]
    one = rows.groupBy(*keys).agg(*aggregates)
    made = [
        F.struct(F.lit(f).alias("feature"), F.lit(k).alias("lag"), F.col(n).alias("correlation"))
        for n, (f, k) in cells.items()
    ]
    return one.select(*keys, F.inline(F.array(*made)))


def cross_correlation(
    df: DataFrame,
    target: str,
    features: Sequence[str],
    key: Keys = "series_key",
    time: str = "month",
    *,
    max_lag: int = 12,
    direction: str = "lead",
    digits: int | None = None,
) -> DataFrame:
    """Cross-correlation with whole-sample means and divisor n.

    ``direction="lead"`` pairs the feature ``k`` rows later with the target.
    Rows with a missing value on either side are left out first.
    """
    keys = as_list(key)
    whole = Window.partitionBy(*keys)
    w = series_window(keys, time)
    shift = {"lag": F.lag, "lead": F.lead}[direction]
    rows = df.select(*keys, time, target, *[f for f in features if f != target]).na.drop(subset=[target, *features])
    centred = {"_y": F.col(target) - F.avg(target).over(whole), "_sy": F.stddev_pop(target).over(whole)}
    for i, f in enumerate(features):
        centred[f"_x{i}"] = F.col(f) - F.avg(f).over(whole)
        centred[f"_s{i}"] = F.stddev_pop(f).over(whole)
    rows = rows.withColumns(centred)
    cells, products, values = {}, [], {}
    for i, f in enumerate(features):
        products.append((F.col(f"_s{i}") * F.col("_sy")).alias(f"_ss{i}"))
        for k in range(max_lag + 1):
            name = f"_xy{i}_{k}"
            cells[name] = (f, k)
            products.append(((shift(f"_x{i}", k).over(w) if k else F.col(f"_x{i}")) * F.col("_y")).alias(name))
            values[name] = numeric.null_to_zero(numeric.ratio(F.sum(name), F.count(F.lit(1)) * F.max(f"_ss{i}")))
    return _cells_to_rows(rows.select(*keys, *products), keys, cells, values, digits)


def autocorrelation(
    df: DataFrame, value: str, key: Keys = "series_key", time: str = "month", *, max_lag: int = 24
) -> DataFrame:
    """The cross-correlation of a series with itself."""
    return cross_correlation(df, value, [value], key, time, max_lag=max_lag, direction="lag").drop("feature")


def correlation_matrix(df: DataFrame, columns: Sequence[str], key: Keys = ()) -> DataFrame:
    """Long-form correlation matrix over complete rows, both triangles and the diagonal."""
    keys, columns = as_list(key), list(columns)
    complete = df.select(*keys, *columns).na.drop(subset=columns)
    pairs = list(combinations(columns, 2))
    aggs = [pearson(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)]
    one = complete.groupBy(*keys).agg(*aggs) if keys else complete.agg(*aggs)

    def cell(a: str, b: str, r: Column) -> Column:
        return F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), r.alias("correlation"))

    cells = [cell(c, c, F.lit(1.0)) for c in columns]
    for i, (a, b) in enumerate(pairs):
        r = F.col(f"_c{i}")
        cells += [cell(a, b, r), cell(b, a, r)]
    return one.select(*keys, F.inline(F.array(*cells)))


def scores(
    df: DataFrame,
    group: Keys,
    order: Keys = "month",
    *,
    series: Keys | None = None,
    actual: str = "actual",
    predicted: str = "prediction",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """MAE, RMSE, MAPE (rows with actual 0 left out), directional accuracy and row count.

    Pairs with a missing side do not count, and changes reach back to the last
    complete pair.  Changes are taken along ``order`` within ``series`` (the group
    itself by default), so a score over many series never needs one window over
    all of them.  ``extra`` aggregates see every row of the group.
    """
    group = as_list(group)
    series = as_list(series) if series is not None else group
    past = Window.partitionBy(*series).orderBy(*as_list(order)).rowsBetween(Window.unboundedPreceding, -1)
    a, p = F.col(actual), F.col(predicted)
    valid = a.isNotNull() & p.isNotNull()
    before = F.last(F.when(valid, F.struct(a.alias("a"), p.alias("p"))), ignorenulls=True).over(past)
    pairs = df.withColumn("_before", before)
    error = F.when(valid, a - p)
    changed = valid & F.col("_before").isNotNull()
    hit = F.when(changed, numeric.same_direction(a - F.col("_before.a"), p - F.col("_before.p")).cast("double"))
    return pairs.groupBy(*group).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.when(a != 0, F.abs(error) / a)) * 100).alias("mape"),
        F.avg(hit).alias("directional_accuracy"),
        F.count_if(valid).alias("n_obs"),
        *extra,
    )


def fit_quality(
    df: DataFrame, group: Keys, *, actual: str = "actual", predicted: str = "prediction"
) -> DataFrame:
    """R squared, bias and guarded MAPE."""
    a, p = F.col(actual), F.col(predicted)
    pairs = df.filter(a.isNotNull() & p.isNotNull())
    spread = F.var_pop(actual) * F.count(F.lit(1))
    return pairs.groupBy(*as_list(group)).agg(
        (1 - numeric.ratio(F.sum((a - p) * (a - p)), spread)).alias("r2"),
        F.avg(p - a).alias("bias"),
        F.avg(numeric.percent_error(actual, predicted)).alias("mape_guarded"),
    )


def training_rmse(
    df: DataFrame,
    group: Keys,
    order: str = "month",
    *,
    warm_up: int = 13,
    actual: str = "actual",
    predicted: str = "prediction",
) -> DataFrame:
    """RMSE of fitted values after the first ``warm_up`` rows of each series."""
    keys = as_list(group)
    rn = F.row_number().over(series_window(keys, order))
    e = F.col(actual) - F.col(predicted)
    kept = df.withColumn("_rn", rn).filter(F.col("_rn") > warm_up)
    return kept.groupBy(*keys).agg(F.sqrt(F.avg(e * e)).alias("training_rmse"))


def residual_band(
    df: DataFrame,
    group: Keys,
    *,
    z: float = 1.96,
    actual: str = "actual",
    predicted: str = "prediction",
) -> DataFrame:
    """Bounds at ``z`` sample deviations of the residuals of the row's own group."""
    sigma = F.stddev_samp(F.col(actual) - F.col(predicted)).over(Window.partitionBy(*as_list(group)))
    return df.withColumn("_s", sigma).withColumns(
        {"lower_bound": F.col(predicted) - z * F.col("_s"), "upper_bound": F.col(predicted) + z * F.col("_s")}
    ).drop("_s")


def fit_scaler(df: DataFrame, columns: Iterable[str], key: Keys = "series_key") -> DataFrame:
    """Mean and population deviation per series; a zero deviation becomes 1."""
    columns = list(columns)
    aggs = [F.avg(c).alias(f"{c}_mean") for c in columns]
    aggs += [F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias(f"{c}_sd") for c in columns]
    return df.groupBy(*as_list(key)).agg(*aggs)


def apply_scaler(
    df: DataFrame, scaler: DataFrame, columns: Iterable[str], key: Keys = "series_key", *, suffix: str = "_z"
) -> DataFrame:
    """Standardise with a scaler fitted elsewhere."""
    columns = list(columns)
    joined = df.join(broadcast_if_small(scaler), as_list(key), "left")
    scaled = {f"{c}{suffix}": (F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_sd") for c in columns}
    return joined.withColumns(scaled).drop(*[f"{c}_{p}" for c in columns for p in ("mean", "sd")])


def min_max(
    df: DataFrame, columns: Iterable[str], key: Keys = "series_key", *, suffix: str = "_norm"
) -> DataFrame:
    """Scale each series to 0..1; a constant series gives NULL."""
    w = Window.partitionBy(*as_list(key))
    return df.withColumns(
        {f"{c}{suffix}": numeric.ratio(F.col(c) - F.min(c).over(w), F.max(c).over(w) - F.min(c).over(w)) for c in columns}
    )


def seasonal_decompose(
    df: DataFrame, value: str, key: Keys = "series_key", time: str = "month", *, period: int = 12
) -> DataFrame:
    """Additive trend, season and remainder; ``df`` must be on a regular calendar.

    Trend: centred moving average, half weight on the two ends when the period is
    even, NULL where the frame is incomplete.  Season: mean of the detrended
    values per position in the year, centred to sum to zero over a period.
    """
    keys = as_list(key)
    half = period // 2
    w = series_window(keys, time)
    frame = w.rowsBetween(-half, half)
    total = F.sum(value).over(frame)
    if period % 2 == 0:
        total = total - 0.5 * F.lag(value, half).over(w) - 0.5 * F.lead(value, half).over(w)
    complete = F.count(value).over(frame) == 2 * half + 1
    whole = Window.partitionBy(*keys)
    rows = (
        df.withColumn("_pos", (F.row_number().over(w) - 1) % period)
        .withColumn("trend", F.when(complete, total / period))
        .withColumn("_raw", F.avg(F.col(value) - F.col("trend")).over(whole.partitionBy(*keys, "_pos")))
    )
    # mean over positions, each counted once although a position occurs in several years
    one_per_position = F.when(F.row_number().over(w) <= period, F.col("_raw"))
    rows = rows.withColumn("seasonal", F.col("_raw") - F.avg(one_per_position).over(whole))
    return rows.withColumn("resid", F.col(value) - F.col("trend") - F.col("seasonal")).drop("_pos", "_raw")


def histogram(df: DataFrame, value: str, key: Keys, *, bins: int = 20) -> DataFrame:
    """Counts in equal-width bins between each group's smallest and largest value.

    Bounds come from a grouped aggregate, not a window, so a group of any size
    is never gathered in one task.
    """
    keys = as_list(key)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    bounds = rows.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    share = numeric.ratio(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    bucket = F.least(F.lit(bins), F.coalesce(F.floor(share * bins), F.lit(0)) + 1).cast("int")
    return (
        rows.join(broadcast_if_small(bounds), keys)
        .groupBy(*keys, bucket.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def dickey_fuller_lag0(df: DataFrame, value: str, key: Keys = "series_key", time: str = "month") -> DataFrame:
    """Dickey-Fuller statistic without added lags, from regression aggregates."""
    keys = as_list(key)
    w = series_window(keys, time)
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, F.lag(value).over(w).alias("_x"), (F.col(value) - F.lag(value).over(w)).alias("_dy")
    )
    g = rows.filter(F.col("_x").isNotNull()).groupBy(*keys).agg(
        F.regr_slope("_dy", "_x").alias("_b"),
        F.regr_sxx("_dy", "_x").alias("_sxx"),
        F.regr_syy("_dy", "_x").alias("_syy"),
        F.count(F.lit(1)).alias("n_obs"),
    )
    rss = F.col("_syy") - F.col("_b") * F.col("_b") * F.col("_sxx")
    se = F.sqrt(numeric.ratio(F.greatest(rss, F.lit(0.0)), (F.col("n_obs") - 2) * F.col("_sxx")))
    return g.filter(F.col("n_obs") > 2).select(*keys, numeric.ratio("_b", se).alias("df_statistic"), "n_obs")


def mean_importance(df: DataFrame, key: Keys = ()) -> DataFrame:
    """Average importance per feature over folds."""
    return df.groupBy(*as_list(key), "feature").agg(F.avg("importance").alias("importance"))
