"""Feature tables: history with the target, and the months still to come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.functions import numeric
from tidetable.operators import calendar, joins, windows
from tidetable.operators.panel import Keys, as_list


def one_region(weather: DataFrame, region: str, measures: Sequence[str]) -> DataFrame:
    return weather.filter(F.col("state") == region).select("month", *measures)


def blended_regions(weather: DataFrame, weights: dict[str, float], measures: Sequence[str]) -> DataFrame:
    """Weighted blend of regions, NULL in months where one of them is missing.

    One conditional aggregate per region and measure: the pivot and the blend
    are one group-by.
    """
    cells = {
        (m, r): F.max(F.when(F.col("state") == r, F.col(m))) for m in measures for r in weights
    }
    blends = []
    for m in measures:
        total = None
        for region, weight in weights.items():
            part = F.lit(float(weight)) * cells[m, region]
            total = part if total is None else total + part
        blends.append(total.alias(m))
    return weather.filter(F.col("state").isin(list(weights))).groupBy("month").agg(*blends)


def base_features(frames: Sequence[DataFrame], on: Keys = ("series_key", "month"), how: str = "inner") -> DataFrame:
    return joins.join_all(frames, on, how)


def gold_features(
    features: DataFrame,
    target: DataFrame,
    lags: dict[str, int],
    *,
    start: Column,
    key: Keys = "series_key",
    time: str = "month",
    mode: str = "calendar",
) -> DataFrame:
    """Lagged drivers from ``start`` on, complete rows only, joined to the target; measures as DOUBLE."""
    keys = as_list(key)
    lagged = windows.lag_map(features, lags, keys, time, mode=mode)
    names = [f"{c}_lag_{k}" for c, k in lags.items()]
    joined = lagged.filter(F.col(time) >= start).na.drop(how="any").join(target, [*keys, time], "inner")
    measures = [*names, *[c for c in target.columns if c not in (*keys, time)]]
    return joined.select(*keys, time, *[F.col(c).cast("double").alias(c) for c in measures])


def filled_features(
    features: DataFrame,
    seasonal: Sequence[str],
    *,
    end: Column,
    key: Keys = "series_key",
    time: str = "month",
    flag: bool = False,
) -> DataFrame:
    """Extend each series to ``end``, then :func:`fill_aligned`."""
    return fill_aligned(calendar.align(features, key, time, end=end), seasonal, key, time, flag=flag)


def fill_aligned(
    df: DataFrame, seasonal: Sequence[str], key: Keys = "series_key", time: str = "month", *, flag: bool = False
) -> DataFrame:
    """Fill seasonal columns from earlier years, then carry every column forward.

    ``flag`` adds ``is_imputed`` for rows in which anything was filled.
    """
    keys = as_list(key)
    measures = [c for c in df.columns if c not in (*keys, time)]
    if flag:
        gap = F.col(measures[0]).isNull()
        for c in measures[1:]:
            gap = gap | F.col(c).isNull()
        df = df.withColumn("is_imputed", gap)
    df = windows.seasonal_fill(df, seasonal, keys, time)
    return windows.forward_fill(df, measures, keys, time)


def future_features(
    features: DataFrame,
    target: DataFrame,
    lags: dict[str, int],
    seasonal: Sequence[str],
    *,
    start: Column,
    end: Column,
    key: Keys = "series_key",
    time: str = "month",
) -> DataFrame:
    """Lagged features of the months after each series' last target month, up to ``end``."""
    keys = as_list(key)
    filled = filled_features(features, seasonal, end=end, key=keys, time=time)
    lagged = windows.lag_map(filled, lags, keys, time, mode="positional")
    complete = lagged.filter(F.col(time) >= start).na.drop(how="any")
    last = target.groupBy(*keys).agg(F.max(time).alias("_last"))
    return complete.join(last, keys).filter(F.col(time) > F.col("_last")).drop("_last")


def offline_features(
    own: Sequence[DataFrame],
    shared: Sequence[DataFrame],
    target: DataFrame,
    lags: dict[str, int],
    seasonal: Sequence[str],
    *,
    start: Column,
    end: Column,
    key: Keys = "series_key",
    time: str = "month",
) -> tuple[DataFrame, DataFrame]:
    """(history with target, future rows) from an outer join that is filled before it is lagged.

    ``own`` drivers differ per series, ``shared`` ones are one row per month.
    The outer join of both, put on a calendar, is each series' calendar from the
    first month of any driver on, with the shared drivers joined by month: they
    are never copied per series.  History keeps rows whose drivers were filled;
    ``is_imputed`` marks them.
    """
    keys = as_list(key)
    per_series = joins.join_all(own, [*keys, time], "full")
    by_month = joins.join_all(shared, time, "full")
    begin = by_month.agg(F.min(time)).scalar()
    aligned = calendar.align(per_series.withColumn("_begin", begin), keys, time, start=F.col("_begin"), end=end)
    joined = joins.at_month(aligned.drop("_begin"), by_month, "left", time)
    filled = fill_aligned(joined, seasonal, keys, time, flag=True)
    lagged = windows.lag_map(filled, lags, keys, time, mode="positional", keep=["is_imputed"])
    complete = lagged.filter(F.col(time) >= start).na.drop(how="any")
    history = complete.join(target, [*keys, time], "inner")
    last = target.groupBy(*keys).agg(F.max(time).alias("_last"))
    future = complete.join(last, keys).filter(F.col(time) > F.col("_last")).drop("_last")
    return history, future


def transformed(df: DataFrame, log_columns: Sequence[str] = ()) -> DataFrame:
    """Natural logarithm of the chosen columns, identity by default."""
    return df.withColumns({c: numeric.safe_ln(c) for c in log_columns}) if log_columns else df
