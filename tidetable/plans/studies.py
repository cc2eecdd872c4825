"""Lag study, correlation overview and lag-effect peaks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidetable.operators import joins, stationarity, stats, windows
from tidetable.operators.panel import Keys, as_list
from tidetable.operators.reshape import recode


def lag_study(
    df: DataFrame,
    target: str,
    lagged: Sequence[str],
    crossed: Sequence[str] = (),
    key: Keys = "series_key",
    time: str = "month",
    *,
    max_lag: int = 12,
    digits: int = 4,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    difference: str = "test",
) -> DataFrame:
    """Correlation of the target with every driver at lags 0..max_lag.

    Each series of each column is differenced when its own unit-root test does
    not reject, so the choice is made per series on the cluster, not in the
    driver; ``difference`` may also be ``always`` or ``never``.  ``crossed`` columns use the whole-sample form with the driver
    leading, ``lagged`` ones the Pearson form.
    """
    keys = as_list(key)
    columns = [target, *lagged, *crossed]
    df = (transform(df) if transform else df).select(*keys, time, *columns).na.drop(how="any")
    if difference == "test":
        long = df.unpivot([*keys, time], columns, "_column", "_value")
        verdicts = stationarity.stationarity(long, "_value", [*keys, "_column"], time)
        level = verdicts.groupBy(*keys).agg(
            *[F.max(F.when(F.col("_column") == c, F.col("is_stationary"))).alias(f"_level_{c}") for c in columns]
        )
        # the differences share the exchange of the lags; only the verdicts are joined in
        changed = windows.difference(df, columns, keys, time, suffix="_change").join(level, keys)
        prepared = changed.select(
            *keys,
            time,
            *[F.when(F.coalesce(f"_level_{c}", F.lit(False)), F.col(c)).otherwise(F.col(f"{c}_change")).alias(c) for c in columns],
        )
    elif difference == "always":
        prepared = windows.difference(df, columns, keys, time, suffix="")
    elif difference == "never":
        prepared = df
    else:
        raise ValueError(f"unknown choice of differences {difference!r}")
    parts = []
    if lagged:
        parts.append(
            stats.lag_correlation(prepared, target, lagged, keys, time, max_lag=max_lag, digits=digits)
            .withColumn("method", F.lit("pearson"))
        )
    if crossed:
        parts.append(
            stats.cross_correlation(prepared, target, crossed, keys, time, max_lag=max_lag, digits=digits)
            .withColumn("method", F.lit("cross_correlation"))
        )
    return joins.stack(parts)


def correlation_overview(
    target: DataFrame,
    drivers: Sequence[DataFrame],
    columns: Sequence[str],
    key: Keys = "series_key",
    time: str = "month",
) -> DataFrame:
    """Left-join the drivers to the target and correlate complete rows per series.

    Drivers must be one row per series and month: aggregate partners first, or
    the join repeats target rows.
    """
    keys = as_list(key)
    joined = joins.join_all([target, *drivers], [*keys, time], "left")
    return stats.correlation_matrix(joined, columns, keys)


def normalized_overlay(
    target: DataFrame,
    drivers: Sequence[DataFrame],
    columns: Sequence[str],
    key: Keys = "series_key",
    time: str = "month",
) -> DataFrame:
    keys = as_list(key)
    joined = joins.join_all([target, *drivers], [*keys, time], "left")
    return stats.min_max(joined, columns, keys)


def lag_peaks(
    wide: DataFrame, variables: Sequence[str], labels: dict[str, str], key: Keys = "series_key"
) -> DataFrame:
    """From one row per lag and one column per variable to the peak lags of each variable."""
    keys = as_list(key)
    long = wide.unpivot([*keys, "lag"], list(variables), "variable", "correlation")
    named = long.withColumn("variable", recode("variable", labels))
    return windows.peak_rows(named, "correlation", [*keys, "variable"])
