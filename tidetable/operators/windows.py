"""Offsets, fills, interpolation and row picks in time order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidetable.functions import dates, numeric
from tidetable.operators.panel import Keys, as_list, require_columns, series_window


def calendar_lag(column: str, k: int, key: Keys = "series_key", time: str = "month") -> Column:
    """Value exactly ``k`` months earlier (later when negative), NULL when that month is absent.

    A range frame over the month number looks up the month itself, so gaps do
    not shift the lag and no spine is needed.
    """
    order = dates.month_number(time)
    w = Window.partitionBy(*as_list(key)).orderBy(order).rangeBetween(-k, -k)
    return F.max(column).over(w)


def positional_lag(column: str, k: int, key: Keys = "series_key", time: str = "month") -> Column:
    """Value ``k`` rows earlier."""
    return F.lag(column, k).over(series_window(key, time))


def _lag(column: str, k: int, key: Keys, time: str, mode: str) -> Column:
    if k == 0:
        return F.col(column)
    if mode == "calendar":
        return calendar_lag(column, k, key, time)
    if mode == "positional":
        return positional_lag(column, k, key, time)
    raise ValueError(f"unknown lag mode {mode!r}")


def lag_map(
    df: DataFrame,
    lags: dict[str, int],
    key: Keys = "series_key",
    time: str = "month",
    *,
    mode: str = "calendar",
    keep: Iterable[str] = (),
) -> DataFrame:
    """Each column by its own lag, named ``{column}_lag_{k}``."""
    require_columns(df, lags)
    return df.select(
        *as_list(key),
        time,
        *keep,
        *[_lag(c, k, key, time, mode).alias(f"{c}_lag_{k}") for c, k in lags.items()],
    )


def target_lags(
    df: DataFrame,
    target: str,
    lags: Sequence[int] = (1, 2, 3, 6, 12),
    key: Keys = "series_key",
    time: str = "month",
    *,
    mode: str = "positional",
) -> DataFrame:
    """Several lags of one column, added as ``{target}_lag_{k}``."""
    return df.withColumns({f"{target}_lag_{k}": _lag(target, k, key, time, mode) for k in lags})


def lags_from_table(
    df: DataFrame, lag_table: DataFrame, key: Keys = "series_key", time: str = "month"
) -> DataFrame:
    """Long form lags: ``df`` is (key, time, feature, value), ``lag_table`` (feature, lag[, key]).

    The value moves forward on the calendar, so the row is renamed, not joined
    back: one equi-join on the feature, no self-join.
    """
    from tidetable.session import broadcast_if_small

    shared = [c for c in as_list(key) if c in lag_table.columns] + ["feature"]
    return df.join(broadcast_if_small(lag_table), shared, "inner").select(
        *as_list(key),
        F.add_months(time, F.col("lag").cast("int")).alias(time),
        F.concat_ws("_lag_", "feature", F.col("lag").cast("string")).alias("feature"),
        "value",
    )


def difference(
    df: DataFrame, columns: Iterable[str], key: Keys = "series_key", time: str = "month", *, suffix: str = "_diff"
) -> DataFrame:
    """Change against the previous row."""
    w = series_window(key, time)
    return df.withColumns({f"{c}{suffix}": F.col(c) - F.lag(c).over(w) for c in columns})


def seasonal_fill(
    df: DataFrame,
    columns: Iterable[str],
    key: Keys = "series_key",
    time: str = "month",
    *,
    season: int = 12,
    passes: int = 2,
) -> DataFrame:
    """Fill from the same month of earlier years; ``df`` must be on a regular calendar.

    ``passes`` repeated fills by one season equal the first value found one to
    ``passes`` seasons back.
    """
    w = series_window(key, time)
    return df.withColumns(
        {c: F.coalesce(c, *[F.lag(c, season * p).over(w) for p in range(1, passes + 1)]) for c in columns}
    )


def forward_fill(
    df: DataFrame, columns: Iterable[str], key: Keys = "series_key", time: str = "month"
) -> DataFrame:
    """Carry the last known value forward."""
    w = series_window(key, time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def interpolate(
    df: DataFrame, columns: Iterable[str], key: Keys = "series_key", time: str = "month"
) -> DataFrame:
    """Straight line across inner gaps, last value held after the end, leading gaps left NULL.

    Rows count as equally spaced, so ``df`` must be on a regular calendar.
    """
    w = series_window(key, time)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # looking ahead is looking back in reverse order: a growing frame costs one step per row
    ahead = (
        Window.partitionBy(*as_list(key))
        .orderBy(F.col(time).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    columns = list(columns)
    numbered = df.withColumn("_rn", F.row_number().over(w))
    left, right = {}, {}
    for i, c in enumerate(columns):
        place = F.when(F.col(c).isNotNull(), F.col("_rn"))
        left |= {f"_v0{i}": F.last(c, True).over(back), f"_n0{i}": F.last(place, True).over(back)}
        right |= {f"_v1{i}": F.last(c, True).over(ahead), f"_n1{i}": F.last(place, True).over(ahead)}
    filled = {}
    for i, c in enumerate(columns):
        v0, n0, v1, n1 = (F.col(f"{p}{i}") for p in ("_v0", "_n0", "_v1", "_n1"))
        line = v0 + (v1 - v0) * ((F.col("_rn") - n0) / F.nullif(n1 - n0, F.lit(0)))
        filled[c] = F.coalesce(F.col(c), line, v0)
    return numbered.withColumns(left).withColumns(right).withColumns(filled).select(*df.columns)


def number_rows(
    df: DataFrame, key: Keys = "series_key", time: str = "month", *, name: str = "row_no"
) -> DataFrame:
    """1, 2, ... in time order."""
    return df.withColumn(name, F.row_number().over(series_window(key, time)))


def expanding(
    df: DataFrame,
    aggregates: dict[str, Column],
    key: Keys = "series_key",
    time: str = "month",
    *,
    until: int = 1,
) -> DataFrame:
    """Aggregates over all rows at least ``until`` before the current one."""
    w = series_window(key, time).rowsBetween(Window.unboundedPreceding, -until)
    return df.withColumns({name: agg.over(w) for name, agg in aggregates.items()})


def peak_rows(df: DataFrame, value: str, key: Keys) -> DataFrame:
    """Rows whose absolute value is the largest of their group; ties all stay."""
    size = F.abs(F.col(value))
    return (
        df.withColumn("_peak", F.max(size).over(Window.partitionBy(*as_list(key))))
        .filter(size == F.col("_peak"))
        .drop("_peak")
    )


def every_nth(df: DataFrame, n: int, key: Keys = "series_key", time: str = "month") -> DataFrame:
    """Rows 1, n+1, 2n+1, ... of each series."""
    numbered = number_rows(df, key, time, name="_rn")
    return numbered.filter((F.col("_rn") - 1) % n == 0).drop("_rn")


def last_n(df: DataFrame, n: int, key: Keys = "series_key", time: str = "month") -> DataFrame:
    """The newest ``n`` rows of each series; Spark limits each group before the shuffle."""
    w = Window.partitionBy(*as_list(key)).orderBy(F.col(time).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def change_from_previous(
    df: DataFrame,
    value: str,
    key: Keys = "series_key",
    time: str = "month",
    *,
    digits: int = 1,
    name: str = "change_pct",
) -> DataFrame:
    """Percent change against the previous point, 0 where there is none or it is 0."""
    previous = F.lag(value).over(series_window(key, time))
    return df.withColumn(name, F.coalesce(numeric.pct_change(F.col(value), previous, digits), F.lit(0.0)))


def spread_points(df: DataFrame, k: int, key: Keys = "series_key", time: str = "month") -> DataFrame:
    """About ``k`` evenly spaced rows of each series, ends included, none twice."""
    if k < 2:
        raise ValueError("k must be at least 2")
    keys = as_list(key)
    w = series_window(keys, time)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    marks = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.round(i * (F.col("_n") - 1) / (k - 1)).cast("int"))
    return (
        df.withColumn("_n", n)
        .withColumn("_rn", F.row_number().over(w) - 1)
        .filter(F.array_contains(F.array_distinct(marks), F.col("_rn")))
        .drop("_n", "_rn")
    )
