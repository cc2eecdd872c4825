"""Expanding-window folds, naive forecasts and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidetable.functions import numeric
from tidetable.operators import stats, windows
from tidetable.operators.panel import Keys, as_list, series_window


def check_fold_arguments(initial_window: int, horizon: int, n_samples: int | None = None) -> None:
    if n_samples is not None and n_samples <= 0:
        raise ValueError("n_samples must be positive")
    if initial_window <= 0:
        raise ValueError("initial_window must be positive")
    if horizon <= 0:
        raise ValueError("horizon must be positive")
    if n_samples is not None and initial_window + horizon > n_samples:
        raise ValueError("initial_window + horizon must not exceed n_samples")


def fold_table(
    df: DataFrame, key: Keys = "series_key", *, initial_window: int = 60, horizon: int = 1
) -> DataFrame:
    """(series, fold, train_end): fold trains on rows 1..train_end and tests the next ``horizon``.

    Series that are too short give no fold; see :func:`row_counts`.
    """
    check_fold_arguments(initial_window, horizon)
    counts = df.groupBy(*as_list(key)).agg(F.count(F.lit(1)).alias("_n"))
    ends = F.sequence(F.lit(initial_window), (F.col("_n") - horizon).cast("int"))
    return (
        counts.filter(F.col("_n") >= initial_window + horizon)
        .select(*as_list(key), F.posexplode(ends).alias("_i", "train_end"))
        .select(*as_list(key), (F.col("_i") + 1).alias("fold"), "train_end")
    )


def row_counts(df: DataFrame, key: Keys = "series_key", *, minimum: int = 61) -> DataFrame:
    """Rows per series and whether there are enough of them to back-test."""
    return (
        df.groupBy(*as_list(key))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("is_excluded", F.col("n_rows") < minimum)
    )


def test_rows(
    df: DataFrame,
    key: Keys = "series_key",
    time: str = "month",
    *,
    initial_window: int = 60,
    horizon: int = 1,
) -> DataFrame:
    """Each row once per fold that tests it, with fold, step and train_end.

    A row at position ``rn`` is step ``s`` of the fold that trains on ``rn - s``
    rows.  This is the range join of rows and folds solved for the fold number:
    at most ``horizon`` copies of a row, where joining training rows would give
    the square of the series length.
    """
    check_fold_arguments(initial_window, horizon)
    keys = as_list(key)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return (
        df.withColumn("_rn", F.row_number().over(series_window(keys, time)))
        .withColumn("_n", n)
        .withColumn("step", steps)
        .withColumn("train_end", F.col("_rn") - F.col("step"))
        .filter((F.col("train_end") >= initial_window) & (F.col("train_end") <= F.col("_n") - horizon))
        .withColumn("fold", F.col("train_end") - initial_window + 1)
        .drop("_rn", "_n")
    )


def naive_backtest(
    df: DataFrame,
    value: str,
    key: Keys = "series_key",
    time: str = "month",
    *,
    season: int = 12,
    initial_window: int = 60,
    horizon: int = 1,
) -> DataFrame:
    """Naive and seasonal-naive forecasts of every fold and step, as offsets of the series.

    The forecast is fixed per fold, so step ``s`` reads ``s`` rows back (naive)
    or ``season + s - 1`` rows back (seasonal).
    """
    w = series_window(key, time)
    keys = as_list(key)
    offsets = [
        F.struct(F.lag(value, s).over(w).alias("last"), F.lag(value, season + s - 1).over(w).alias("year"))
        for s in range(1, horizon + 1)
    ]
    rows = test_rows(
        df.select(*keys, time, value, F.array(*offsets).alias("_past")),
        keys,
        time,
        initial_window=initial_window,
        horizon=horizon,
    )
    past = F.element_at("_past", F.col("step"))
    models = F.array(
        F.struct(F.lit("naive").alias("model"), past["last"].alias("prediction")),
        F.struct(F.lit("seasonal_naive").alias("model"), past["year"].alias("prediction")),
    )
    return rows.select(*keys, "fold", "step", time, F.col(value).alias("actual"), F.inline(models))


def compare_models(
    predictions: DataFrame,
    key: Keys = "series_key",
    *,
    order: Sequence[str] = ("fold", "step"),
    common_only: bool = False,
    time: str = "month",
) -> DataFrame:
    """Scores and fold count per series and model.

    ``common_only`` keeps the periods that every model of the series predicted,
    since scores over different periods must not be ranked against each other.
    """
    keys = as_list(key)
    if common_only:
        predictions = common_periods(predictions, keys, time)
    # a series has no more folds than months, so the set stays small
    folds = F.size(F.collect_set("fold")).alias("n_folds")
    return stats.scores(predictions, [*keys, "model"], list(order), extra=[folds])


def common_periods(predictions: DataFrame, key: Keys = "series_key", time: str = "month") -> DataFrame:
    """Rows of the periods for which every model of the series has a forecast.

    Both windows start with the series key, so they share one exchange.
    """
    keys = as_list(key)
    usable = predictions.filter(F.col("prediction").isNotNull() & F.col("actual").isNotNull())
    models = F.size(F.collect_set("model").over(Window.partitionBy(*keys)))
    here = F.size(F.collect_set("model").over(Window.partitionBy(*keys, time)))
    return usable.withColumns({"_all": models, "_here": here}).filter(F.col("_all") == F.col("_here")).drop("_all", "_here")


def predictions_wide(
    predictions: DataFrame, models: Sequence[str], key: Keys = "series_key", time: str = "month"
) -> DataFrame:
    """One column per model and one row per period, beside the mean actual; one group-by for all."""
    by_model = [F.avg(F.when(F.col("model") == m, F.col("prediction"))).alias(m) for m in models]
    return predictions.groupBy(*as_list(key), time).agg(F.avg("actual").alias("actual"), *by_model)


def average_predictions(predictions: DataFrame, by: Keys) -> DataFrame:
    """Mean actual and prediction where several rows share a period."""
    return predictions.groupBy(*as_list(by)).agg(
        F.avg("actual").alias("actual"), F.avg("prediction").alias("prediction")
    )


def impute_drivers(
    df: DataFrame,
    seasonal: Sequence[str],
    carried: Sequence[str],
    key: Keys = "series_key",
    time: str = "month",
    *,
    season: int = 12,
    suffix: str = "_imputed",
) -> DataFrame:
    """What each driver would be taken for if its own month were unknown.

    Seasonal drivers take the value one season earlier, carried ones the last
    earlier value.
    """
    before = series_window(key, time).rowsBetween(Window.unboundedPreceding, -1)
    columns = {f"{c}{suffix}": windows.calendar_lag(c, season, key, time) for c in seasonal}
    columns |= {f"{c}{suffix}": F.last(c, ignorenulls=True).over(before) for c in carried}
    return df.withColumns(columns)


def imputation_gap(df: DataFrame, columns: Sequence[str], *, suffix: str = "_imputed") -> DataFrame:
    """Difference and percent difference that imputation makes."""
    gaps = {}
    for c in columns:
        gaps[f"{c}_diff"] = F.col(f"{c}{suffix}") - F.col(c)
        gaps[f"{c}_pct"] = numeric.ratio(F.col(f"{c}{suffix}") - F.col(c), c) * 100
    return df.withColumns(gaps)
