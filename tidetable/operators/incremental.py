"""Compare-and-merge steps of recurring loads, in batch form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.operators.panel import Keys, as_list, keep_last
from tidetable.session import broadcast_if_small


def fresh_rows(source: DataFrame, target: DataFrame, key: Keys = "series_key", time: str = "month") -> DataFrame:
    """Source rows newer than the newest stored period of their own series."""
    keys = as_list(key)
    stored = target.groupBy(*keys).agg(F.max(time).alias("_stored"))
    return (
        source.join(broadcast_if_small(stored), keys, "left")
        .filter(F.col("_stored").isNull() | (F.col(time) > F.col("_stored")))
        .drop("_stored")
    )


def new_periods(source: DataFrame, target: DataFrame, key: Keys = "series_key", time: str = "month") -> DataFrame:
    """(series, period) pairs of the source that the target does not hold yet."""
    on = [*as_list(key), time]
    return source.select(*on).distinct().join(target.select(*on).distinct(), on, "left_anti")


def upsert(existing: DataFrame, new: DataFrame, on: Keys, order: Keys = "load_seq") -> DataFrame:
    """Merge by key; the row with the highest ``order`` wins, other stored rows stay."""
    return keep_last(existing.unionByName(new), on, order)


def newest_period(df: DataFrame, key: Keys = (), time: str = "month") -> DataFrame:
    """Only the rows of the newest period (of each series, or of the whole table).

    A small maximum is joined back, so no series is ranked in one task.
    """
    keys = as_list(key)
    if keys:
        newest = df.groupBy(*keys).agg(F.max(time).alias(time))
        return df.join(broadcast_if_small(newest), [*keys, time], "left_semi")
    return df.join(F.broadcast(df.agg(F.max(time).alias(time))), time, "left_semi")


def overlap(left: DataFrame, right: DataFrame, key: Keys = (), time: str = "month") -> DataFrame:
    """Periods present in both inputs; empty means there is nothing to run."""
    on = [*as_list(key), time]
    return left.select(*on).intersect(right.select(*on))


def latest_common(left: DataFrame, right: DataFrame, key: Keys = "series_key", time: str = "month") -> DataFrame:
    return overlap(left, right, key, time).groupBy(*as_list(key)).agg(F.max(time).alias("latest_common"))


def missing_inputs(required: DataFrame, available: DataFrame, on: Keys) -> DataFrame:
    """Required (dataset, partition) pairs that are not there; empty means ready."""
    on = as_list(on)
    return required.select(*on).distinct().join(available.select(*on).distinct(), on, "left_anti")


def is_ready(required: DataFrame, available: DataFrame, on: Keys) -> bool:
    return missing_inputs(required, available, on).isEmpty()


def replace_periods(existing: DataFrame, snapshot: DataFrame, period: Keys, covered: Column | None = None) -> DataFrame:
    """A cumulative snapshot replaces every stored row of the periods it covers.

    ``covered`` is a condition on stored rows; a covered period that the snapshot leaves empty is empty afterwards.
    Without it the snapshot covers the periods that it has rows of.
    """
    on = as_list(period)
    if covered is not None:
        return existing.filter(~F.coalesce(covered, F.lit(False))).unionByName(snapshot)
    kept = existing.join(broadcast_if_small(snapshot.select(*on).distinct()), on, "left_anti")
    return kept.unionByName(snapshot)


def settle(rows: DataFrame, on: Keys, *, forecast: str = "forecast", order: str = "load_seq") -> DataFrame:
    """One row per key: an actual beats a forecast, then the newest arrival wins."""
    ranked = rows.withColumn("_actual", (~F.col(forecast)).cast("int"))
    return keep_last(ranked, on, ["_actual", order]).drop("_actual")
