"""Panel basics: keys, windows, required columns, one row per period."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

Keys = str | Sequence[str]


def as_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def series_window(key: Keys = "series_key", time: str = "month") -> WindowSpec:
    """Time order within a series.

    All window operators use this one specification, so a chain of them shares
    a single exchange and sort.
    """
    return Window.partitionBy(*as_list(key)).orderBy(F.col(time).asc_nulls_first())


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df`` itself, or a ValueError naming the missing columns before any job runs."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}; present: {df.columns}")
    return df


def present_columns(
    df: DataFrame, preferred: Iterable[str], context: str = "", required: bool = False
) -> list[str]:
    """The preferred columns that exist, in the preferred order."""
    found = [c for c in preferred if c in df.columns]
    if required and not found:
        raise ValueError(f"none of the wanted columns exist {context}".rstrip())
    return found


def column_report(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Whether each wanted column exists, and how many values it holds: one row for each name."""
    found = present_columns(df, wanted)
    counts = df.agg(F.struct(*[F.count(c).alias(c) for c in found], F.lit(0).alias("_")).alias("_n"))
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(c in found).alias("is_present"), (F.col("_n")[c] if c in found else F.lit(0)).cast("long").alias("n_values"))
        for c in wanted
    ]
    return counts.select(F.inline(F.array(*rows)))


def columns_with_prefix(df: DataFrame, prefixes: Iterable[str], exclude: Iterable[str] = ()) -> list[str]:
    """Columns that start with one of the prefixes, e.g. every lagged driver."""
    wanted, skipped = tuple(prefixes), set(exclude)
    return [c for c in df.columns if c.startswith(wanted) and c not in skipped]


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename by name; names that do not exist raise instead of being skipped."""
    require_columns(df, names)
    return df.withColumnsRenamed(names)


def drop_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def insert_first(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A new first column."""
    return df.select(value.alias(name), "*")


def keep_last(df: DataFrame, keys: Keys, order: Keys) -> DataFrame:
    """One row per key, the last by ``order``.

    Written as an aggregate, not as ``row_number``: copies are dropped before the
    shuffle, so a key with very many copies does not land in one task.
    """
    keys, order = as_list(keys), as_list(order)
    rest = [c for c in df.columns if c not in keys]
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def latest_per_series(df: DataFrame, key: Keys = "series_key", time: str = "month") -> DataFrame:
    """The newest row of each series."""
    return keep_last(df, key, time)


def first_after(df: DataFrame, point: Column, key: Keys = "series_key", time: str = "month") -> DataFrame:
    """The earliest row of each series later than ``point``."""
    keys = as_list(key)
    rest = [c for c in df.columns if c not in keys]
    picked = (
        df.filter(F.col(time) > point)
        .groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.col(time)).alias("_row"))
    )
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
