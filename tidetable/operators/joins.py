"""Joins on series and period: aligned, as-of, lookup, override, and skew-safe roll-ups."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidetable.functions import dates
from tidetable.operators.panel import Keys, as_list
from tidetable.session import broadcast_if_small, fits_broadcast


def join_all(frames: Sequence[DataFrame], on: Keys, how: str = "inner") -> DataFrame:
    """Chain of equi-joins on the same columns (``inner``, ``left`` or ``full``).

    Equal keys all along let Spark keep one partitioning for the whole chain;
    ``full`` coalesces the keys of both sides.
    """
    on = as_list(on)
    return reduce(lambda a, b: a.join(b, on, how), frames)


def join_renamed(left: DataFrame, right: DataFrame, pairs: dict[str, str], how: str = "inner") -> DataFrame:
    """Join on differently named columns, keeping the left names."""
    return left.join(right.withColumnsRenamed({r: l for l, r in pairs.items()}), list(pairs), how)


def lookup(fact: DataFrame, dim: DataFrame, on: Keys, defaults: dict[str, object] | None = None) -> DataFrame:
    """Left join to a lookup table, with defaults for keys it does not hold.

    The table is broadcast only when its size was checked.
    """
    out = fact.join(broadcast_if_small(dim), as_list(on), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def map_codes(code: str | Column, labels: dict[str, str], default: str | None = None) -> Column:
    """A fixed code list as a map literal."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    found = F.create_map(*pairs)[F.col(code) if isinstance(code, str) else code]
    return found if default is None else F.coalesce(found, F.lit(default))


def roll_up(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, dict[str, str]]],
    by: Iterable[str],
    sums: dict[str, Column],
) -> DataFrame:
    """``sum`` of fact measures by columns of the fact and of its dimensions.

    ``dims`` pairs each dimension with {fact key: dimension key} (unique there),
    ``by`` lists grouping columns of any side, ``sums`` gives additive measures.

    Dimensions whose size was checked to be small are broadcast, so raw rows are
    not shuffled for them.  Before a join with any other dimension the fact is
    summed by its keys and grouping columns: a key that holds a third of all rows
    shrinks to one row per group, so no join task receives it whole.
    """
    by = list(by)
    rows = fact.withColumns({f"_sum_{n}": m for n, m in sums.items()})
    pruned = [
        (dim.select(*dict.fromkeys([*on.values(), *[c for c in by if c in dim.columns]])), on) for dim, on in dims
    ]
    small = [(d, on) for d, on in pruned if fits_broadcast(d)]
    large = [(d, on) for d, on in pruned if not any(d is s for s, _ in small)]
    for dim, on in small:
        rows = rows.join(F.broadcast(dim), _matches(rows, dim, on), "inner")
    for i, (dim, on) in enumerate(large):
        keys = [k for _, later in large[i:] for k in later]
        group = dict.fromkeys([*keys, *[c for c in by if c in rows.columns]])
        rows = rows.groupBy(*group).agg(*[F.sum(f"_sum_{n}").alias(f"_sum_{n}") for n in sums])
        rows = rows.join(dim, _matches(rows, dim, on), "inner")
    return rows.groupBy(*by).agg(*[F.sum(f"_sum_{n}").alias(n) for n in sums])


def _matches(left: DataFrame, right: DataFrame, on: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in on.items()])


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    how: str = "inner",
    *,
    salts: int = 32,
    hot_share: float = 0.01,
) -> DataFrame:
    """Equi-join that spreads hot keys of the left side over ``salts`` tasks.

    A frequent-items sketch finds the keys above ``hot_share`` of all left rows
    in one pass without a shuffle; there are at most ``1 / hot_share`` of them,
    so their hashes come back as one short list.  Without hot keys the join is a
    plain one.  Left rows of a hot key get a salt from a hash of the row and of its
    partition, which a repeated task computes alike and which parts copies of one
    row that stand in different partitions; right rows of a hot key are copied once per
    salt.  All other keys keep salt 0, so a key the sketch wrongly lists or
    misses changes the speed only.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins can be salted on the left side")
    on = as_list(on)
    if [left.schema[c].dataType for c in on] != [right.schema[c].dataType for c in on]:
        raise ValueError("salted keys must have the same types on both sides")
    most = int(1 / hot_share)
    key = F.xxhash64(*on)
    found = left.select(key.alias("_k")).agg(
        F.expr(f"approx_top_k(_k, {most}, {most * 100})").alias("top"), F.count(F.lit(1)).alias("n")
    )
    one = found.first()
    hot = [t["item"] for t in one["top"] or [] if t["count"] > one["n"] * hot_share]
    if not hot:
        return left.join(right, on, how)
    row_salt = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
    left = left.withColumn("_salt", F.when(key.isin(hot), row_salt).otherwise(F.lit(0)))
    copies = F.when(key.isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn("_salts", copies).withColumn("_salt", F.explode("_salts")).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def as_of(
    left: DataFrame,
    reference: DataFrame,
    value: Keys,
    by: Keys,
    time: str = "month",
    *,
    unique_left: bool = False,
    skip_null_values: bool = False,
) -> DataFrame:
    """Latest reference row at or before each left period (a backward as-of join per key), all its values together.

    With ``skip_null_values`` each value comes from the latest row in which it is not NULL.

    Both sides are stacked and a running ``last`` carries the values forward;
    linear, where an inequality join is quadratic inside a key.  With
    ``unique_left`` the left side has at most one row per (by, time) and is
    stacked as it is, with one exchange.  Without it only its distinct periods
    are stacked, so the window stays bounded by the calendar however many rows
    share a key, and the values return by an equi-join.

    A reference without keys goes through :func:`as_of_calendar`.
    """
    values, by = as_list(value), as_list(by)
    if not by:
        raise ValueError("a reference without keys needs as_of_calendar")
    if unique_left:
        return _carry(left, reference, values, by, time, skip_null_values)
    carried = _carry(left.select(*by, time).distinct(), reference, values, by, time, skip_null_values)
    return left.join(carried, [*by, time], "left")


def _carry(left: DataFrame, reference: DataFrame, values: list[str], by: list[str], time: str, skip: bool) -> DataFrame:
    from_left = left.withColumn("_side", F.lit(1))
    # a struct is not NULL even if its fields are, so a row is carried whole
    carried = {f"_v{i}": F.col(v) for i, v in enumerate(values)} if skip else {"_v": F.struct(*values)}
    from_right = reference.select(*by, time, *(c.alias(n) for n, c in carried.items())).withColumn("_side", F.lit(0))
    stacked = from_left.unionByName(from_right, allowMissingColumns=True)
    w = (
        Window.partitionBy(*by)
        .orderBy(time, "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    latest = stacked.withColumns({n: F.last(n, ignorenulls=True).over(w) for n in carried})
    out = latest.filter(F.col("_side") == 1).drop("_side")
    return out.withColumns({v: F.col(f"_v{i}") if skip else F.col("_v")[v] for i, v in enumerate(values)}).drop(*carried)


def as_of_calendar(left: DataFrame, reference: DataFrame, value: str, time: str = "month") -> DataFrame:
    """As-of join to one monthly reference shared by all series.

    The reference is one row per month, so its values fit one array, with gaps
    carried forward, and each left row reads its element by month number.  The
    left side is neither shuffled nor read twice.
    """
    known = reference.filter(F.col(value).isNotNull()).select(dates.month_number(time).alias("_m"), F.col(value).alias("_v"))
    one = known.agg(
        F.min("_m").alias("first"), F.array_sort(F.collect_list(F.struct("_m", "_v"))).alias("points")
    )
    # each point covers the months up to the next one; the last one is open-ended
    spread = F.flatten(
        F.transform(
            "points",
            lambda p, i: F.array_repeat(
                p["_v"], F.coalesce(F.get(F.col("points"), i + 1)["_m"] - p["_m"], F.lit(1)).cast("int")
            ),
        )
    )
    lookup_array = one.select(F.struct("first", spread.alias("values"))).scalar()
    rows = left.withColumn("_ref", lookup_array)
    place = F.least(dates.month_number(time) - F.col("_ref.first"), F.size("_ref.values") - 1)
    return rows.withColumn(value, F.when(place >= 0, F.get("_ref.values", place))).drop("_ref")


def at_month(left: DataFrame, monthly: DataFrame, how: str = "inner", time: str = "month") -> DataFrame:
    """Join of a large table to one row per month, by exact month and without moving the large table.

    The monthly rows are a calendar's length, so they fit one array, and each left row reads its element by month
    number.  ``left`` keeps rows of other months with NULL values, ``inner`` drops them.  A month that occurs twice fails
    the job.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"at_month cannot do a {how} join")
    values = [c for c in monthly.columns if c != time]
    points = monthly.filter(F.col(time).isNotNull()).select(dates.month_number(time).alias("m"), F.struct(*values).alias("v"))
    one = points.agg(
        F.min("m").alias("first"),
        F.max("m").alias("last"),
        F.map_from_entries(F.collect_list(F.struct("m", "v"))).alias("by_month"),  # twice the same key is an error
    )
    dense = F.transform(F.sequence("first", "last"), lambda m: F.try_element_at("by_month", m))
    lookup = one.select(F.struct("first", F.when(F.col("first").isNotNull(), dense).alias("rows"))).scalar()
    found = F.get(F.col("_at.rows"), (dates.month_number(time) - F.col("_at.first")).cast("int"))
    rows = left.withColumn("_at", lookup).withColumn("_row", found)
    if how == "inner":
        rows = rows.filter(F.col("_row").isNotNull())
    return rows.withColumns({v: F.col("_row")[v] for v in values}).drop("_at", "_row")


def require_matched(df: DataFrame, column: str, message: str) -> DataFrame:
    """Fail the job on the first row whose ``column`` stayed NULL."""
    checked = F.when(F.col(column).isNotNull(), F.col(column)).otherwise(
        F.raise_error(F.lit(message)).cast(df.schema[column].dataType)
    )
    return df.withColumn(column, checked)


def with_base(
    index: DataFrame, value: str, base: Column, by: Keys = (), time: str = "month", *, name: str = "base"
) -> DataFrame:
    """Add the value at the base period to every row of an index; without one the job fails.

    An index has one row per period (and group), so its window is bounded by the
    calendar, and the index is read once.
    """
    w = Window.partitionBy(*as_list(by))
    out = index.withColumn(name, F.max(F.when(F.col(time) == base, F.col(value))).over(w))
    return require_matched(out, name, "no index at the base period")


def override(preferred: DataFrame, other: DataFrame, on: Keys) -> DataFrame:
    """All preferred rows, plus the other rows whose key has no preferred row."""
    rest = other.join(preferred.select(*as_list(on)), as_list(on), "left_anti")
    return preferred.unionByName(rest, allowMissingColumns=True)


def restrict_to_common(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """Left rows whose key occurs on the right."""
    return left.join(right.select(*as_list(on)), as_list(on), "left_semi")


def fill_from(first: DataFrame, second: DataFrame, on: Keys) -> DataFrame:
    """Full join of two tables with the same columns, the first table's values winning."""
    on = as_list(on)
    values = [c for c in first.columns if c not in on]
    b = second.withColumnsRenamed({c: f"_b_{c}" for c in values})
    return first.join(b, on, "full").select(*on, *[F.coalesce(c, f"_b_{c}").alias(c) for c in values])


def align_series(series: dict[str, DataFrame], on: Keys, value: str) -> DataFrame:
    """Several series side by side on the union of their periods, one column each."""
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [df.select(*as_list(on), F.col(value), F.lit(name).alias("_name")) for name, df in series.items()],
    )
    return stacked.groupBy(*as_list(on)).pivot("_name", list(series)).agg(F.first(value, ignorenulls=True))


def union_distinct_keys(frames: Sequence[DataFrame], on: Keys) -> DataFrame:
    return reduce(lambda a, b: a.union(b), [f.select(*as_list(on)) for f in frames]).distinct()


def common_keys(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    return left.select(*as_list(on)).intersect(right.select(*as_list(on)))


def keys_only_in(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    return left.select(*as_list(on)).distinct().join(right.select(*as_list(on)), as_list(on), "left_anti")


def stack(frames: Sequence[DataFrame], *, allow_missing: bool = False) -> DataFrame:
    """Union of all rows by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)

