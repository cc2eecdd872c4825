from datetime import date

import pytest
from helpers import column, months, series
from pyspark.sql import functions as F

from tidetable.operators import calendar, panel, windows


def test_calendar_lag_skips_gaps_and_positional_lag_does_not(spark):
    df = series(spark, [1.0, ..., 3.0, 4.0])
    assert column(windows.lag_map(df, {"x": 1}), "x_lag_1") == [None, None, 3.0]
    assert column(windows.lag_map(df, {"x": 1}, mode="positional"), "x_lag_1") == [None, 1.0, 3.0]
    assert column(windows.lag_map(df, {"x": 0}), "x_lag_0") == [1.0, 3.0, 4.0]
    with pytest.raises(ValueError):
        windows.lag_map(df, {"x": 1}, mode="other")
    with pytest.raises(ValueError):
        windows.lag_map(df, {"absent": 1})


def test_align_equals_spine_join(spark):
    df = series(spark, [1.0, ..., ..., 4.0]).unionByName(series(spark, [7.0], key="b", start="2020-03"))
    by_join = calendar.spine(df).join(df, ["series_key", "month"], "left").select(*df.columns)
    assert sorted(map(tuple, calendar.align(df).collect())) == sorted(map(tuple, by_join.collect()), key=lambda r: r[:2])
    end = F.lit("2020-06-01").cast("date")
    longer = calendar.align(df, end=end)
    assert longer.count() == 6 + 4
    shorter = calendar.align(df, end=F.lit("2020-02-01").cast("date"))
    assert [r["month"] for r in shorter.collect()] == months("2020-01", 2)
    earlier = calendar.align(df, start=F.lit("2019-11-01").cast("date"))
    assert column(earlier, "x")[:4] == [None, None, 1.0, None]


def test_align_daily(spark):
    df = spark.createDataFrame([("a", date(2024, 2, 28), 1.0), ("a", date(2024, 3, 1), 2.0)], "series_key string, day date, x double")
    assert column(calendar.align(df, time="day", unit="day"), "x", "day") == [1.0, None, 2.0]


def test_seasonal_fill_reaches_two_seasons_and_no_further(spark):
    values = [float(i) for i in range(12)] + [None] * 36
    df = series(spark, values)
    filled = column(windows.seasonal_fill(df, ["x"]), "x")
    assert filled[12:36] == [float(i % 12) for i in range(24)]
    assert filled[36:] == [None] * 12


def test_forward_fill_and_all_null_column(spark):
    df = series(spark, [None, 1.0, None, 3.0, None]).withColumn("y", F.lit(None).cast("double"))
    out = windows.forward_fill(df, ["x", "y"])
    assert column(out, "x") == [None, 1.0, 1.0, 3.0, 3.0]
    assert column(out, "y") == [None] * 5


def test_interpolate_inner_gap_holds_the_end(spark):
    df = series(spark, [None, 1.0, None, None, 4.0, None])
    assert column(windows.interpolate(df, ["x"]), "x") == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_keep_last_uses_the_order_column(spark):
    rows = [("a", 1, 5.0), ("a", 3, None), ("a", 2, 7.0), ("b", 1, 1.0)]
    df = spark.createDataFrame(rows, "k string, load_seq int, v double")
    out = {r["k"]: (r["load_seq"], r["v"]) for r in panel.keep_last(df, "k", "load_seq").collect()}
    assert out == {"a": (3, None), "b": (1, 1.0)}


def test_picks(spark):
    df = series(spark, [float(i) for i in range(8)])
    assert column(windows.every_nth(df, 3), "x") == [0.0, 3.0, 6.0]
    assert column(windows.last_n(df, 2), "x") == [6.0, 7.0]
    assert column(windows.spread_points(df, 4), "x") == [0.0, 2.0, 5.0, 7.0]
    assert column(windows.spread_points(series(spark, [1.0]), 4), "x") == [1.0]
    assert column(panel.latest_per_series(df), "x") == [7.0]
    assert column(panel.first_after(df, F.lit("2020-03-01").cast("date")), "x") == [3.0]


def test_peak_rows_keep_ties(spark):
    df = spark.createDataFrame([("a", 0, 0.5), ("a", 1, -0.5), ("a", 2, 0.1)], "variable string, lag int, c double")
    assert sorted(r["lag"] for r in windows.peak_rows(df, "c", "variable").collect()) == [0, 1]


def test_change_from_previous_is_zero_without_or_on_zero(spark):
    df = series(spark, [0.0, 5.0, 6.0])
    assert column(windows.change_from_previous(df, "x"), "change_pct") == [0.0, 0.0, 20.0]


def test_continuity_and_horizon(spark):
    history = series(spark, [1.0, 2.0]).unionByName(series(spark, [1.0], key="b"))
    future = series(spark, [3.0, 4.0], start="2020-03")
    out = {r["series_key"]: r["is_continuous"] for r in calendar.continues(history, future).collect()}
    assert out == {"a": True, "b": False}
    d = lambda t: F.lit(t).cast("date")
    assert calendar.horizon_check(future, d("2020-03-01"), d("2020-04-01")).first()["is_current"]


def test_lags_from_table(spark):
    df = series(spark, [1.0, 2.0]).select("series_key", "month", F.lit("f").alias("feature"), F.col("x").alias("value"))
    lags = spark.createDataFrame([("f", 2)], "feature string, lag int")
    out = windows.lags_from_table(df, lags)
    assert column(out, "month") == months("2020-03", 2)
    assert set(column(out, "feature")) == {"f_lag_2"}
