import pytest
from helpers import column, month, series
from pyspark.sql import functions as F

from tidetable import session
from tidetable.operators import incremental, joins, panel


def test_as_of_same_month_matches_and_no_match_is_null(spark):
    left = series(spark, [1.0, 1.0, 1.0, 1.0]).drop("x")
    ref = spark.createDataFrame([("a", month("2020-02"), 10.0), ("a", month("2020-04"), 20.0)], "series_key string, month date, v double")
    for unique in (True, False):
        out = joins.as_of(left, ref, "v", "series_key", unique_left=unique)
        assert column(out, "v") == [None, 10.0, 10.0, 20.0]
    assert column(joins.as_of_calendar(left, ref.drop("series_key"), "v"), "v") == [None, 10.0, 10.0, 20.0]
    late = series(spark, [1.0], start="2021-07").drop("x")
    assert column(joins.as_of_calendar(late, ref.drop("series_key"), "v"), "v") == [20.0]
    doubled = left.unionByName(left)
    assert joins.as_of(doubled, ref, "v", "series_key").filter("v = 10").count() == 4
    with pytest.raises(ValueError):
        joins.as_of(left, ref, "v", [])


def test_as_of_takes_a_reference_row_whole(spark):
    left = spark.createDataFrame([("a", month("2020-03"))], "series_key string, month date")
    rows = [("a", month("2020-01"), 1.0, 10.0), ("a", month("2020-02"), None, 20.0)]
    ref = spark.createDataFrame(rows, "series_key string, month date, v double, w double")
    for unique in (True, False):
        whole = joins.as_of(left, ref, ["v", "w"], "series_key", unique_left=unique).first()
        assert (whole["v"], whole["w"]) == (None, 20.0)
        each = joins.as_of(left, ref, ["v", "w"], "series_key", unique_left=unique, skip_null_values=True).first()
        assert (each["v"], each["w"]) == (1.0, 20.0)


def test_require_matched_and_base_fail_the_job(spark):
    df = series(spark, [1.0, None])
    with pytest.raises(Exception, match="no value here"):
        joins.require_matched(df, "x", "no value here").collect()
    index = series(spark, [100.0, 110.0], name="cpi").drop("series_key")
    good = joins.with_base(index, "cpi", F.lit("2020-02-01").cast("date"))
    assert {r["base"] for r in good.collect()} == {110.0}
    with pytest.raises(Exception, match="base period"):
        joins.with_base(index, "cpi", F.lit("1999-01-01").cast("date")).collect()


def test_salted_join_keeps_every_row_of_a_hot_key(spark):
    left = spark.range(6000).select(F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).cast("bigint").alias("k"), "id")
    right = spark.range(0, 6000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left"):
        plain = left.join(right, "k", how)
        salted = joins.salted_join(left, right, "k", how, salts=4)
        assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    hot = joins.salted_join(left.withColumnRenamed("id", "row"), right, "k", salts=4)
    assert "_salt" not in hot.columns
    with pytest.raises(ValueError):
        joins.salted_join(left, right.withColumn("k", F.col("k").cast("string")), "k")


def test_roll_up_gives_the_same_with_and_without_broadcast(spark, monkeypatch):
    fact = spark.range(2000).select(
        F.when(F.col("id") < 900, 1).otherwise(F.col("id") % 50).alias("p"), (F.col("id") % 7).alias("s"), F.lit(1).alias("one"), "id"
    )
    parts = spark.range(50).select(F.col("id").alias("pk"), (F.col("id") % 3).alias("brand"))
    suppliers = spark.range(5).select(F.col("id").alias("sk"), (F.col("id") % 2).alias("region"))
    dims = [(parts, {"p": "pk"}), (suppliers, {"s": "sk"})]
    sums = {"n": F.col("one"), "total": F.col("id")}
    small = sorted(map(tuple, joins.roll_up(fact, dims, ["brand", "region"], sums).collect()))
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    large = joins.roll_up(fact, dims, ["brand", "region"], sums)
    assert sorted(map(tuple, large.collect())) == small


def test_size_check(spark):
    assert session.fits_broadcast(spark.range(10))
    assert not session.fits_broadcast(spark.range(10**9).withColumn("x", F.lit("a" * 100)))


def test_override_fill_and_sets(spark):
    a = series(spark, [1.0, 2.0])
    b = series(spark, [9.0, 8.0], start="2020-02")
    assert column(joins.override(a, b, ["series_key", "month"]), "x") == [1.0, 2.0, 8.0]
    assert column(joins.fill_from(a, b, ["series_key", "month"]), "x") == [1.0, 2.0, 8.0]
    assert joins.common_keys(a, b, "month").count() == 1
    assert joins.keys_only_in(a, b, "month").count() == 1
    assert joins.union_distinct_keys([a, b], "month").count() == 3
    wide = joins.align_series({"a": a, "b": b}, "month", "x")
    assert sorted((r["a"], r["b"]) for r in wide.na.fill(0.0).collect()) == [(0.0, 8.0), (1.0, 0.0), (2.0, 9.0)]


def test_lookup_default_and_codes(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    dim = spark.createDataFrame([(1, "one")], "id int, name string")
    out = joins.lookup(df, dim, "id", {"name": "Unknown"}).withColumn("code", joins.map_codes(F.col("id").cast("string"), {"2": "two"}))
    assert sorted((r["name"], r["code"]) for r in out.na.fill("-").collect()) == [("Unknown", "two"), ("one", "-")]


def test_incremental_steps(spark):
    stored = series(spark, [1.0, 2.0])
    source = series(spark, [5.0, 6.0, 7.0]).unionByName(series(spark, [1.0], key="new"))
    assert sorted(column(incremental.fresh_rows(source, stored), "x")) == [1.0, 7.0]
    assert incremental.new_periods(source, stored).count() == 2
    a, b = stored.withColumn("load_seq", F.lit(1)), source.withColumn("load_seq", F.lit(2))
    assert column(incremental.upsert(a, b, ["series_key", "month"]), "x") == [5.0, 6.0, 7.0, 1.0]
    assert column(incremental.newest_period(source, "series_key"), "x") == [7.0, 1.0]
    assert incremental.newest_period(source).count() == 1
    assert incremental.is_ready(stored, source, ["series_key", "month"])
    assert not incremental.is_ready(source, stored, ["series_key", "month"])
    kept = incremental.replace_periods(stored, source.filter("series_key = 'a'").filter("x = 6"), "month")
    assert sorted(column(kept, "x")) == [1.0, 6.0]


def test_settle_prefers_actuals_then_the_newest(spark):
    rows = [("a", 1, True, 1), ("a", 2, False, 2), ("a", 3, True, 3), ("b", 4, True, 1), ("b", 5, True, 2)]
    df = spark.createDataFrame(rows, "k string, v int, forecast boolean, load_seq int")
    out = {r["k"]: r["v"] for r in incremental.settle(df, "k").collect()}
    assert out == {"a": 2, "b": 5}


def test_required_and_present_columns(spark):
    df = spark.range(1).withColumn("a", F.lit(1))
    with pytest.raises(ValueError, match="missing"):
        panel.require_columns(df, ["a", "b"])
    assert panel.present_columns(df, ["b", "a"]) == ["a"]
    with pytest.raises(ValueError):
        panel.present_columns(df, ["b"], "in the test", required=True)
    assert panel.rename(df, {"a": "c"}).columns == ["id", "c"]
    with pytest.raises(ValueError):
        panel.rename(df, {"zz": "c"})
    assert panel.drop_present(df, ["a", "zz"]).columns == ["id"]
    assert panel.insert_first(df, "p", F.lit("x")).columns == ["p", "id", "a"]


def test_at_month_is_a_join_that_leaves_the_panel_where_it_is(spark):
    panel_rows = series(spark, [1.0, 2.0, 3.0, 4.0])
    monthly = spark.createDataFrame([(month("2020-02"), 10.0, None), (month("2020-04"), None, "d")], "month date, v double, w string")
    for how in ("inner", "left"):
        out = joins.at_month(panel_rows, monthly, how)
        want = panel_rows.join(monthly, "month", how).select(*out.columns)
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
        plan = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
        assert "Join" not in plan and "hashpartitioning" not in plan
    assert joins.at_month(panel_rows, monthly.where("false")).count() == 0
    assert joins.at_month(panel_rows, monthly.where("false"), "left").count() == 4
    with pytest.raises(Exception):
        joins.at_month(panel_rows, monthly.unionByName(monthly)).collect()
