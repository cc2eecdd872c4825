import unicodedata
from datetime import date

import pytest
from helpers import column, month, months, series
from pyspark.sql import functions as F

from tidetable import schemas, session
from tidetable.functions import dates, nested, numeric, text
from tidetable.operators import ranking, reshape
from tidetable.plans import features, publication, silver
from tidetable.sources import csv, json, tables
from tidetable.streaming import loads


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def test_dates(spark):
    assert one(spark, dates.month_of_compact(F.lit("201602"))) == date(2016, 2, 1)
    assert one(spark, dates.month_of_compact(F.lit("202513"))) is None
    assert one(spark, dates.month_of_short_name(F.lit("Feb-2016"))) == date(2016, 2, 1)
    assert one(spark, dates.month_of_long_name(F.lit("March 2016"))) == date(2016, 3, 1)
    assert one(spark, dates.month_of_text(F.lit("2016-05-20"))) == date(2016, 5, 1)
    assert one(spark, dates.month_of_text(F.lit("bad"))) is None
    assert one(spark, dates.next_month(F.lit("2025-12-31").cast("date"))) == date(2026, 1, 1)
    assert one(spark, dates.month_from_parts(F.lit("2016"), F.lit("3"))) == date(2016, 3, 1)


def test_text(spark):
    assert text.plain_forms()[0]["ñ"] == "n" and text.plain_forms()[1]["ﬁ"] == "fi"
    assert one(spark, text.normalized_name(F.lit(" Michoacán "))) == "michoacan"
    assert one(spark, text.same_name(F.lit("MICHOACÁN"), "michoacan"))
    assert one(spark, text.zero_pad(F.lit("80440"), 6)) == "080440"
    assert one(spark, text.zero_pad(F.lit("1234567"), 6)) == "1234567"
    assert one(spark, text.strip_footnotes(F.lit("Fresh fruit 3 12"))) == "Fresh fruit"
    assert one(spark, text.contains_any_case(F.lit(None).cast("string"), "x")) is False
    assert one(spark, text.contains_any_case(F.lit("100% TOMATO"), "0% tom")) is True
    assert one(spark, text.contains_any_case(F.lit("100 tomato"), "0% tom")) is False
    assert one(spark, text.unit_label(F.lit("KG"))) == "Pricing per kg"
    assert one(spark, text.unit_label(F.lit("lb"))) == "Pricing per lb"
    assert one(spark, text.unit_label(F.lit("kg"), F.lit(True))) == "Pricing per unit"


def test_numbers(spark):
    assert one(spark, numeric.to_number(F.lit("x"))) is None
    assert one(spark, numeric.to_number(F.lit("NaN"))) is None
    assert one(spark, numeric.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, numeric.safe_ln(F.lit(-1.0))) is None
    assert one(spark, numeric.round_half_even(F.lit(0.125), 2)) == 0.12
    assert one(spark, numeric.round_half_up(F.lit(0.125), 2)) == 0.13
    assert one(spark, numeric.within(F.lit(11.0), 0, 10, F.lit(4.0))) == 4.0
    assert one(spark, numeric.within(F.lit(None).cast("double"), 0, 10, F.lit(4.0))) == 4.0
    assert one(spark, numeric.null_to_zero(F.lit(float("nan")))) == 0.0
    assert one(spark, numeric.padding(F.lit(1.0), F.lit(1.1))) == 0.12
    assert one(spark, numeric.hundredths(F.lit(0.29))) == 29
    df = numeric.nan_to_null(spark.createDataFrame([(float("nan"), 1)], "a double, b int"))
    assert tuple(df.first()) == (None, 1)


def test_deflation_and_its_inverse(spark):
    prices = series(spark, [2.0, 3.0], name="price")
    index = series(spark, [100.0, 120.0], name="cpi").drop("series_key")
    out = silver.adjusted_prices(prices, index, F.lit("2020-02-01").cast("date"))
    assert column(out, "price_adjusted") == [2.4, 3.0]


def test_weather_blend_is_null_when_a_region_is_missing(spark):
    rows = [(month("2020-01"), "x", 1.0), (month("2020-01"), "y", 3.0), (month("2020-02"), "x", 1.0)]
    df = spark.createDataFrame(rows, "month date, state string, m double")
    out = features.blended_regions(df, {"x": 0.5, "y": 0.5}, ["m"]).orderBy("month").collect()
    assert [r["m"] for r in out] == [2.0, None]


def test_offline_features_mark_filled_rows(spark):
    own = series(spark, [float(i) for i in range(20)], name="q")
    shared = series(spark, [float(i) for i in range(24)], start="2019-12", name="r").drop("series_key")
    target = series(spark, [1.0] * 22, name="price")
    end = F.lit("2021-12-01").cast("date")
    history, future = features.offline_features([own], [shared], target, {"q": 0, "r": 1}, ["q"], start=F.lit("2020-01-01").cast("date"), end=end)
    rows = history.orderBy("month").collect()
    assert len(rows) == 22 and [r["is_imputed"] for r in rows[18:]] == [False, False, True, True]
    assert rows[20]["q_lag_0"] == 8.0
    assert column(future, "month") == months("2021-11", 2)


def _merged(spark):
    actual = series(spark, [1.0, 2.0, 4.0], name="price").withColumn("load_seq", F.lit(1))
    again = series(spark, [5.0], start="2020-03", name="price").withColumn("load_seq", F.lit(2))
    predictions = series(spark, [3.0, 6.0, 7.0], start="2020-03", name="prediction").withColumns(
        {"lower_bound": F.col("prediction") - 1, "upper_bound": F.col("prediction") + 1, "load_seq": F.lit(1)}
    )
    index = series(spark, [100.0, 200.0], name="cpi").drop("series_key")
    nominal = publication.nominal_forecast(predictions, index, F.lit("2020-01-01").cast("date"))
    return publication.merged_series(actual.unionByName(again), nominal, start=F.lit("2020-02-01").cast("date"))


def test_publication(spark):
    merged = _merged(spark).cache()
    # the observed month keeps its newest actual; later months carry the last index
    assert column(merged, "price") == [2.0, 5.0, 12.0, 14.0]
    doc = publication.documents(merged).first()
    assert (doc["prediction_month"], doc["forecast_price"], doc["change_pct"]) == ("April 2020", 12.0, 140.0)
    assert [p["date"] for p in doc["series"]] == ["2020-02", "2020-03", "2020-04", "2020-05"]
    text_doc = publication.as_json(publication.documents(merged)).first()["document"]
    assert text_doc.count("lower_bound") == 2
    summary = publication.display_summary(merged, F.lit("2020-05-01").cast("date")).first()
    assert (summary["prediction_month"], summary["forecast_price"], summary["change_pct"]) == ("May 2020", 14.0, 16.7)
    last = publication.display_summary(merged, F.lit("2021-01-01").cast("date")).first()
    assert last["prediction_month"] == "May 2020"
    phases = column(publication.phases(merged, F.lit("2020-04-01").cast("date")), "phase")
    assert phases == ["historical", "historical", "delayed", "forecast"]
    only_actual = merged.filter(~F.col("forecast"))
    assert ranking.change_of_first_future(only_actual).first()["change_pct"] is None
    nothing = publication.display_summary(only_actual, F.lit("2020-05-01").cast("date")).first()
    assert (nothing["prediction_month"], nothing["forecast_price"], nothing["change_pct"]) == ("No prediction yet", 0.0, 0.0)
    merged.unpersist()


def test_nominal_forecast_before_the_index_fails(spark):
    predictions = series(spark, [1.0], start="2019-01", name="prediction").withColumns(
        {"lower_bound": F.lit(1.0), "upper_bound": F.lit(1.0), "load_seq": F.lit(1)}
    )
    index = series(spark, [100.0], name="cpi").drop("series_key")
    with pytest.raises(Exception, match="no index at or before"):
        publication.nominal_forecast(predictions, index, F.lit("2020-01-01").cast("date")).collect()


def test_json_shapes(spark, tmp_path):
    (tmp_path / "v.json").write_text(
        '[{"status":"SUCCESS","object":{"vectorId":1,"vectorDataPoint":[{"refPer":"2020-01-01","value":1.5},{"refPer":"2020-02-01","value":null}]}},'
        '{"status":"FAILED","object":{"vectorId":2,"vectorDataPoint":[{"refPer":"2020-01-01","value":9}]}},'
        '{"status":"SUCCESS","object":{"vectorId":3}}]'
    )
    payload = json.scan_json(spark, str(tmp_path / "v.json"), schemas.VECTOR_PAYLOAD)
    assert [(r["vector_id"], r["value"]) for r in json.vector_points(payload).orderBy("month").collect()] == [(1, 1.5), (1, None)]
    (tmp_path / "fx.json").write_text('{"observations":[{"d":"2020-01-01","U":{"v":"1.3"},"M":{"v":"0.07"}},{"d":"2020-02-01","U":{"v":"1.4"}},{"d":"2020-03-01"}]}')
    fx = json.scan_json(spark, str(tmp_path / "fx.json"), schemas.coded_series("U", "M"))
    grouped = json.grouped_series(fx, {"U": "usd", "M": "mxn"}).orderBy("month").collect()
    assert [(r["usd"], r["mxn"]) for r in grouped] == [(1.3, 0.07), (1.4, None)]
    assert json.coded_series(fx, "M", "mxn").count() == 1


def test_nested_points(spark):
    df = spark.createDataFrame([([("2020-02", 2.0), ("2020-01", 1.0), ("2020-02", 3.0)],)], "p array<struct<refPer:string,value:double>>")
    r = df.select(nested.periods_of("p").alias("all"), nested.points_of_period("p", F.lit("2020-02")).alias("some")).first()
    assert r["all"] == ["2020-01", "2020-02"] and len(r["some"]) == 2
    assert one(spark, F.size(nested.points_or_empty(F.lit(None), schemas.VECTOR_POINT))) == 0


def test_text_files_with_preamble_marker_and_encoding(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"p{i}.csv").write_text("\n".join([f"note {j}" for j in range(9)] + ["head,er"] + [f"f{i},{j}" for j in range(5)]) + "\n")
    out = csv.scan_csv_after_preamble(spark, str(tmp_path / "p*.csv"), "name string, n int", skip=10)
    assert sorted((r["name"], r["n"]) for r in out.collect()) == [(f"f{i}", j) for i in range(3) for j in range(5)]
    (tmp_path / "m.txt").write_text('x,1\n"OBSERVATIONS"\ndate,v\n2020-01-01,1.5\n\n2020-02-01,2.5\n')
    marked = csv.scan_csv_after_marker(spark, str(tmp_path / "m.txt"), "day date, v double", marker='"OBSERVATIONS"')
    assert [r["v"] for r in marked.orderBy("day").collect()] == [1.5, 2.5]
    (tmp_path / "l.csv").write_bytes("name\nMichoacán\n".encode("latin1"))
    (tmp_path / "u.csv").write_bytes("﻿name\nMichoacán\n".encode("utf-8"))
    for name in ("l.csv", "u.csv"):
        assert csv.scan_csv_any_encoding(spark, str(tmp_path / name), "name string").first()["name"] == "Michoacán"


def test_preamble_in_a_file_of_many_splits(spark, tmp_path):
    (tmp_path / "big.csv").write_text("\n".join([f"note {j}" for j in range(9)] + ["head,er"] + [f"row,{j}" for j in range(20000)]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        out = csv.scan_csv_after_preamble(spark, str(tmp_path / "big.csv"), "name string, n int", skip=10)
        assert out.rdd.getNumPartitions() >= 1
        assert out.agg(F.count("*").alias("c"), F.sum("n").alias("s")).first().asDict() == {"c": 20000, "s": 199990000}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_year_tables_merge_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    df = series(spark, [1.0] * 24).withColumn("load_seq", F.lit(1))
    on = ["series_key", "month"]
    tables.merge_into_years(df, path, on, "load_seq")
    late = series(spark, [9.0, 9.0], start="2021-12").withColumn("load_seq", F.lit(2))
    tables.merge_into_years(late, path, on, "load_seq")
    stored = tables.scan_dataset(spark, path)
    assert stored.count() == 25 and stored.filter("x = 9").count() == 2
    assert sorted(r["year"] for r in tables.stored_partitions(spark, path).collect()) == [2020, 2021, 2022]
    tables.replace_years(series(spark, [5.0], start="2020-06").withColumn("load_seq", F.lit(3)), path)
    assert tables.scan_partition(spark, path, 2020).count() == 1
    assert tables.scan_dataset(spark, path).count() == 14
    plan = tables.scan_partition(spark, path, 2020)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_snapshots_and_single_file(spark, tmp_path):
    for name, v in (("S_2020_01.csv", 1), ("S_2020_02.csv", 2)):
        (tmp_path / name).write_text(f"v\n{v}\n")
    df = spark.read.schema("v int").option("header", True).csv(str(tmp_path))
    assert [r["v"] for r in tables.latest_snapshot(df).collect()] == [2]
    with pytest.raises(FileNotFoundError):
        tables.require_single_file(df.withColumn("p", F.lit(1)), "p")
    with pytest.raises(ValueError):
        tables.Layers("/x").path("other", "d")


def test_stream_equals_batch_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    events = spark.range(400).select(
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id)").alias("ts"), (F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v")
    )
    events.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = loads.read_files(spark, str(tmp_path / "in"), events.schema, files_per_batch=1)
    daily = loads.period_totals(stream, "k", "ts", [F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")], late_by="30 days")
    out = str(tmp_path / "out")
    loads.run_available(daily, str(tmp_path / "cp"), loads.append_to(out))
    got = sorted(map(tuple, loads.latest_of_batches(spark, out, ["k", "day"]).select("k", "day", "n", "s").collect()))
    want = events.groupBy("k", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)), F.sum("v"))
    assert got == sorted(map(tuple, want.collect()))
    table = str(tmp_path / "table")
    batch = series(spark, [1.0, 2.0]).withColumn("load_seq", F.lit(1))
    write = loads.upsert_to(table, ["series_key", "month"], "load_seq")
    write(batch, 0)
    write(batch, 0)
    assert tables.scan_dataset(spark, table).count() == 2


def test_late_rows_count_and_a_repeated_batch_replaces_itself(spark, tmp_path):
    day = lambda d: spark.sql(f"SELECT 'k' AS k, timestamp_ntz'2024-01-{d:02d} 05:00:00' AS ts, 1.5 AS v")
    write = loads.totals_to(str(tmp_path / "t"), "k", "ts", {"n": F.count(F.lit(1)), "v": F.sum("v")})
    for number, batch in enumerate((day(20), day(1).unionByName(day(20)))):
        write(batch, number)
        write(batch, number)
    out = loads.totals_of_batches(spark, str(tmp_path / "t"), "k", ["n", "v"]).orderBy("day").collect()
    assert [(str(r["day"]), r["n"], float(r["v"])) for r in out] == [("2024-01-01", 1, 1.5), ("2024-01-20", 2, 3.0)]


def test_shared_folder_comes_from_the_session(spark):
    assert session.new_folder(spark, "x").startswith(session.shared_root(spark) + "/x-")


def test_columns_are_found_by_name_in_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("period,code,qty,x,x\n202001,1,5,p,q\n")
    (tmp_path / "b.csv").write_text('qty,"code",period\n7,2,202002\n')
    out = csv.scan_csv_text(spark, str(tmp_path), ["code", "period"])
    assert sorted((r["code"], r["period"]) for r in out.collect()) == [("1", "202001"), ("2", "202002")]
    with pytest.raises(ValueError, match="no column"):
        csv.scan_csv_text(spark, str(tmp_path), ["x"])
    with pytest.raises(Exception):
        csv.scan_tree(spark, str(tmp_path), "period string, code string, qty string").collect()


def test_encoding_is_found_for_each_file(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("name\nMichoacán\n".encode("latin1"))
    (tmp_path / "u.csv").write_bytes("name\nNuevo León \ufffd\n".encode())
    (tmp_path / "m.csv").write_bytes("\ufeffname\nYucatán\n".encode())
    out = csv.scan_csv_any_encoding(spark, str(tmp_path), "name string")
    assert sorted(r["name"] for r in out.collect()) == ["Michoacán", "Nuevo León \ufffd", "Yucatán"]


def test_folding_follows_the_decomposition(spark):
    words = ["Škoda Łódź Ořech Győr São", "ﬁn ½ Ａ", "cafe\u0301", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    want = [None if w is None else unicodedata.normalize("NFKD", w).encode("ascii", "ignore").decode() for w in words]
    assert [r["f"] for r in df.select(text.fold_accents("w").alias("f")).collect()] == want


def test_nothing_is_lost_in_pivots_and_hundredths(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("a", "z", 4.0), ("b", None, 8.0)], "k string, c string, v double")
    with pytest.raises(Exception, match="not listed"):
        reshape.pivot(df, "k", "c", ["x", "y"], "v", "sum").collect()
    rest = reshape.pivot(df, "k", "c", ["x", "y"], "v", "sum", other="rest").orderBy("k").collect()
    assert [tuple(r) for r in rest] == [("a", 1.0, 2.0, 4.0), ("b", None, None, 8.0)]
    with pytest.raises(Exception, match="two decimals"):
        df.select(numeric.hundredths(F.col("v") + 0.005)).collect()


def test_month_names_of_a_calendar():
    assert dates.month_names_between(date(2019, 11, 1), date(2020, 2, 1)) == ["November 2019", "December 2019", "January 2020", "February 2020"]
