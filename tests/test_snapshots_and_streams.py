"""Manifests, polled snapshots, late windows, keyed settlement, file inventories, folding and stored headers."""

import os
import pathlib
import unicodedata
from datetime import date, datetime

import pytest
from helpers import months
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tidetable import session
from tidetable.functions import dates, text
from tidetable.operators import fold_table, joins, regression, stats
from tidetable.plans import publication
from tidetable.session import new_folder
from tidetable.sources import csv, snapshots, tables
from tidetable.streaming import loads, polled


def test_work_tables_are_deleted_when_asked(spark):
    kept = session.materialize(spark.range(3), "kept")
    before = session.work_tables(spark)
    other = session.materialize(spark.range(5), "other")
    assert other.count() == 5 and len(session.work_tables(spark)) == len(before) + 1
    (folder,) = set(session.work_tables(spark)) - set(before)
    assert session.discard_work(spark, keep=before) == 1
    assert not _local(folder).exists() and kept.count() == 3 and session.work_tables(spark) == before


def _local(folder):
    return pathlib.Path(folder.removeprefix("file://"))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_manifest_names_what_counts(spark):
    store = snapshots.SnapshotTable(spark, new_folder(spark, "manifest"))
    with pytest.raises(FileNotFoundError):
        store.read()
    assert store.manifest() is None
    first = spark.createDataFrame([(2000, 1), (2001, 2), (2002, 3)], "year int, v int")
    second = spark.createDataFrame([(2001, 20), (2002, 30), (2002, 31)], "year int, v int")
    store.commit(first, "a")
    assert _rows(store.read().select("year", "v", "snapshot")) == [(2000, 1, "a"), (2001, 2, "a"), (2002, 3, "a")]
    assert store.superseded().count() == 0 and store.drop_superseded() == []
    store.commit(second, "b")
    want = [(2000, 1, "a"), (2001, 20, "b"), (2002, 30, "b"), (2002, 31, "b")]
    assert _rows(store.read().select("year", "v", "snapshot")) == want
    assert _rows(store.superseded()) == [("a", "2001", 1, "b"), ("a", "2002", 1, "b")]
    # a commit that broke off leaves data that no version names, or a version that is not whole
    broken = spark.createDataFrame([(9, 5, "c", "2000", 1, None)], snapshots.MANIFEST)
    broken.write.mode("append").parquet(f"{store.root}/manifest")
    second.withColumn("v", F.lit(-1)).write.partitionBy("year").parquet(f"{store.root}/data/snapshot=c")
    assert _rows(store.read().select("year", "v", "snapshot")) == want
    gone = store.drop_superseded()
    assert [g.rpartition("data/")[2] for g in gone] == ["snapshot=a/year=2001", "snapshot=a/year=2002"]
    assert not (_local(store.root) / "data/snapshot=a/year=2001").exists()
    assert _rows(store.read().select("year", "v", "snapshot")) == want and store.superseded().count() == 0
    store.commit(second.withColumn("v", F.col("v") + 1), "b")  # the same name again
    assert _rows(store.read().select("year", "v", "snapshot")) == [(2000, 1, "a"), (2001, 21, "b"), (2002, 31, "b"), (2002, 32, "b")]


def test_a_reader_keeps_its_version_during_a_commit(spark):
    store = snapshots.SnapshotTable(spark, new_folder(spark, "during"))
    store.commit(spark.createDataFrame([(2000, 1)], "year int, v int"), "a")
    reading = store.read().select("v")
    store.commit(spark.createDataFrame([(2000, 2)], "year int, v int"), "b")
    assert [r["v"] for r in reading.collect()] == [1] and [r["v"] for r in store.read().collect()] == [2]


def test_polls_read_each_snapshot_once(spark):
    root, out, state = (new_folder(spark, n) for n in ("poll", "poll-out", "poll-state"))

    def poll():
        stream = polled.read_snapshots(spark, root, "snapshot string, v bigint")
        loads.run_available(stream, state, loads.append_to(out), mode="append")

    def seen():
        return _rows(spark.read.schema("snapshot string, v bigint, batch_id int").parquet(out).select("snapshot", "v"))

    spark.range(3).select(F.col("id").alias("v"), F.lit("x").alias("other")).write.parquet(f"{root}/2020-01")
    poll()
    assert seen() == [("2020-01", 0), ("2020-01", 1), ("2020-01", 2)]
    poll()
    spark.range(5, 6).select(F.col("id").alias("v")).write.parquet(f"{root}/2020-02")
    unfinished = _local(root) / "2020-03"
    unfinished.mkdir()
    poll()
    poll()
    assert seen() == [("2020-01", 0), ("2020-01", 1), ("2020-01", 2), ("2020-02", 5)]


def _events(spark, days, value=1):
    rows = [("a", datetime(2024, 1, d, h), value) for d in days for h in (3, 15)]
    return spark.createDataFrame(rows, "series_key string, ts timestamp_ntz, v int")


def test_late_windows_come_in_by_the_correction(spark):
    root, windows, late = (new_folder(spark, n) for n in ("ev", "ev-windows", "ev-late"))
    states = [new_folder(spark, n) for n in ("ev-s1", "ev-s2")]
    sums = {"n": F.count(F.lit(1)), "total": F.sum("v")}
    held = []
    for days, value in ((range(10, 28), 1), (range(1, 12), 10), (range(27, 31), 100)):
        _events(spark, days, value).write.mode("append").parquet(root)
        stream = loads.read_files(spark, root, _events(spark, []).schema)
        totals = loads.period_totals(stream, "series_key", "ts", [c.alias(n) for n, c in sums.items()])
        query = loads.run_available(totals, states[0], loads.append_to(windows), mode="update")
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        loads.run_available(stream, states[1], loads.late_to(late, "series_key", "ts", sums), mode="append")
    got = {r["day"].day: (r["n"], r["total"]) for r in loads.totals_with_late(spark, windows, late, "series_key", list(sums)).collect()}
    want = {}
    for days, value in ((range(10, 28), 1), (range(1, 12), 10), (range(27, 31), 100)):
        for d in days:
            n, total = want.get(d, (0, 0))
            want[d] = (n + 2, total + 2 * value)
    assert got == want
    assert spark.read.parquet(f"{late}/late").agg(F.sum("n")).first()[0] == 22
    assert max(held) < 8  # windows behind the watermark are gone


def test_settlement_as_state(spark):
    root, out, state = (new_folder(spark, n) for n in ("settle", "settle-out", "settle-state"))
    schema = "k string, day date, load_seq int, forecast boolean, v int"
    batches = [
        [("a", date(2024, 1, 1), 1, True, 1), ("b", date(2024, 1, 1), 2, False, 2)],
        [("a", date(2024, 1, 1), 3, False, 3), ("b", date(2024, 1, 1), 4, True, 4), ("c", date(2024, 1, 2), 5, True, 5)],
        [("a", date(2024, 1, 1), 2, False, 6), ("c", date(2024, 1, 2), 6, True, 7)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(root)
        stream = loads.read_files(spark, root, spark.createDataFrame([], schema).schema)
        loads.run_available(loads.settled(stream, ["k", "day"]), state, loads.append_to(out), mode="update")
    found = loads.latest_of_batches(spark, out, ["k", "day"])
    assert sorted((r["k"], r["load_seq"], r["forecast"], r["v"]) for r in found.collect()) == [("a", 3, False, 3), ("b", 2, False, 2), ("c", 6, True, 7)]
    # a repeated batch overwrites its own folder
    last = spark.read.parquet(f"{out}/batch_id=2")
    loads.append_to(out)(spark.createDataFrame(last.collect(), last.schema), 2)
    assert loads.latest_of_batches(spark, out, ["k", "day"]).count() == 3


def test_settled_state_expires(spark):
    root, state, out = (new_folder(spark, n) for n in ("expire", "expire-state", "expire-out"))
    schema = "k string, day date, load_seq int, forecast boolean"
    sizes = []
    for month in range(1, 5):
        spark.createDataFrame([(f"k{i}", date(2024, month, 1), i, True) for i in range(20)], schema).write.mode("append").parquet(root)
        stream = loads.read_files(spark, root, spark.createDataFrame([], schema).schema)
        query = loads.run_available(loads.settled(stream, ["k", "day"], time="day", expire="10 days"), state, loads.append_to(out), mode="update")
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(sizes) <= 40 and loads.latest_of_batches(spark, out, ["k", "day"]).count() == 80


def test_settlement_by_years_passes_over_batches_without_rows(spark):
    root, out, state = (new_folder(spark, n) for n in ("empties", "empties-out", "empties-state"))
    schema = "k string, day date, load_seq int, forecast boolean"
    batches = [
        [],
        [],
        [("a", date(2023, 1, 1), 1, False), ("b", date(2024, 1, 1), 2, True)],
        [],
        [("a", date(2023, 1, 1), 3, True), ("b", date(2024, 1, 1), 4, False)],
        [],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(root)
        stream = loads.read_files(spark, root, spark.createDataFrame([], schema).schema)
        loads.run_available(stream, state, loads.settle_to(out, ["k", "day"], time="day"), mode="append")
        if i < 2:
            assert tables.scan_or_empty(spark, out, stream.schema).collect() == []
    found = tables.scan_or_empty(spark, out, stream.schema)
    assert _rows(found) == [("a", date(2023, 1, 1), 1, False), ("b", date(2024, 1, 1), 4, False)]


@pytest.fixture
def small_splits(spark):
    """Files are read in so small parts that one with a single row group begins with a part without rows."""
    values = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "100"}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _write_events(spark, folder, n):
    rows = [(i, datetime(2023 + i % 2, 5, 1 + i % 3), i % 7, "ab"[i // 2 % 2], (i * 37 % 101) * 0.75, f"{i}") for i in range(n)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{folder}/events.parquet")
    return rows


def _first_part_is_empty(spark, folder):
    parts = spark.read.parquet(f"file://{folder}/events.parquet").select(F.spark_partition_id().alias("p")).distinct()
    return 0 not in {r["p"] for r in parts.collect()}


@pytest.mark.parametrize("n", [0, 1500])
def test_settled_years_of_a_file_whose_first_part_is_empty(spark, tmp_path, small_splits, n):
    rows = _write_events(spark, tmp_path, n)
    assert _first_part_is_empty(spark, tmp_path)
    want = {}
    for event_id, ts, user_id, kind, value, _ in rows:
        forecast, key = value < 30, (kind, user_id, ts.strftime("%Y-%m-%d"))
        if key not in want or (not forecast, event_id) > (not want[key][1], want[key][0]):
            want[key] = (event_id, forecast)
    found = queries()["stream_settle_years"](spark, f"file://{tmp_path}").collect()
    got = {(r["series_key"], r["user_id"], r["day"]): (r["event_id"], r["forecast"]) for r in found}
    assert len(found) == len(got) and got == want


def test_upserts_pass_over_batches_without_rows(spark):
    out = new_folder(spark, "upsert-empties")
    schema = "k string, day date, load_seq int"
    write = loads.upsert_to(out, ["k", "day"], "load_seq", "day")
    batches = [[], [("a", date(2023, 1, 1), 1), ("b", date(2024, 1, 1), 2)], [], [("a", date(2023, 1, 1), 3)]]
    for i, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, schema)
        write(batch, i)
        write(batch, i)  # a repeated batch
    assert _rows(tables.scan_or_empty(spark, out, batch.schema)) == [("a", date(2023, 1, 1), 3), ("b", date(2024, 1, 1), 2)]


@pytest.mark.parametrize("n", [0, 1500])
def test_upserts_from_a_file_whose_first_part_is_empty(spark, tmp_path, small_splits, n):
    rows = _write_events(spark, tmp_path, n)
    assert _first_part_is_empty(spark, tmp_path)
    want = {}
    for event_id, ts, user_id, kind, value, _ in rows:
        want[kind, user_id, ts.strftime("%Y-%m-%d")] = (value, event_id)  # the rows come in the order of event_id
    found = queries()["stream_upsert"](spark, f"file://{tmp_path}").collect()
    got = {(r["series_key"], r["user_id"], r["day"]): (r["value"], r["event_id"]) for r in found}
    assert len(found) == len(got) and got == want


def test_an_inventory_of_many_files(spark, tmp_path):
    """Files of two headers, in one table; a column is found by name in each."""
    for i in range(300):
        header, row = ("code,qty,period", f"c{i},{i},2020-01") if i % 2 else ('period,note,"code",qty', f'2020-01,"x, y",c{i},{i}')
        (tmp_path / f"f{i:03d}.csv").write_text(f"{header}\n{row}\n\n{row}\n", encoding="utf-8-sig" if i % 3 == 0 else "utf-8")
    out = csv.scan_csv_text(spark, str(tmp_path), ["code", "qty"])
    assert sorted(map(tuple, out.collect())) == sorted((f"c{i}", str(i)) for i in range(300) for _ in range(2))
    (tmp_path / "g.csv").write_text("code,period\nz,1\n")
    with pytest.raises(ValueError, match="qty"):
        csv.scan_csv_text(spark, str(tmp_path), ["code", "qty"])


def test_lines_are_numbered_within_their_splits(spark, tmp_path):
    big = [f"note {i}" for i in range(9)] + ["name,n"] + [f"row{i},{i}" for i in range(4000)]
    for k in range(3):
        (tmp_path / f"big{k}.csv").write_text("\n".join(big) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        out = csv.scan_csv_after_preamble(spark, str(tmp_path), "name string, n int", skip=10)
        assert (out.count(), out.agg(F.sum("n")).first()[0]) == (12_000, 3 * sum(range(4000)))
        (tmp_path / "m.txt").write_text("a\nb\nMARK\nday,v\n" + "\n".join(f"2020-01-{1 + i % 28:02d},{i}" for i in range(3000)))
        marked = csv.scan_csv_after_marker(spark, str(tmp_path / "m.txt"), "day date, v int", marker="MARK")
        assert (marked.count(), marked.agg(F.sum("v")).first()[0]) == (3000, sum(range(3000)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_encodings_are_found_for_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("name\nMichoacán �\n".encode())
    (tmp_path / "b.csv").write_bytes("name\nMichoacán\n".encode("latin-1"))
    (tmp_path / "c.csv").write_bytes("name\n日本\n".encode("shift-jis"))
    found = {os.path.basename(r["_file"]): r["encoding"] for r in csv.find_encodings(spark, str(tmp_path), ("UTF-8", "ascii", "shift-jis")).collect()}
    assert found["a.csv"] == "UTF-8" and found["c.csv"] == "shift-jis"
    out = csv.scan_csv_any_encoding(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "name string")
    assert sorted(r["name"] for r in out.collect()) == ["Michoacán", "Michoacán �"]
    (tmp_path / "d.csv").write_bytes(b"other\nx\n")
    with pytest.raises(ValueError, match="d.csv"):
        csv.scan_csv_any_encoding(spark, str(tmp_path / "d.csv"), "name string")


def test_folding_is_the_ascii_part_of_nfkd(spark):
    lines = ["… ™ № ㎏ Ⅳ ½ ﬁ", "𝐀𝑏𝟙 𝔘", "Ærø straße naïve", "é 日本 ①⑳", "", "plain", "\U0001f100\U0001f12b ㏂"]
    df = spark.createDataFrame([(t,) for t in [*lines, None]], "t string")
    got = {r["t"]: r["f"] for r in df.select("t", text.fold_accents("t").alias("f")).collect()}
    assert got == {t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in lines} | {None: None}


def test_a_summary_falls_back_to_the_stored_header(spark):
    m = months("2020-01", 3)
    points = [("a", m[0], 10.0, False), ("a", m[1], 11.0, True), ("b", m[0], 4.0, False), ("c", m[0], 5.0, False)]
    merged = spark.createDataFrame(points, "series_key string, month date, price double, forecast boolean")
    stored = spark.createDataFrame([("a", "lb", "x", 9.0, 9.0), ("b", "lb", "May 2019", 3.5, -2.0)], "series_key string, unit_label string, prediction_month string, forecast_price double, change_pct double")
    out = publication.display_summary(merged, dates.next_month(F.lit("2020-01-15").cast("date")), stored=stored, per_unit=F.col("series_key") == "c")
    assert _rows(out) == [
        ("a", "Pricing per lb", "February 2020", 11.0, 10.0),
        ("b", "Pricing per lb", "May 2019", 3.5, -2.0),
        ("c", "Pricing per unit", "No prediction yet", 0.0, 0.0),
    ]


def test_the_table_function_equals_the_window_form(spark):
    rows = [(k, m, None if i == 7 else 100.0 + 5 * ((i * 7919) % 13) + i) for k in "ab" for i, m in enumerate(months("2015-01", 40))]
    df = spark.createDataFrame(rows, "series_key string, month date, value double")
    got = {(r["series_key"], r["month"]): r["prediction"] for r in fold_table.fit_folds(df, 24).collect()}
    window = regression.one_step_backtest(df, regression.RegressionSpec("value", lags=(1,), initial_window=24)).collect()
    assert len(got) == len(window) == 32
    assert all(got[r["series_key"], r["month"]] == pytest.approx(r["prediction"], rel=1e-6) for r in window)
    with pytest.raises(Exception, match="initial_window must be a positive constant"):
        fold_table.fit_folds(df, 0).collect()
    with pytest.raises(Exception, match="missing columns"):
        F.udtf(fold_table.FoldFits)(df.drop("value").asTable(), F.lit(3)).collect()


def test_lag_correlation_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    x, y = rng.normal(size=40) + 1e6, rng.normal(size=40)
    x[5] = y[9] = np.nan
    rows = [("a", m, None if np.isnan(p) else float(p), None if np.isnan(q) else float(q), 3.0) for m, p, q in zip(months("2015-01", 40), x, y)]
    df = spark.createDataFrame([*rows, ("b", date(2020, 1, 1), 1.0, 2.0, 3.0)], "series_key string, month date, x double, y double, c double")
    for direction in ("lag", "lead"):
        got = {(r["series_key"], r["feature"], r["lag"]): r["correlation"] for r in stats.lag_correlation(df, "y", ["x", "c"], max_lag=6, direction=direction).collect()}
        assert len(got) == 28 and all(got["a", "c", k] == 0 and got["b", "x", k] == 0 for k in range(7))
        for k in range(7):
            p, q = (x[: 40 - k], y[k:]) if direction == "lag" else (x[k:], y[: 40 - k])
            both = ~np.isnan(p) & ~np.isnan(q)
            assert got["a", "x", k] == pytest.approx(np.corrcoef(p[both], q[both])[0, 1], abs=1e-9)


def test_copies_of_a_hot_row_get_several_salts(spark):
    left = spark.range(4000, numPartitions=8).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    right = spark.createDataFrame([(7, "r"), (8, "s")], "k int, w string")
    joined = joins.salted_join(left, right, "k", salts=16)
    assert joined.count() == 4000
    salts = left.select(F.pmod(F.xxhash64("k", "v", F.spark_partition_id()), F.lit(16)).alias("s")).distinct().count()
    assert salts > 3
