"""Catalog: file sources, sinks and streams.

Each query lets Spark write the raw form of a table derived from the given ones
to the shared folder, then reads it back with the source under test.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from tidetable import schemas
from tidetable.functions import dates, numeric
from tidetable.operators.reshape import pivot, wide_months_to_long
from tidetable.plans import publication, roles, silver
from tidetable.plans.catalog import query, report
from tidetable.plans.queries_publication import PUBLISHED, _merged
from tidetable.plans.roles import month, sql, table
from tidetable.session import materialize, new_folder
from tidetable.sources import csv, json, snapshots, tables
from tidetable.streaming import loads, polled

YM = "strftime(month, '%Y-%m')"
BRAND_NO = "CAST(substr(series_key, 7) AS INT)"


def _price(spark, sf_dir):
    return roles.prices(spark, sf_dir).select("series_key", "month", "price")


def _brand_no():
    return F.regexp_extract("series_key", r"#(\d+)$", 1).cast("int")


# --- CSV ----------------------------------------------------------------------


@query("S1 S15 K3", sql(f"SELECT series_key, {YM} AS month, price FROM prices", "prices"))
def csv_scan(spark, sf_dir):
    path = new_folder(spark, "csv")
    tables.write_csv(_price(spark, sf_dir), path)
    return report(csv.scan_csv(spark, path, schemas.PRICE_SILVER))


@query(
    "S2 A3 A2 C3 F3 F9 F17 J12 P8",
    sql(
        f"""SELECT CASE WHEN {BRAND_NO} = 4 THEN 'avocado' ELSE 'tomato' END AS series_key, {YM} AS month,
        CASE partner WHEN 'AMERICA' THEN 'USA' ELSE 'Mexico' END AS partner, sum(CASE WHEN qty >= 20 THEN qty ELSE 0 END) AS qty
        FROM partner_quantities WHERE {BRAND_NO} IN (4, 7) AND partner IN ('AMERICA', 'ASIA') AND NOT (partner = 'ASIA' AND month(month) = 12) GROUP BY 1, 2, 3""",
        "partner_quantities",
    ),
)
def imports_silver(spark, sf_dir):
    """Import lines as text: codes without leading zeros, one bad month per year and partner, unreadable small quantities."""
    raw = roles.partner_quantities(spark, sf_dir)
    bad_month = (F.col("partner") == "ASIA") & (F.month("month") == 12)
    text_rows = raw.select(
        F.when(bad_month, F.concat(F.date_format("month", "yyyy"), F.lit("13"))).otherwise(F.date_format("month", "yyyyMM")).alias("period"),
        F.concat(F.lit("80"), (F.lit(400) + _brand_no()).cast("string")).alias("code"),
        F.lit("ignored").alias("province"),
        F.col("partner").alias("country"),
        F.when(F.col("qty") >= 20, F.col("qty").cast("string")).otherwise(F.lit("n/a")).alias("quantity"),
    )
    path = new_folder(spark, "imports")
    tables.write_csv(text_rows, path)
    scanned = csv.scan_csv_text(spark, path, schemas.IMPORT_COLUMNS)
    out = silver.imports(scanned, {"080404": "avocado", "080407": "tomato"}, {"AMERICA": "USA", "ASIA": "Mexico"})
    return report(out)


@query("S3", sql("SELECT series_key, strftime(month, '%Y-%m') AS month, spend FROM spend", "spend"))
def csv_dates_scan(spark, sf_dir):
    df = roles.spend(spark, sf_dir).select("series_key", F.date_format("month", "dd/MM/yyyy").alias("month"), "spend")
    path = new_folder(spark, "dates")
    tables.write_csv(df, path)
    schema = "series_key bigint, month date, spend double"
    return report(csv.scan_csv(spark, path, schema, date_format="dd/MM/yyyy"))


def _write_below(top, lines, path):
    """Text files that each begin with the fixed ``top`` lines; every task writes its own ``lines`` below them."""

    def work(batches):
        yield pa.RecordBatch.from_arrays([pa.array(top, pa.string())], names=["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string())], names=["value"])

    lines.select("value").mapInArrow(work, "value string").write.text(path)


@query(
    "S4 A16 F7 F11",
    sql(f"SELECT series_key, {YM} AS month, qty FROM prices", "prices"),
)
def csv_after_preamble(spark, sf_dir):
    """A wide table, one line per product with footnote numbers, below nine lines of notes and the header."""
    months = dates.month_names_between(*roles.sales_months(spark, sf_dir))
    df = roles.prices(spark, sf_dir).withColumn("label", dates.month_name("month"))
    wide = pivot(df, "series_key", "label", months, "qty")
    # one line of text per product
    lines = wide.select(F.concat_ws(",", F.concat("series_key", F.lit("  1 2")), *[F.coalesce(F.col(m).cast("string"), F.lit("")) for m in months]).alias("value"))
    top = [*[f"note {i}" for i in range(9)], ",".join(["Products", *months])]
    path = new_folder(spark, "preamble")
    _write_below(top, lines, path)
    schema = schemas.all_strings("product", *[f"c{i}" for i in range(len(months))])
    scanned = csv.scan_csv_after_preamble(spark, path, schema, skip=10)
    named = scanned.select(
        F.regexp_replace("product", r"\s+\d+(\s+\d+)?$", "").alias("series_key"),
        *[numeric.to_number(f"c{i}").alias(m) for i, m in enumerate(months)],
    )
    long = wide_months_to_long(named, "series_key", dates.month_of_long_name, value="qty")
    return report(long.filter(F.col("qty").isNotNull()))


@query("S5", sql(f"SELECT {YM} AS month, discount, tax FROM rates", "rates"))
def csv_after_marker(spark, sf_dir):
    rows = roles.rates(spark, sf_dir).select(F.concat_ws(",", F.col("month").cast("string"), "discount", "tax").alias("value"))
    top = ['"TERMS"', "free text, with a comma", '"OBSERVATIONS"', "date,FXD,FXT"]
    path = new_folder(spark, "marker")
    _write_below(top, rows, path)
    schema = "month date, discount double, tax double"
    return report(csv.scan_csv_after_marker(spark, path, schema, marker='"OBSERVATIONS"'))


@query(
    "S6",
    """SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(regexp_split_to_array(text, '[^A-Za-zÀ-ÖØ-öø-ÿ]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1, 2""",
)
def csv_encodings(spark, sf_dir):
    """Half of the words in a Latin-1 file set, half in UTF-8 files of the same folder, some with a byte-order mark."""
    words = (
        table(spark, sf_dir, "documents")
        .select("lang", F.explode(F.split("text", "[^A-Za-zÀ-ÖØ-öø-ÿ]+")).alias("word"))
        .filter(F.col("word") != "")
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    words = materialize(words, "words")
    path = new_folder(spark, "encodings")
    own = F.pmod(F.xxhash64("lang", "word"), F.lit(3))
    words.filter(own == 0).write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{path}/a")
    words.filter(own == 1).write.option("header", True).csv(f"{path}/b")
    marked = words.filter(own == 2).select(F.col("lang").alias("\ufefflang"), "word", "n")
    marked.write.option("header", True).csv(f"{path}/c")
    return report(csv.scan_csv_any_encoding(spark, [f"{path}/{x}" for x in "abc"], "lang string, word string, n bigint"))


@query("S2", sql(f"SELECT series_key, {YM} AS month, qty FROM prices", "prices"))
def csv_columns_by_name(spark, sf_dir):
    """Two file sets whose headers list the columns in another order, read by name."""
    df = roles.prices(spark, sf_dir).select("series_key", F.date_format("month", "yyyy-MM").alias("month"), F.col("qty").cast("string").alias("qty"), F.lit("x").alias("note"))
    df = materialize(df, "columns")
    path = new_folder(spark, "by-name")
    tables.write_csv(df.filter("month < '1995'"), f"{path}/a")
    tables.write_csv(df.filter("month >= '1995'").select("note", "qty", "month", "series_key"), f"{path}/b")
    scanned = csv.scan_csv_text(spark, [f"{path}/a", f"{path}/b"], ["series_key", "month", "qty"])
    return report(scanned.withColumn("qty", numeric.to_number("qty")))


@query("S12", sql(f"SELECT series_key, {YM} AS month, qty FROM prices", "prices"))
def json_array_files(spark, sf_dir):
    """One file for each series, each a single JSON array of records."""
    df = roles.prices(spark, sf_dir)
    points = F.array_sort(F.collect_list(F.struct("series_key", F.date_format("month", "yyyy-MM").alias("month"), "qty")))
    # a series has one record for each month
    files = df.groupBy("series_key").agg(F.to_json(points).alias("value"))
    path = new_folder(spark, "arrays")
    files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return report(json.scan_json(spark, path, "series_key string, month string, qty double"))


@query(
    "S7",
    sql("SELECT series_key, year(month) AS year, count(*) AS n, sum(qty) AS qty FROM prices GROUP BY 1, 2", "prices"),
)
def directory_scan(spark, sf_dir):
    """Yearly folders beside a metadata folder that must not be read."""
    root = new_folder(spark, "tree")
    df = roles.prices(spark, sf_dir).select("series_key", F.year("month").alias("year"), "month", "qty")
    df.withColumn("y", F.col("year")).write.partitionBy("y").option("header", True).csv(f"{root}/data")
    df.withColumn("qty", F.lit(-1.0)).write.option("header", True).csv(f"{root}/data/metadata")
    scanned = csv.scan_tree(spark, root, "series_key string, year int, month date, qty double")
    return report(scanned.groupBy("series_key", "year").agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty")))


# --- JSON ---------------------------------------------------------------------


def _vector_files(df, folder, *, status):
    """Documents per series in the nested raw shape; a series has one point per month."""
    docs = df.groupBy("series_key").agg(
        F.collect_list(F.struct(F.date_format("month", "yyyy-MM-dd").alias("refPer"), "value")).alias("vectorDataPoint")
    )
    payload = docs.select(
        status.alias("status"),
        F.struct(_brand_no().cast("bigint").alias("vectorId"), "vectorDataPoint").alias("object"),
    )
    path = new_folder(df.sparkSession, folder)
    payload.write.json(path)
    return path


@query(
    "S8 P16 J11 P6 F1 F26 C1",
    sql(
        f"""SELECT 'product ' || {BRAND_NO} AS series_key, {YM} AS month, price FROM prices WHERE {BRAND_NO} <= 20 AND {BRAND_NO} <> 3""",
        "prices",
    ),
)
def prices_silver(spark, sf_dir):
    status = F.when(_brand_no() == 3, "FAILED").otherwise("SUCCESS")
    path = _vector_files(_price(spark, sf_dir).withColumnRenamed("price", "value"), "vectors", status=status)
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("series_key")).distinct()
    vectors = brands.filter(_brand_no() <= 22).select(
        _brand_no().cast("bigint").alias("vector_id"),
        F.when(_brand_no() <= 20, "Canada").otherwise("Elsewhere").alias("geography"),
        F.concat_ws(" ", F.lit("product"), _brand_no().cast("string")).alias("product"),
    )
    payload = json.scan_json(spark, path, schemas.VECTOR_PAYLOAD, multi_line=False)
    return report(silver.prices(payload, vectors))


@query("S8 C2 F16", sql(f"SELECT {YM} AS month, cpi FROM cpi", "cpi"))
def cpi_silver(spark, sf_dir):
    df = roles.index(spark, sf_dir).select(F.lit("Index#1").alias("series_key"), "month", F.col("cpi").alias("value"))
    path = _vector_files(df, "cpi", status=F.lit("SUCCESS"))
    return report(silver.price_index(json.scan_json(spark, path, schemas.VECTOR_PAYLOAD, multi_line=False)))


@query(
    "S9 S10 J6 U1 C4",
    sql(
        f"""SELECT {YM} AS month, CASE WHEN month >= DATE '1997-01-01' OR discount >= 5 THEN discount END AS usd_cad,
        CASE WHEN month >= DATE '1997-01-01' OR tax >= 4 THEN tax END AS mxn_cad FROM rates
        WHERE month >= DATE '1997-01-01' OR discount >= 5 OR tax >= 4""",
        "rates",
    ),
)
def fx_silver(spark, sf_dir):
    """Early months as one document per series with gaps, later ones as grouped documents."""
    rates = roles.rates(spark, sf_dir)
    early, late = rates.filter(F.col("month") < month("1997-01-01")), rates.filter(F.col("month") >= month("1997-01-01"))

    def observation(**codes):
        fields = [F.struct(F.col(c).cast("string").alias("v")).alias(code) for code, c in codes.items()]
        return F.struct(F.date_format("month", "yyyy-MM-dd").alias("d"), *fields)

    def write(df, label, **codes):
        # one document per year, so that a document stays bounded
        docs = df.groupBy(F.year("month").alias("_y")).agg(F.collect_list(observation(**codes)).alias("observations"))
        path = new_folder(spark, label)
        docs.select("observations").write.json(path)
        return json.scan_json(spark, path, schemas.coded_series(*codes), multi_line=False)

    usd = write(early.filter(F.col("discount") >= 5), "usd", USD="discount")
    mxn = write(early.filter(F.col("tax") >= 4), "mxn", MXN="tax")
    both = write(late, "fx", USD="discount", MXN="tax")
    names = {"USD": "usd_cad", "MXN": "mxn_cad"}
    return report(silver.exchange_rates({"USD": usd, "MXN": mxn}, both, names))


@query(
    "S11 S12 J3 P19 A4 P18 C6",
    sql(
        f"""SELECT {YM} AS month, round(u, 6) AS us_cad_l, round(c, 6) AS ca_cad_l, round(u * 0.8 + c * 0.2, 6) AS integrated_gas_price FROM
        (SELECT month, cpi * tax / 3.78541 AS u FROM cpi JOIN rates USING (month))
        JOIN (SELECT month, avg(mean_c) / 100 AS c FROM regional GROUP BY 1) USING (month)""",
        "cpi",
        "rates",
        "regional",
    ),
)
def diesel_silver(spark, sf_dir):
    index = roles.index(spark, sf_dir)
    points = F.collect_list(F.struct(F.date_format("month", "yyyy-MM").alias("period"), F.col("cpi").cast("string").alias("value")))
    doc = index.groupBy(F.year("month").alias("_y")).agg(points.alias("data")).select(
        F.struct(F.size("data").cast("string").alias("total"), F.lit("YYYY-MM").alias("dateFormat"), F.lit("monthly").alias("frequency"), "data").alias("response")
    )
    us_path, city_path = new_folder(spark, "diesel"), new_folder(spark, "cities")
    doc.write.json(us_path)
    cities = roles.regional_values(spark, sf_dir).select(
        F.date_format("month", "yyyy-MM").alias("date"), F.col("state").alias("city"), F.col("mean_c").alias("value")
    )
    cities.write.json(city_path)
    readings = json.scan_json(spark, city_path, "date string, city string, value double", multi_line=False)
    readings = readings.select(dates.month_of_text("date").alias("month"), "city", "value")
    rates = roles.rates(spark, sf_dir).select("month", F.col("tax").alias("usd_cad"))
    us = silver.diesel_us(json.scan_json(spark, us_path, schemas.RESPONSE_PAYLOAD, multi_line=False), rates)
    return report(silver.diesel(us, silver.diesel_canada(readings)))


@query(
    "S12 P2 P7 P26 F16 C5",
    sql(
        """SELECT strftime(month, '%Y-%m-%d') AS day, CASE state WHEN 'ASIA' THEN 'Asia' ELSE state END AS state, mean_c,
        CASE WHEN n >= 20 THEN CAST(n AS DOUBLE) END AS precipitation_mm FROM regional WHERE state IN ('ASIA', 'EUROPE', 'AFRICA')""",
        "regional",
    ),
)
def weather_silver(spark, sf_dir):
    raw = roles.regional_values(spark, sf_dir).select(
        F.date_format("month", "yyyy-MM-dd").alias("PERIODO"),
        F.col("state").alias("ENTIDAD"),
        F.col("mean_c").cast("string").alias("MEDIA"),
        F.when(F.col("n") >= 20, F.col("n").cast("string")).otherwise(F.lit("sin dato")).alias("PRECIPITACION"),
    )
    path = new_folder(spark, "weather")
    raw.write.json(path)
    scanned = json.scan_json(spark, path, schemas.all_strings("PERIODO", "ENTIDAD", "MEDIA", "PRECIPITACION"), multi_line=False)
    names = {"PERIODO": "day", "ENTIDAD": "state", "MEDIA": "mean_c", "PRECIPITACION": "precipitation_mm"}
    return report(silver.weather(scanned, names, ["Asia", "EUROPE", "AFRICA"], {"ASIA": "Asia"}))


# --- Parquet layers and sinks -------------------------------------------------


@query("S13 K1", sql("SELECT series_key, strftime(month, '%Y-%m') AS month, spend FROM spend", "spend"))
def partitioned_dataset(spark, sf_dir):
    path = tables.Layers(new_folder(spark, "lake")).path("silver", "spend")
    tables.write_by_year(roles.spend(spark, sf_dir), path, files_per_year=2)
    return report(tables.scan_dataset(spark, path))


@query("S14", sql(f"SELECT series_key, {YM} AS month, spend FROM spend WHERE year(month) = 1998", "spend"))
def single_partition(spark, sf_dir):
    path = tables.Layers(new_folder(spark, "lake")).path("silver", "spend")
    tables.write_by_year(roles.spend(spark, sf_dir), path)
    return report(tables.scan_partition(spark, path, 1998))


@query(
    "K2 I3",
    sql(f"SELECT series_key, {YM} AS month, CASE WHEN year(month) = 1999 THEN -spend ELSE spend END AS spend FROM spend", "spend"),
)
def replace_partition(spark, sf_dir):
    path = new_folder(spark, "replace")
    df = roles.spend(spark, sf_dir)
    tables.write_by_year(df, path)
    tables.replace_years(df.filter(F.year("month") == 1999).withColumn("spend", -F.col("spend")), path)
    return report(tables.scan_dataset(spark, path))


@query(
    "I3 K2 W7 U1",
    sql(
        f"""SELECT series_key, {YM} AS month, CASE WHEN month >= DATE '1999-07-01' THEN -spend ELSE spend END AS spend FROM spend""",
        "spend",
    ),
)
def merge_into_years(spark, sf_dir):
    path = new_folder(spark, "merge-table")
    df = roles.spend(spark, sf_dir).withColumn("load_seq", F.lit(1))
    on = ["series_key", "month"]
    tables.merge_into_years(df.filter(F.col("month") < month("2000-01-01")), path, on, "load_seq")
    late = df.filter(F.col("month") >= month("1999-07-01"))
    tables.merge_into_years(late.withColumns({"spend": -F.col("spend"), "load_seq": F.lit(2)}), path, on, "load_seq")
    return report(tables.scan_dataset(spark, path).drop("load_seq"))


@query(
    "K4 F23 C13",
    sql(f"SELECT series_key AS product, {YM} AS date, price, forecast FROM merged", "prices", "cpi", **PUBLISHED),
)
def document_files(spark, sf_dir):
    path = new_folder(spark, "documents")
    tables.write_documents(publication.documents(_merged(spark, sf_dir)), path)
    schema = "product string, series array<struct<date:string,price:double,forecast:boolean>>"
    return report(json.scan_json(spark, path, schema, multi_line=False).select("product", F.inline("series")))


@query(
    "K5 F25",
    sql(f"SELECT series_key, {YM} AS month, price, year(month) AS year, month(month) AS month_no FROM prices", "prices"),
)
def raw_periods(spark, sf_dir):
    path = new_folder(spark, "raw")
    tables.write_raw_periods(_price(spark, sf_dir), path)
    schema = "series_key string, month date, price double, year int, month_no int"
    return report(json.scan_json(spark, path, schema, multi_line=False))


@query(
    "S16 I4",
    sql(f"SELECT series_key, {YM} AS month, CASE WHEN year(month) <= 1998 THEN price ELSE price * 2 END AS price FROM prices", "prices"),
)
def latest_snapshot(spark, sf_dir):
    """Two snapshots of the later years and one of the earlier: the newer one counts per year."""
    root = new_folder(spark, "snapshots")
    df = _price(spark, sf_dir).withColumn("year", F.year("month"))

    def snapshot(name, rows):
        rows.withColumn("snapshot", F.lit(name)).hint("rebalance", "year").write.mode("append").partitionBy("year", "snapshot").parquet(root)

    snapshot("2020-01", df)
    snapshot("2020-02", df.filter(F.col("year") > 1998).withColumn("price", F.col("price") * 2))
    newest = tables.latest_snapshot_dir(spark.read.parquet(root))
    return report(newest.select("series_key", "month", "price"), 4)


def _committed(spark, sf_dir):
    """Two snapshots, of which the second has the later years at twice the price."""
    store = snapshots.SnapshotTable(spark, new_folder(spark, "retained"))
    df = materialize(_price(spark, sf_dir).withColumn("year", F.year("month")), "prices")
    store.commit(df, "2020-01")
    store.commit(df.filter(F.col("year") > 1998).withColumn("price", F.col("price") * 2), "2020-02")
    return store


@query(
    "K6",
    sql("SELECT '2020-01' AS snapshot, CAST(year(month) AS VARCHAR) AS period, count(*) AS n_rows, '2020-02' AS superseded_by FROM prices WHERE year(month) > 1998 GROUP BY 2", "prices"),
)
def superseded_snapshots(spark, sf_dir):
    """What a commit put out of use, listed by the manifest."""
    return report(_committed(spark, sf_dir).superseded())


@query(
    "K6 S16 I4",
    sql(f"SELECT series_key, {YM} AS month, CASE WHEN year(month) <= 1998 THEN price ELSE price * 2 END AS price, CASE WHEN year(month) <= 1998 THEN '2020-01' ELSE '2020-02' END AS snapshot FROM prices", "prices"),
)
def retained_snapshots(spark, sf_dir):
    """What is left after the superseded files are dropped."""
    store = _committed(spark, sf_dir)
    store.drop_superseded()
    return report(store.read().select("series_key", "month", "price", "snapshot"), 4)


@query(
    "I1 I2 S16",
    sql(
        f"""SELECT series_key, {YM} AS month, price, CAST(least(greatest(year(month), 1996), 1998) AS VARCHAR) AS snapshot, 1 AS n_reads FROM prices""",
        "prices",
    ),
)
def polled_snapshots(spark, sf_dir):
    """Two snapshots, a poll, a third one and two more polls: each snapshot is read once."""
    root, out, state = (new_folder(spark, n) for n in ("polled", "polls", "poll-state"))
    df = materialize(_price(spark, sf_dir).withColumn("name", F.least(F.greatest(F.year("month"), F.lit(1996)), F.lit(1998)).cast("string")), "prices")

    def arrive(name):
        df.filter(F.col("name") == name).drop("name").write.parquet(f"{root}/{name}")

    def poll():
        stream = polled.read_snapshots(spark, root, "series_key string, month date, price double, snapshot string")
        loads.run_available(stream, state, loads.append_to(out), mode="append")

    arrive("1996")
    arrive("1997")
    poll()
    arrive("1998")
    poll()
    poll()
    found = spark.read.parquet(out).groupBy("series_key", "month", "price", "snapshot").agg(F.count(F.lit(1)).alias("n_reads"))
    return report(found)


@query("S17", sql("SELECT DISTINCT year(month) AS year, 1 AS n_files, TRUE AS is_single FROM spend", "spend"))
def exactly_one_file(spark, sf_dir):
    path = new_folder(spark, "single")
    tables.write_by_year(roles.spend(spark, sf_dir), path, files_per_year=1)
    return report(tables.file_counts(tables.require_single_file(spark.read.parquet(path), "year"), "year"))


# --- streams ------------------------------------------------------------------


@query(
    "I10",
    sql(
        """SELECT series_key, strftime(day, '%Y-%m-%d') AS day, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM readings GROUP BY 1, 2""",
        "readings",
    ),
)
def stream_daily(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    stream = loads.read_files(spark, f"{sf_dir}/events*.parquet", schema)
    rows = stream.select(F.col("event_type").alias("series_key"), "ts", "value")
    path = new_folder(spark, "daily")
    sums = {"n": F.count(F.lit(1)), "total": F.sum(numeric.hundredths("value"))}
    write = loads.totals_to(path, "series_key", "ts", sums)
    loads.run_available(rows, new_folder(spark, "daily-state"), write, mode="append")
    totals = loads.totals_of_batches(spark, path, "series_key", list(sums))
    return report(totals.withColumn("total", F.col("total") / 100.0))


@query(
    "I10",
    sql(
        """SELECT series_key, strftime(day, '%Y-%m-%d') AS day, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM readings GROUP BY 1, 2""",
        "readings",
    ),
)
def stream_windows(spark, sf_dir):
    """Event-time windows with a watermark; the older half arrives last, and comes in by the correction path."""
    root, windows, late = (new_folder(spark, n) for n in ("arrivals", "windows", "late"))
    rows = roles.readings(spark, sf_dir).select("series_key", "ts", "value")
    middle = rows.agg(F.percentile_approx("ts", 0.5)).first()[0]
    sums = {"n": F.count(F.lit(1)), "total": F.sum(numeric.hundredths("value"))}
    states = [new_folder(spark, n) for n in ("windows-state", "late-state")]
    for newer in (True, False):
        rows.filter((F.col("ts") >= middle) == F.lit(newer)).write.mode("append").parquet(root)
        stream = loads.read_files(spark, root, rows.schema)
        totals = loads.period_totals(stream, "series_key", "ts", [c.alias(n) for n, c in sums.items()])
        loads.run_available(totals, states[0], loads.append_to(windows), mode="update")
        loads.run_available(stream, states[1], loads.late_to(late, "series_key", "ts", sums), mode="append")
    totals = loads.totals_with_late(spark, windows, late, "series_key", list(sums))
    return report(totals.withColumn("total", F.col("total") / 100.0))


def _event_files(spark, sf_dir, label):
    """The events in files of their own, some of which arrive with each batch."""
    path = new_folder(spark, label)
    rows = roles.readings(spark, sf_dir).select("series_key", "user_id", "day", "value", "event_id")
    for part in range(3):
        rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part).write.mode("append").parquet(path)
    return loads.read_files(spark, path, rows.schema, files_per_batch=1)


@query(
    "I3",
    sql(
        """SELECT series_key, user_id, strftime(day, '%Y-%m-%d') AS day, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM readings GROUP BY 1, 2, 3""",
        "readings",
    ),
)
def stream_upsert(spark, sf_dir):
    path = new_folder(spark, "stream-table")
    on = ["series_key", "user_id", "day"]
    stream = _event_files(spark, sf_dir, "arrivals")
    loads.run_available(stream, new_folder(spark, "upsert-state"), loads.upsert_to(path, on, "event_id", "day"), mode="append")
    return report(tables.scan_or_empty(spark, path, stream.schema))


@query(
    "I9",
    sql(
        """SELECT series_key, user_id, strftime(day, '%Y-%m-%d') AS day, event_id, forecast FROM
        (SELECT *, value < 30 AS forecast FROM readings) QUALIFY row_number() OVER
        (PARTITION BY series_key, user_id, day ORDER BY forecast, event_id DESC) = 1""",
        "readings",
    ),
)
def stream_settle(spark, sf_dir):
    """Winners as keyed state: each batch gives the keys that changed, and no stored year is rewritten."""
    path = new_folder(spark, "settled")
    on = ["series_key", "user_id", "day"]
    stream = _event_files(spark, sf_dir, "arrivals").withColumn("forecast", F.col("value") < 30).drop("value")
    winners = loads.settled(stream, on, order="event_id", time="day", expire="400 days")
    loads.run_available(winners, new_folder(spark, "settle-state"), loads.append_to(path), mode="update")
    return report(loads.latest_of_batches(spark, path, on))


@query(
    "I9",
    sql(
        """SELECT series_key, user_id, strftime(day, '%Y-%m-%d') AS day, event_id, forecast FROM
        (SELECT *, value < 30 AS forecast FROM readings) QUALIFY row_number() OVER
        (PARTITION BY series_key, user_id, day ORDER BY forecast, event_id DESC) = 1""",
        "readings",
    ),
)
def stream_settle_years(spark, sf_dir):
    """The same winners in a table partitioned by year, of which each batch replaces the years it touches."""
    path = new_folder(spark, "settled-table")
    on = ["series_key", "user_id", "day"]
    stream = _event_files(spark, sf_dir, "arrivals").withColumn("forecast", F.col("value") < 30).drop("value")
    loads.run_available(
        stream, new_folder(spark, "settle-state"), loads.settle_to(path, on, order="event_id", time="day"), mode="append"
    )
    return report(tables.scan_or_empty(spark, path, stream.schema))
