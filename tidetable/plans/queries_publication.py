"""Catalog: nominal forecasts, documents, display summaries and incremental merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidetable.functions import dates
from tidetable.operators import incremental, joins, ranking
from tidetable.plans import publication, roles
from tidetable.plans.catalog import query, report
from tidetable.plans.roles import BASE_MONTH, START_MONTH, month, sql, table
from tidetable.session import materialize

YM = "strftime(month, '%Y-%m')"
LAST_ACTUAL = "2001-10-01"

# Forecasts of a year ahead: last year's price with a band around it; two loads, the second one wins.
FORECASTS = """SELECT series_key, CAST(month + INTERVAL 12 MONTH AS DATE) AS month, price AS prediction, round(price * 0.9, 4) AS lower_bound,
    round(price * 1.1, 4) AS upper_bound FROM prices WHERE month >= DATE '2000-09-01'"""
NOMINAL = f"""SELECT f.series_key, f.month, round(f.prediction * c.cpi / b.base, 2) AS price, round(f.lower_bound * c.cpi / b.base, 2) AS lower_bound,
    round(f.upper_bound * c.cpi / b.base, 2) AS upper_bound FROM forecasts f ASOF JOIN cpi c ON f.month >= c.month
    CROSS JOIN (SELECT cpi AS base FROM cpi WHERE month = DATE '{BASE_MONTH}') b"""
MERGED = f"""SELECT series_key, month, round(price, 2) AS price, FALSE AS forecast, NULL AS lower_bound, NULL AS upper_bound FROM prices
    WHERE month >= DATE '{START_MONTH}' AND month <= DATE '{LAST_ACTUAL}'
    UNION ALL SELECT n.series_key, n.month, n.price, TRUE, n.lower_bound, n.upper_bound FROM nominal n
    ANTI JOIN (SELECT series_key, month FROM prices WHERE month >= DATE '{START_MONTH}' AND month <= DATE '{LAST_ACTUAL}') a
    ON a.series_key = n.series_key AND a.month = n.month"""
PUBLISHED = {"forecasts": FORECASTS, "nominal": NOMINAL, "merged": MERGED}


def _forecasts(prices):
    p = prices.filter(F.col("month") >= month("2000-09-01"))
    final = p.select(
        "series_key",
        F.add_months("month", 12).alias("month"),
        F.col("price").alias("prediction"),
        F.round(F.col("price") * 0.9, 4).alias("lower_bound"),
        F.round(F.col("price") * 1.1, 4).alias("upper_bound"),
        F.lit(2).alias("load_seq"),
    )
    first = final.withColumns({"prediction": F.col("prediction") * 2, "load_seq": F.lit(1)})
    return first.unionByName(final)


def _merged(spark, sf_dir):
    prices = roles.price_layer(spark, sf_dir)
    actual = prices.filter(F.col("month") <= month(LAST_ACTUAL)).select("series_key", "month", F.round("price", 2).alias("price"), F.lit(1).alias("load_seq"))
    nominal = publication.nominal_forecast(_forecasts(prices), roles.index(spark, sf_dir), month(BASE_MONTH))
    return publication.merged_series(actual, nominal, start=month(START_MONTH))


@query(
    "C14 W7 J13 J8 P21 P13",
    sql(f"SELECT series_key, {YM} AS month, price, lower_bound, upper_bound, TRUE AS forecast FROM nominal", "prices", "cpi", forecasts=FORECASTS, nominal=NOMINAL),
)
def nominal_forecast(spark, sf_dir):
    prices = roles.price_layer(spark, sf_dir)
    out = publication.nominal_forecast(_forecasts(prices), roles.index(spark, sf_dir), month(BASE_MONTH))
    return report(out)


HEADER = f"""SELECT a.series_key, f.month AS prediction_month, f.price AS forecast_price, round((f.price - a.price) / a.price * 100, 1) + 0.0 AS change_pct
    FROM (SELECT series_key, max(month) AS last, arg_max(price, month) AS price FROM merged WHERE NOT forecast GROUP BY 1) a
    LEFT JOIN (SELECT m.series_key, min(m.month) AS month, arg_min(m.price, m.month) AS price FROM merged m JOIN
    (SELECT series_key, max(month) AS last FROM merged WHERE NOT forecast GROUP BY 1) l ON l.series_key = m.series_key AND m.month > l.last
    WHERE m.forecast GROUP BY 1) f USING (series_key)"""


@query(
    "C13 W7 P10 J9 U2 W10 W18 F23 F27 A10 X3",
    sql(
        f"""SELECT m.series_key AS product, 'kg' AS unit_label, strftime(h.prediction_month, '%B %Y') AS prediction_month, h.forecast_price, h.change_pct,
        strftime(m.month, '%Y-%m') AS date, m.price, m.forecast, m.lower_bound, m.upper_bound FROM merged m JOIN header h USING (series_key)""",
        "prices",
        "cpi",
        **PUBLISHED,
        header=HEADER,
    ),
)
def app_document(spark, sf_dir):
    """Documents as JSON text, parsed back and flattened."""
    docs = publication.as_json(publication.documents(_merged(spark, sf_dir)))
    schema = (
        "product string, unit_label string, prediction_month string, forecast_price double, change_pct double, "
        "series array<struct<date:string,price:double,forecast:boolean,lower_bound:double,upper_bound:double>>"
    )
    parsed = docs.select(F.from_json("document", schema).alias("d")).select("d.*")
    return report(parsed.select("product", "unit_label", "prediction_month", "forecast_price", "change_pct", F.inline("series")))


@query(
    "W18 W9 W10",
    sql(
        "SELECT series_key, strftime(prediction_month, '%Y-%m') AS prediction_month, forecast_price, change_pct FROM header",
        "prices",
        "cpi",
        **PUBLISHED,
        header=HEADER,
    ),
)
def first_future_change(spark, sf_dir):
    return report(ranking.change_of_first_future(_merged(spark, sf_dir)))


@query(
    "C15 T5 T6 W15 F12 F28",
    sql(
        """SELECT series_key, 'Pricing per kg' AS unit_label, strftime(chosen, '%B %Y') AS prediction_month, price AS forecast_price,
        coalesce(round((price - before) / nullif(before, 0) * 100, 1), 0) + 0.0 AS change_pct FROM
        (SELECT c.series_key, c.chosen, max(CASE WHEN m.month = c.chosen AND m.forecast THEN m.price END) AS price,
         arg_max(CASE WHEN m.month < c.chosen THEN m.price END, CASE WHEN m.month < c.chosen THEN m.month END) AS before
         FROM merged m JOIN (SELECT series_key, coalesce(max(CASE WHEN month = DATE '2001-12-01' THEN month END),
           min(CASE WHEN month > DATE '2001-12-01' THEN month END), max(month)) AS chosen FROM merged WHERE forecast GROUP BY 1) c
         USING (series_key) GROUP BY 1, 2)""",
        "prices",
        "cpi",
        **PUBLISHED,
    ),
)
def display_summary(spark, sf_dir):
    return report(publication.display_summary(_merged(spark, sf_dir), dates.next_month(month("2001-11-15"))))


BRAND_NO = "CAST(substr(series_key, 7) AS INT)"


@query(
    "C15 F28",
    sql(
        f"""SELECT series_key, CASE WHEN {BRAND_NO} = 11 THEN 'Pricing per unit' WHEN {BRAND_NO} % 3 = 0 AND {BRAND_NO} < 40 THEN 'Pricing per lb' ELSE 'Pricing per kg' END AS unit_label,
        CASE WHEN forecasts > 0 THEN strftime(chosen, '%B %Y') WHEN {BRAND_NO} < 40 THEN 'January 2002' ELSE 'No prediction yet' END AS prediction_month,
        CASE WHEN forecasts > 0 THEN price WHEN {BRAND_NO} < 40 THEN {BRAND_NO} + 0.5 ELSE 0 END AS forecast_price,
        CASE WHEN forecasts > 0 THEN coalesce(round((price - before) / nullif(before, 0) * 100, 1), 0) + 0.0 WHEN {BRAND_NO} < 40 THEN 1.5 ELSE 0 END AS change_pct FROM
        (SELECT c.series_key, c.chosen, c.forecasts, max(CASE WHEN m.month = c.chosen AND m.forecast THEN m.price END) AS price,
         arg_max(CASE WHEN m.month < c.chosen THEN m.price END, CASE WHEN m.month < c.chosen THEN m.month END) AS before
         FROM kept m JOIN (SELECT series_key, count_if(forecast) AS forecasts, coalesce(max(CASE WHEN forecast AND month = DATE '2001-12-01' THEN month END),
           min(CASE WHEN forecast AND month > DATE '2001-12-01' THEN month END), max(CASE WHEN forecast THEN month END)) AS chosen FROM kept GROUP BY 1) c
         USING (series_key) GROUP BY 1, 2, 3)""",
        "prices",
        "cpi",
        **PUBLISHED,
        kept=f"SELECT * FROM merged WHERE NOT (forecast AND {BRAND_NO} % 2 = 0)",
    ),
)
def stored_summary(spark, sf_dir):
    """Summaries of series of which half have no forecast: they show their stored header, if there is one."""
    number = F.regexp_extract("series_key", r"#(\d+)$", 1).cast("int")
    merged = materialize(_merged(spark, sf_dir), "merged")
    stored = (
        merged.select("series_key")
        .distinct()
        .filter(number < 40)
        .select(
            "series_key",
            F.when(number % 3 == 0, "lb").otherwise("kg").alias("unit_label"),
            F.lit("January 2002").alias("prediction_month"),
            (number + 0.5).cast("double").alias("forecast_price"),
            F.lit(1.5).alias("change_pct"),
        )
    )
    kept = merged.filter(~(F.col("forecast") & (number % 2 == 0)))
    summary = publication.display_summary(kept, dates.next_month(month("2001-11-15")), stored=stored, per_unit=number == 11)
    return report(summary)


@query(
    "P25",
    sql(
        f"""SELECT series_key, {YM} AS month, CASE WHEN NOT forecast THEN 'historical' WHEN month <= DATE '2001-12-01' THEN 'delayed' ELSE 'forecast' END AS phase FROM merged""",
        "prices",
        "cpi",
        **PUBLISHED,
    ),
)
def forecast_phases(spark, sf_dir):
    return report(publication.phases(_merged(spark, sf_dir), month("2001-12-01")).select("series_key", "month", "phase"))


@query(
    "F29",
    sql(
        """SELECT series_key, round(lo - greatest((hi - lo) * 0.15, 0.12), 4) AS chart_low, round(hi + greatest((hi - lo) * 0.15, 0.12), 4) AS chart_high
        FROM (SELECT series_key, min(price) AS lo, max(price) AS hi FROM merged GROUP BY 1)""",
        "prices",
        "cpi",
        **PUBLISHED,
    ),
)
def chart_range(spark, sf_dir):
    return report(publication.chart_range(_merged(spark, sf_dir)), 4)


# --- incremental --------------------------------------------------------------


def _split(spark, sf_dir, cut: str):
    rows = roles.readings(spark, sf_dir).select("series_key", "user_id", "day", "value", "event_id")
    return rows.filter(F.col("day") <= F.lit(cut).cast("date")), rows


@query(
    "I1",
    sql(
        """SELECT r.series_key, strftime(r.day, '%Y-%m-%d') AS day, r.event_id FROM readings r LEFT JOIN
        (SELECT series_key, max(day) AS stored FROM readings WHERE day <= DATE '2024-01-20' AND series_key <> 'view' GROUP BY 1) t USING (series_key)
        WHERE t.stored IS NULL OR r.day > t.stored""",
        "readings",
    ),
)
def fresh_gate(spark, sf_dir):
    stored, source = _split(spark, sf_dir, "2024-01-20")
    target = stored.filter(F.col("series_key") != "view")
    return report(incremental.fresh_rows(source, target, "series_key", "day").select("series_key", "day", "event_id"))


@query(
    "I2 U5",
    sql(
        """SELECT user_id, strftime(day, '%Y-%m-%d') AS day FROM readings WHERE series_key = 'view'
        EXCEPT SELECT user_id, strftime(day, '%Y-%m-%d') FROM readings WHERE series_key = 'click'""",
        "readings",
    ),
)
def new_periods(spark, sf_dir):
    rows = roles.readings(spark, sf_dir).select("series_key", "user_id", "day")
    view, click = (rows.filter(F.col("series_key") == k) for k in ("view", "click"))
    return report(incremental.new_periods(view, click, "user_id", "day"))


@query(
    "I3 U1 W7",
    sql(
        """SELECT series_key, user_id, strftime(day, '%Y-%m-%d') AS day, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM readings GROUP BY 1, 2, 3""",
        "readings",
    ),
)
def upsert_keep_last(spark, sf_dir):
    stored, source = _split(spark, sf_dir, "2024-01-20")
    new = source.filter(F.col("day") >= F.lit("2024-01-15").cast("date"))
    return report(incremental.upsert(stored, new, ["series_key", "user_id", "day"], "event_id"))


@query(
    "I4",
    sql(
        """SELECT series_key, strftime(day, '%Y-%m-%d') AS day, event_id FROM readings WHERE day < DATE '2024-01-15'
        UNION ALL SELECT series_key, strftime(day, '%Y-%m-%d') AS day, event_id FROM readings WHERE day >= DATE '2024-01-15' AND value > 20""",
        "readings",
    ),
)
def snapshot_replace(spark, sf_dir):
    """A corrected snapshot of the second half of the month replaces its days."""
    _, rows = _split(spark, sf_dir, "2024-01-31")
    covered = F.col("day") >= F.lit("2024-01-15").cast("date")
    snapshot = rows.filter(covered & (F.col("value") > 20))
    return report(incremental.replace_periods(rows, snapshot, "day", covered).select("series_key", "day", "event_id"))


@query(
    "I5",
    sql(
        """SELECT series_key, user_id, strftime(day, '%Y-%m-%d') AS day, event_id FROM readings r
        WHERE day = (SELECT max(day) FROM readings x WHERE x.series_key = r.series_key AND x.user_id = r.user_id)""",
        "readings",
    ),
)
def newest_period(spark, sf_dir):
    rows = roles.readings(spark, sf_dir).select("series_key", "user_id", "day", "event_id")
    return report(incremental.newest_period(rows, ["series_key", "user_id"], "day"))


@query(
    "I6",
    sql(
        "SELECT series_key, strftime(max(month), '%Y-%m') AS latest_common FROM spend JOIN cpi USING (month) WHERE cpi >= 150 GROUP BY 1",
        "spend",
        "cpi",
    ),
)
def latest_common(spark, sf_dir):
    months = roles.index(spark, sf_dir).filter(F.col("cpi") >= 150)
    spend = materialize(roles.spend(spark, sf_dir), "spend")
    # the index has no series: every month of it counts for each series
    usable = joins.at_month(spend, months).select(*spend.columns)
    return report(incremental.latest_common(spend, usable))


@query(
    "I7",
    """SELECT o_orderpriority AS dataset, y AS year FROM (SELECT DISTINCT o_orderpriority FROM orders) CROSS JOIN
    (SELECT unnest(range(1995, 2003)) AS y) EXCEPT SELECT o_orderpriority, year(o_orderdate) FROM orders""",
)
def ready_gate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("dataset"), F.year("o_orderdate").cast("bigint").alias("year")
    )
    years = F.explode(F.sequence(F.lit(1995).cast("bigint"), F.lit(2002).cast("bigint"))).alias("year")
    required = orders.select("dataset").distinct().select("dataset", years)
    return report(incremental.missing_inputs(required, orders, ["dataset", "year"]))


@query(
    "I9 J9",
    sql(
        """SELECT series_key, user_id, strftime(day, '%Y-%m-%d') AS day, event_id, forecast FROM
        (SELECT *, value < 30 AS forecast FROM readings) QUALIFY row_number() OVER
        (PARTITION BY series_key, user_id, day ORDER BY forecast, event_id DESC) = 1""",
        "readings",
    ),
)
def settle_actuals(spark, sf_dir):
    rows = roles.readings(spark, sf_dir).select("series_key", "user_id", "day", "event_id", (F.col("value") < 30).alias("forecast"))
    return report(incremental.settle(rows, ["series_key", "user_id", "day"], order="event_id"))


