"""Catalog: offsets, fills, picks, correlations, scaling and decomposition."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidetable.functions import numeric
from tidetable.operators import calendar, joins, panel, ranking, stationarity, stats, windows
from tidetable.plans import features as feature_plans
from tidetable.plans import roles, studies
from tidetable.plans.catalog import query, report
from tidetable.plans.roles import HORIZON_END, LAGS, START_MONTH, month, sql
from tidetable.session import materialize

YM = "strftime(month, '%Y-%m')"
W = "OVER (PARTITION BY series_key ORDER BY month)"
DRIVERS = ("import_qty", "order_value", "discount", "tax")


def _price(spark, sf_dir):
    return roles.prices(spark, sf_dir).select("series_key", "month", "price")


# --- offsets ------------------------------------------------------------------


@query(
    "W1",
    sql(
        f"""SELECT f.series_key, strftime(f.month, '%Y-%m') AS month, f.import_qty AS import_qty_lag_0, a.order_value AS order_value_lag_2,
        b.discount AS discount_lag_1, c.tax AS tax_lag_7 FROM features f
        LEFT JOIN features a ON a.series_key = f.series_key AND a.month = f.month - INTERVAL 2 MONTH
        LEFT JOIN features b ON b.series_key = f.series_key AND b.month = f.month - INTERVAL 1 MONTH
        LEFT JOIN features c ON c.series_key = f.series_key AND c.month = f.month - INTERVAL 7 MONTH""",
        "features",
    ),
)
def lag_map(spark, sf_dir):
    return report(windows.lag_map(roles.features(spark, sf_dir), LAGS))


@query(
    "W1 W2",
    sql(
        f"""SELECT series_key, {YM} AS month, spend, lag(spend, 1) {W} AS spend_lag_1, lag(spend, 2) {W} AS spend_lag_2,
        lag(spend, 3) {W} AS spend_lag_3, lag(spend, 6) {W} AS spend_lag_6, lag(spend, 12) {W} AS spend_lag_12 FROM spend""",
        "spend",
    ),
)
def target_lags(spark, sf_dir):
    return report(windows.target_lags(roles.spend(spark, sf_dir), "spend"))


@query(
    "W1",
    sql(
        f"""SELECT a.series_key, strftime(a.month, '%Y-%m') AS month, b.spend AS spend_lag_1, c.spend AS spend_lag_12 FROM spend a
        LEFT JOIN spend b ON a.series_key = b.series_key AND b.month = a.month - INTERVAL 1 MONTH
        LEFT JOIN spend c ON a.series_key = c.series_key AND c.month = a.month - INTERVAL 12 MONTH""",
        "spend",
    ),
)
def calendar_lags(spark, sf_dir):
    lagged = windows.target_lags(roles.spend(spark, sf_dir), "spend", (1, 12), mode="calendar")
    return report(lagged.drop("spend"))


@query(
    "W3",
    sql(f"SELECT series_key, {YM} AS month, round(price - lag(price) {W}, 4) + 0.0 AS price_diff FROM prices", "prices"),
)
def first_difference(spark, sf_dir):
    return report(windows.difference(_price(spark, sf_dir), ["price"]).drop("price"), 4)


FILL = f"""SELECT series_key, {YM} AS month, coalesce(spend, lag(spend, 12) {W}, lag(spend, 24) {W}) AS spend FROM spend_aligned"""


@query("W4", sql(FILL, "spend_aligned"))
def seasonal_fill(spark, sf_dir):
    return report(windows.seasonal_fill(calendar.align(roles.spend(spark, sf_dir)), ["spend"]))


@query(
    "W5",
    sql(
        f"""SELECT series_key, {YM} AS month, last_value(spend IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY month
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spend FROM spend_aligned""",
        "spend_aligned",
    ),
)
def ffill(spark, sf_dir):
    return report(windows.forward_fill(calendar.align(roles.spend(spark, sf_dir)), ["spend"]))


@query(
    "W6",
    sql(
        f"""SELECT series_key, {YM} AS month, CASE WHEN spend IS NOT NULL THEN spend WHEN n1 IS NULL THEN v0
        ELSE v0 + (v1 - v0) * ((rn - n0)::DOUBLE / (n1 - n0)) END AS spend FROM (SELECT series_key, month, spend, rn,
        last_value(CASE WHEN spend IS NOT NULL THEN rn END IGNORE NULLS) OVER back AS n0, last_value(spend IGNORE NULLS) OVER back AS v0,
        first_value(CASE WHEN spend IS NOT NULL THEN rn END IGNORE NULLS) OVER ahead AS n1, first_value(spend IGNORE NULLS) OVER ahead AS v1
        FROM (SELECT *, row_number() {W} AS rn FROM spend_aligned)
        WINDOW back AS (PARTITION BY series_key ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        ahead AS (PARTITION BY series_key ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
        "spend_aligned",
    ),
)
def interpolate(spark, sf_dir):
    aligned = calendar.align(roles.spend(spark, sf_dir))
    return report(windows.interpolate(aligned, ["spend"]), None)


@query(
    "W7",
    sql(
        """SELECT series_key, user_id, strftime(day, '%Y-%m-%d') AS day, value, event_id FROM readings
        QUALIFY row_number() OVER (PARTITION BY series_key, user_id, day ORDER BY event_id DESC) = 1""",
        "readings",
    ),
)
def dedup_keep_last(spark, sf_dir):
    rows = roles.readings(spark, sf_dir).select("series_key", "user_id", "day", "value", "event_id")
    return report(panel.keep_last(rows, ["series_key", "user_id", "day"], "event_id"))


@query("W8", sql(f"SELECT series_key, {YM} AS month, row_number() {W} AS row_no FROM spend", "spend"))
def row_numbers(spark, sf_dir):
    return report(windows.number_rows(roles.spend(spark, sf_dir)).drop("spend"))


@query(
    "W9",
    sql(
        f"SELECT series_key, {YM} AS month, spend FROM spend QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY month DESC) = 1",
        "spend",
    ),
)
def latest_per_series(spark, sf_dir):
    return report(panel.latest_per_series(roles.spend(spark, sf_dir)))


@query(
    "W10",
    sql(
        f"""SELECT series_key, {YM} AS month, spend FROM spend WHERE month > DATE '1999-06-01'
        QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY month) = 1""",
        "spend",
    ),
)
def first_after(spark, sf_dir):
    return report(panel.first_after(roles.spend(spark, sf_dir), month("1999-06-01")))


@query(
    "W11",
    sql(
        f"""SELECT series_key, {YM} AS month, count(qty) OVER past AS n_past, sum(qty) OVER past AS past_qty,
        max(qty) OVER past AS past_max FROM prices WINDOW past AS (PARTITION BY series_key ORDER BY month
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
        "prices",
    ),
)
def expanding_stats(spark, sf_dir):
    df = roles.prices(spark, sf_dir).select("series_key", "month", "qty")
    aggs = {"n_past": F.count("qty"), "past_qty": F.sum("qty"), "past_max": F.max("qty")}
    return report(windows.expanding(df, aggs).drop("qty"))


@query(
    "W13",
    sql(f"SELECT series_key, {YM} AS month, price FROM prices QUALIFY (row_number() {W} - 1) % 3 = 0", "prices"),
)
def every_nth(spark, sf_dir):
    return report(windows.every_nth(_price(spark, sf_dir), 3))


@query(
    "W14",
    sql(
        f"SELECT series_key, {YM} AS month, price FROM prices QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY month DESC) <= 12",
        "prices",
    ),
)
def last_n(spark, sf_dir):
    return report(windows.last_n(_price(spark, sf_dir), 12))


@query(
    "W15",
    sql(
        f"""SELECT series_key, {YM} AS month, coalesce(round((price - lag(price) {W}) / nullif(lag(price) {W}, 0) * 100, 1), 0) + 0.0 AS change_pct FROM prices""",
        "prices",
    ),
)
def pct_change(spark, sf_dir):
    return report(windows.change_from_previous(_price(spark, sf_dir), "price").drop("price"))


@query(
    "W16",
    sql(
        """SELECT h.series_key, strftime(last_month, '%Y-%m') AS last_month, strftime(first_future, '%Y-%m') AS first_future,
        coalesce(first_future = last_month + INTERVAL 1 MONTH, FALSE) AS is_continuous FROM
        (SELECT series_key, max(month) AS last_month FROM spend WHERE month <= DATE '1999-06-01' GROUP BY 1) h LEFT JOIN
        (SELECT series_key, min(month) AS first_future FROM spend WHERE month > DATE '1999-06-01' GROUP BY 1) f USING (series_key)""",
        "spend",
    ),
)
def continuity(spark, sf_dir):
    df, cut = roles.spend(spark, sf_dir), month("1999-06-01")
    return report(calendar.continues(df.filter(F.col("month") <= cut), df.filter(F.col("month") > cut)))


LAG_TABLE = "(SELECT 'discount' AS feature, 1 AS lag UNION ALL SELECT 'discount', 12 UNION ALL SELECT 'tax', 7)"


@query(
    "W17",
    sql(
        f"""SELECT series_key, strftime(month + lag * INTERVAL 1 MONTH, '%Y-%m') AS month, feature || '_lag_' || lag AS feature, value
        FROM (SELECT series_key, month, unnest(['discount', 'tax']) AS feature, unnest([discount, tax]) AS value FROM features)
        JOIN {LAG_TABLE} USING (feature)""",
        "features",
    ),
)
def lags_from_table(spark, sf_dir):
    long = roles.features(spark, sf_dir).unpivot(["series_key", "month"], ["discount", "tax"], "feature", "value")
    chosen = [("discount", 1), ("discount", 12), ("tax", 7)]
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(k).alias("lag")) for f, k in chosen])
    lags = spark.range(1).select(F.inline(pairs))
    return report(windows.lags_from_table(long, lags))


@query(
    "W19",
    sql(
        f"""SELECT series_key, {YM} AS month, price FROM (SELECT *, row_number() {W} - 1 AS rn, count(*) OVER (PARTITION BY series_key) AS n FROM prices)
        WHERE rn IN (0, CAST(round((n - 1) / 3.0) AS INT), CAST(round(2 * (n - 1) / 3.0) AS INT), n - 1)""",
        "prices",
    ),
)
def spread_points(spark, sf_dir):
    return report(windows.spread_points(_price(spark, sf_dir), 4))


@query(
    "T3",
    sql(
        """SELECT series_key, month, gap FROM (SELECT series_key, strftime(month, '%Y-%m') AS month, round(abs(price - lag(price) OVER (PARTITION BY series_key ORDER BY month)), 4) AS gap FROM prices)
        WHERE gap IS NOT NULL QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY gap DESC, month) <= 5""",
        "prices",
    ),
)
def topk_errors(spark, sf_dir):
    gaps = windows.difference(_price(spark, sf_dir), ["price"]).withColumn("gap", F.round(F.abs("price_diff"), 4))
    rows = gaps.filter(F.col("gap").isNotNull()).select("series_key", "month", "gap")
    return report(ranking.top_k_per_group(rows, 5, "gap", "series_key", "month"))


# --- correlation --------------------------------------------------------------

LAGGED = """SELECT f.series_key, v.feature, k.lag, f.d_price AS y, CASE v.feature WHEN 'import_qty' THEN g.d_qty ELSE g.d_value END AS x
    FROM d f CROSS JOIN (SELECT unnest(['import_qty', 'order_value']) AS feature) v CROSS JOIN (SELECT unnest(range(0, 13)) AS lag) k
    LEFT JOIN d g ON g.series_key = f.series_key AND g.rn = f.rn {sign} k.lag"""
DIFFED = f"""SELECT series_key, month, price - lag(price) {W} AS d_price, import_qty - lag(import_qty) {W} AS d_qty,
    order_value - lag(order_value) {W} AS d_value, row_number() {W} AS rn
    FROM features JOIN (SELECT series_key, month, price FROM prices) USING (series_key, month)"""


def _changes(spark, sf_dir):
    df = roles.features(spark, sf_dir, with_price=True)
    changed = windows.difference(df, ["price", "import_qty", "order_value"], suffix="")
    return changed.select("series_key", "month", "price", "import_qty", "order_value")


@query(
    "A18 F17",
    sql(
        """SELECT series_key, feature, lag, round(coalesce(CASE WHEN isnan(r) THEN 0 ELSE r END, 0), 6) + 0.0 AS correlation
        FROM (SELECT series_key, feature, lag, corr(x, y) AS r FROM pairs GROUP BY 1, 2, 3)""",
        "features",
        d=DIFFED,
        pairs=LAGGED.format(sign="-"),
    ),
)
def lag_corr(spark, sf_dir):
    out = stats.lag_correlation(_changes(spark, sf_dir), "price", ["import_qty", "order_value"])
    return report(out)


@query(
    "A19",
    sql(
        """SELECT p.series_key, p.feature, p.lag, round(sum((CASE WHEN p.feature = 'import_qty' THEN g.d_qty - mq ELSE g.d_value - mv END) * (p.y - mp))
        / (max(n) * max(CASE WHEN p.feature = 'import_qty' THEN sq ELSE sv END * sp)), 6) + 0.0 AS correlation
        FROM (SELECT f.series_key, v.feature, k.lag, f.rn, f.d_price AS y FROM e f
              CROSS JOIN (SELECT unnest(['import_qty', 'order_value']) AS feature) v CROSS JOIN (SELECT unnest(range(0, 13)) AS lag) k) p
        JOIN m ON m.series_key = p.series_key LEFT JOIN e g ON g.series_key = p.series_key AND g.rn = p.rn + p.lag GROUP BY 1, 2, 3""",
        "features",
        d=DIFFED,
        e="SELECT * FROM d WHERE d_price IS NOT NULL",
        m="""SELECT series_key, count(*) AS n, avg(d_price) AS mp, stddev_pop(d_price) AS sp, avg(d_qty) AS mq, stddev_pop(d_qty) AS sq,
        avg(d_value) AS mv, stddev_pop(d_value) AS sv FROM e GROUP BY 1""",
    ),
)
def ccf(spark, sf_dir):
    out = stats.cross_correlation(_changes(spark, sf_dir), "price", ["import_qty", "order_value"])
    return report(out)


@query(
    "A29",
    sql(
        """SELECT a.series_key, k.lag, round(sum((b.price - m.mp) * (a.price - m.mp)) / (max(m.n) * max(m.sp * m.sp)), 6) + 0.0 AS correlation
        FROM r a CROSS JOIN (SELECT unnest(range(0, 25)) AS lag) k JOIN m USING (series_key)
        LEFT JOIN r b ON b.series_key = a.series_key AND b.rn = a.rn - k.lag GROUP BY 1, 2""",
        "prices",
        r=f"SELECT series_key, price, row_number() {W} AS rn FROM prices",
        m="SELECT series_key, count(*) AS n, avg(price) AS mp, stddev_pop(price) AS sp FROM prices GROUP BY 1",
    ),
)
def acf(spark, sf_dir):
    return report(stats.autocorrelation(_price(spark, sf_dir), "price"))


@query(
    "A30",
    sql(
        """SELECT series_key, k AS lag, round(partial, 6) + 0.0 AS partial FROM (SELECT series_key, CAST(k AS BIGINT) AS k, partial FROM levinson)""",
        "prices",
        r=f"SELECT series_key, price, row_number() {W} AS rn FROM prices",
        m="SELECT series_key, count(*) AS n, avg(price) AS mp, stddev_pop(price) AS sp FROM prices GROUP BY 1",
        acf="""SELECT series_key, list(c ORDER BY lag) AS c FROM (SELECT a.series_key, k.lag, sum((b.price - m.mp) * (a.price - m.mp)) / (max(m.n) * max(m.sp * m.sp)) AS c
        FROM r a CROSS JOIN (SELECT unnest(range(0, 25)) AS lag) k JOIN m USING (series_key)
        LEFT JOIN r b ON b.series_key = a.series_key AND b.rn = a.rn - k.lag GROUP BY 1, 2) GROUP BY 1""",
        levinson="""SELECT series_key, 0 AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1 AS DOUBLE) AS unexplained, CAST(1 AS DOUBLE) AS partial FROM acf
        UNION ALL SELECT series_key, k + 1, list_append(list_transform(range(1, k + 1), lambda i: phi[i] - a * phi[k + 1 - i]), a), unexplained * (1 - a * a), a FROM
        (SELECT l.series_key, k, phi, unexplained,
         (c[k + 2] - list_sum(list_append(list_transform(range(1, k + 1), lambda i: phi[i] * c[k + 2 - i]), CAST(0 AS DOUBLE)))) / unexplained AS a
         FROM levinson l JOIN acf USING (series_key) WHERE k < 24)""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def pacf(spark, sf_dir):
    acf_table = stats.autocorrelation(_price(spark, sf_dir), "price")
    return report(stationarity.partial_autocorrelation(acf_table))


PAIRS = ", ".join(
    f"('{a}', '{b}', corr({a}, {b}))" if a != b else f"('{a}', '{b}', 1.0)" for a in DRIVERS for b in DRIVERS
)


@query(
    "A20 C16",
    sql(
        "SELECT series_key, v.var1, v.var2, round(v.correlation, 6) + 0.0 AS correlation FROM ("
        + " UNION ALL ".join(
            f"SELECT series_key, '{a}' AS var1, '{b}' AS var2, {f'corr({a}, {b})' if a != b else '1.0::DOUBLE'} AS correlation FROM features GROUP BY series_key"
            for a in DRIVERS
            for b in DRIVERS
        )
        + ") v",
        "features",
    ),
)
def corr_matrix(spark, sf_dir):
    df = roles.feature_layer(spark, sf_dir)
    target, drivers = df.select("series_key", "month", "import_qty"), df.drop("import_qty", "price")
    return report(studies.correlation_overview(target, [drivers], list(DRIVERS)))


@query(
    "C16 A27 J5",
    sql(
        f"""SELECT series_key, {YM} AS month, round((price - min(price) OVER k) / nullif(max(price) OVER k - min(price) OVER k, 0), 6) AS price_norm,
        round((qty - min(qty) OVER k) / nullif(max(qty) OVER k - min(qty) OVER k, 0), 6) AS qty_norm
        FROM prices WINDOW k AS (PARTITION BY series_key)""",
        "prices",
    ),
)
def minmax(spark, sf_dir):
    df = roles.price_layer(spark, sf_dir).select("series_key", "month", "price", "qty")
    target, driver = df.drop("qty"), df.drop("price")
    return report(studies.normalized_overlay(target, [driver], ["price", "qty"]).drop("price", "qty"))


@query(
    "A26",
    sql(
        f"""SELECT p.series_key, strftime(p.month, '%Y-%m') AS month, round((price - mp) / coalesce(nullif(sp, 0), 1), 6) + 0.0 AS price_z FROM prices p
        JOIN (SELECT series_key, avg(price) AS mp, stddev_pop(price) AS sp FROM prices WHERE month < DATE '2000-01-01' GROUP BY 1) USING (series_key)""",
        "prices",
    ),
)
def zscore(spark, sf_dir):
    df = roles.price_layer(spark, sf_dir).select("series_key", "month", "price")
    scaler = stats.fit_scaler(df.filter(F.col("month") < month("2000-01-01")), ["price"])
    return report(stats.apply_scaler(df, scaler, ["price"]).drop("price"))


@query(
    "A31",
    sql(
        f"""SELECT series_key, {YM} AS month, round(trend, 8) AS trend, round(raw - mean_raw, 8) + 0.0 AS seasonal,
        round(qty - trend - (raw - mean_raw), 8) + 0.0 AS resid FROM t JOIN s USING (series_key, pos)
        JOIN (SELECT series_key, avg(raw) AS mean_raw FROM s GROUP BY 1) USING (series_key)""",
        "prices",
        t=f"""SELECT series_key, month, qty, (row_number() {W} - 1) % 12 AS pos, CASE WHEN count(qty) OVER f = 13 THEN
        (sum(qty) OVER f - 0.5 * lag(qty, 6) {W} - 0.5 * lead(qty, 6) {W}) / 12 END AS trend FROM
        (SELECT b.series_key, b.month, p.qty FROM (SELECT series_key, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
         FROM prices GROUP BY 1) b LEFT JOIN prices p USING (series_key, month))
        WINDOW f AS (PARTITION BY series_key ORDER BY month ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)""",
        s="SELECT series_key, pos, avg(qty - trend) AS raw FROM t GROUP BY 1, 2",
    ),
)
def decompose(spark, sf_dir):
    aligned = calendar.align(roles.prices(spark, sf_dir).select("series_key", "month", "qty"))
    return report(stats.seasonal_decompose(aligned, "qty").drop("qty"), 8)


@query(
    "A32",
    sql(
        """SELECT series_key, least(20, coalesce(floor((value - lo) / (hi - lo) * 20), 0) + 1)::BIGINT AS bin, count(*) AS n FROM readings
        JOIN (SELECT series_key, min(value) AS lo, max(value) AS hi FROM readings GROUP BY 1) USING (series_key) GROUP BY 1, 2""",
        "readings",
    ),
)
def error_hist(spark, sf_dir):
    return report(stats.histogram(roles.readings(spark, sf_dir), "value", "series_key"))


@query(
    "A28",
    sql(
        f"""SELECT series_key, round(b / sqrt(greatest(syy - b * b * sxx, 0) / ((n - 2) * sxx)), 6) AS df_statistic, n AS n_obs FROM
        (SELECT series_key, regr_slope(dy, x) AS b, regr_sxx(dy, x) AS sxx, regr_syy(dy, x) AS syy, count(*) AS n FROM
        (SELECT series_key, lag(price) {W} AS x, price - lag(price) {W} AS dy FROM prices) WHERE x IS NOT NULL GROUP BY 1) WHERE n > 2""",
        "prices",
    ),
)
def dickey_fuller_lag0(spark, sf_dir):
    return report(stats.dickey_fuller_lag0(_price(spark, sf_dir), "price"))


@query("A28 X1")
def stationarity_test(spark, sf_dir):
    return report(stationarity.stationarity(_price(spark, sf_dir), "price"))


# sums around the means of level x, change dy and lagged change d1, and the two regressions of dy that they give
ROOT_SUMS = """SELECT series_key, count(*) AS n, regr_sxx(dy, x) AS xx, regr_syy(dy, x) AS yy, covar_pop(x, dy) * count(*) AS xy, covar_pop(d1, d1) * count(*) AS dd,
    covar_pop(x, d1) * count(*) AS xd, covar_pop(dy, d1) * count(*) AS yd FROM steps WHERE dy IS NOT NULL AND {rows} GROUP BY 1"""
ROOT_FITS = """SELECT *, n * (ln(2 * pi() * rss0 / n) + 1) + 4 AS aic0, n * (ln(2 * pi() * rss1 / n) + 1) + 6 AS aic1, b0 / sqrt(rss0 / (n - 2) / xx) AS t0,
    b1 / sqrt(rss1 / (n - 3) * dd / (xx * dd - xd * xd)) AS t1 FROM
    (SELECT *, yy - b0 * xy AS rss0, yy - b1 * xy - c1 * yd AS rss1 FROM
     (SELECT *, xy / xx AS b0, (xy * dd - yd * xd) / (xx * dd - xd * xd) AS b1, (yd * xx - xy * xd) / (xx * dd - xd * xd) AS c1 FROM {sums}))"""


@query(
    "A28",
    sql(
        """SELECT series_key, round(statistic, 5) + 0.0 AS statistic, lags, n AS n_obs, round(-3.43035 - 6.5393 / n - 16.786 / (n * n) - 79.433 / (n * n * n), 5) AS critical_1pct,
        round(critical_5pct, 5) AS critical_5pct, round(-2.56677 - 1.5384 / n - 2.809 / (n * n), 5) AS critical_10pct, statistic < critical_5pct AS is_stationary FROM
        (SELECT *, -2.86154 - 2.8903 / n - 4.234 / (n * n) - 40.040 / (n * n * n) AS critical_5pct FROM
         (SELECT series_key, 0 AS lags, e.t0 AS statistic, e.n FROM every_row e JOIN common c USING (series_key) WHERE c.aic0 <= c.aic1
          UNION ALL SELECT series_key, 1, t1, n FROM common WHERE aic0 > aic1))""",
        "prices",
        changes=f"SELECT series_key, month, price AS x, lead(price) {W} - price AS dy FROM prices",
        steps=f"SELECT *, lag(dy) {W} AS d1 FROM changes",
        all_sums=ROOT_SUMS.format(rows="TRUE"),
        common_sums=ROOT_SUMS.format(rows="d1 IS NOT NULL"),
        every_row=ROOT_FITS.format(sums="all_sums"),
        common=ROOT_FITS.format(sums="common_sums"),
    ),
)
def stationarity_one_lag(spark, sf_dir):
    """The unit-root test where the criterion chooses between no lag and one, which SQL can solve by hand."""
    return report(stationarity.stationarity(_price(spark, sf_dir), "price", max_lag=1), 5)


@query("C12 X5")
def lag_study(spark, sf_dir):
    df = roles.feature_layer(spark, sf_dir)
    return report(studies.lag_study(df, "price", ["import_qty", "order_value"], ["discount", "tax"]))


@query("X5 C12")
def lag_study_of_logs(spark, sf_dir):
    """The lag study after a transform of its columns: logarithms, where they are defined."""

    def logs(df):
        return df.withColumns({c: numeric.safe_ln(c) for c in ("price", "import_qty", "order_value")})

    df = roles.feature_layer(spark, sf_dir)
    return report(studies.lag_study(df, "price", ["import_qty", "order_value"], transform=logs))


@query(
    "C12 X5",
    sql(
        """SELECT series_key, feature, 0 AS lag, round(coalesce(CASE WHEN isnan(r) THEN 0 ELSE r END, 0), 4) + 0.0 AS correlation, 'pearson' AS method FROM
        (SELECT series_key, 'import_qty' AS feature, corr(p, q) AS r FROM d GROUP BY 1 UNION ALL SELECT series_key, 'order_value', corr(p, v) FROM d GROUP BY 1)""",
        "features",
        d=f"""SELECT series_key, p - lag(p) {W} AS p, q - lag(q) {W} AS q, v - lag(v) {W} AS v FROM
        (SELECT series_key, month, ln(price) AS p, ln(import_qty) AS q, ln(order_value) AS v FROM features JOIN (SELECT series_key, month, price FROM prices) USING (series_key, month))""",
    ),
)
def change_study(spark, sf_dir):
    """The lag study of logarithms in changes, without a lag: what remains of it is what SQL can correlate."""

    def logs(df):
        return df.withColumns({c: numeric.safe_ln(c) for c in ("price", "import_qty", "order_value")})

    df = roles.feature_layer(spark, sf_dir)
    return report(studies.lag_study(df, "price", ["import_qty", "order_value"], transform=logs, max_lag=0, difference="always"))


PEAK_SOURCE = """SELECT series_key, lag, CASE feature WHEN 'import_qty' THEN 'Imports' ELSE 'Order value' END AS variable,
    round(coalesce(CASE WHEN isnan(r) THEN 0 ELSE r END, 0), 4) + 0.0 AS correlation
    FROM (SELECT series_key, feature, lag, corr(x, y) AS r FROM pairs GROUP BY 1, 2, 3)"""


@query(
    "W12 C17 A17 P26",
    sql(
        """SELECT series_key, lag, variable, correlation FROM peaks
        QUALIFY abs(correlation) = max(abs(correlation)) OVER (PARTITION BY series_key, variable)""",
        "features",
        d=DIFFED,
        pairs=LAGGED.format(sign="-"),
        peaks=PEAK_SOURCE,
    ),
)
def peak_lag(spark, sf_dir):
    long = stats.lag_correlation(_changes(spark, sf_dir), "price", ["import_qty", "order_value"], digits=4)
    wide = long.groupBy("series_key", "lag").pivot("feature", ["import_qty", "order_value"]).agg(F.first("correlation"))
    labels = {"import_qty": "Imports", "order_value": "Order value"}
    return report(studies.lag_peaks(wide, ["import_qty", "order_value"], labels))


# --- feature tables -----------------------------------------------------------


@query(
    "C9 W1 P10 P12 J2 F16",
    sql(
        f"""SELECT l.series_key, strftime(l.month, '%Y-%m') AS month, import_qty_lag_0, order_value_lag_2, discount_lag_1, tax_lag_7, p.price FROM
        (SELECT f.series_key, f.month, f.import_qty AS import_qty_lag_0, a.order_value AS order_value_lag_2, b.discount AS discount_lag_1, c.tax AS tax_lag_7
         FROM features f JOIN features a ON a.series_key = f.series_key AND a.month = f.month - INTERVAL 2 MONTH
         JOIN features b ON b.series_key = f.series_key AND b.month = f.month - INTERVAL 1 MONTH
         JOIN features c ON c.series_key = f.series_key AND c.month = f.month - INTERVAL 7 MONTH) l
        JOIN prices p ON p.series_key = l.series_key AND p.month = l.month WHERE l.month >= DATE '{START_MONTH}'""",
        "features",
    ),
)
def gold_features(spark, sf_dir):
    layer = roles.feature_layer(spark, sf_dir)
    target = layer.select("series_key", "month", "price")
    return report(feature_plans.gold_features(layer.drop("price"), target, LAGS, start=month(START_MONTH)))


FILLED = f"""SELECT series_key, month, last_value(q IGNORE NULLS) OVER b AS import_qty, last_value(v IGNORE NULLS) OVER b AS order_value,
    last_value(discount IGNORE NULLS) OVER b AS discount, last_value(tax IGNORE NULLS) OVER b AS tax, imputed FROM
    (SELECT series_key, month, coalesce(import_qty, lag(import_qty, 12) {W}, lag(import_qty, 24) {W}) AS q,
     coalesce(order_value, lag(order_value, 12) {W}, lag(order_value, 24) {W}) AS v, discount, tax,
     import_qty IS NULL OR order_value IS NULL OR discount IS NULL OR tax IS NULL AS imputed FROM
     (SELECT s.series_key, s.month, f.import_qty, f.order_value, f.discount, f.tax FROM
      (SELECT series_key, CAST(unnest(generate_series(min(month), DATE '{HORIZON_END}', INTERVAL 1 MONTH)) AS DATE) AS month FROM {{src}} GROUP BY series_key) s
      LEFT JOIN {{src}} f ON f.series_key = s.series_key AND f.month = s.month))
    WINDOW b AS (PARTITION BY series_key ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
LAGGED_FILL = f"""SELECT series_key, month, import_qty AS import_qty_lag_0, lag(order_value, 2) {W} AS order_value_lag_2,
    lag(discount, 1) {W} AS discount_lag_1, lag(tax, 7) {W} AS tax_lag_7, imputed FROM filled"""


@query(
    "C10 J14 W4 W5 W1 P12 P11 I8",
    sql(
        f"""SELECT l.series_key, strftime(l.month, '%Y-%m') AS month, import_qty_lag_0, order_value_lag_2, discount_lag_1, tax_lag_7 FROM lagged l
        JOIN (SELECT series_key, max(month) AS last FROM prices GROUP BY 1) t ON t.series_key = l.series_key AND l.month > t.last
        WHERE l.month >= DATE '{START_MONTH}' AND tax_lag_7 IS NOT NULL AND order_value_lag_2 IS NOT NULL AND discount_lag_1 IS NOT NULL""",
        "features",
        filled=FILLED.format(src="features"),
        lagged=LAGGED_FILL,
    ),
)
def future_features(spark, sf_dir):
    monthly = materialize(roles.monthly_sales(spark, sf_dir), "sales")
    own = monthly.select("series_key", "month", F.col("qty").alias("import_qty"))
    values = roles.index(spark, sf_dir).withColumnRenamed("cpi", "order_value")
    shared = roles.monthly_rates(monthly).join(values, "month")
    out = feature_plans.future_features(
        joins.at_month(own, shared).select("series_key", "month", *DRIVERS),
        roles.priced(monthly).select("series_key", "month", "price"),
        LAGS,
        ["import_qty", "order_value"],
        start=month(START_MONTH),
        end=month(HORIZON_END),
    )
    return report(out)


OUTER = """SELECT k.series_key, month, p.qty AS import_qty, c.cpi AS order_value, r.discount, r.tax FROM
    (SELECT series_key, month FROM prices UNION SELECT series_key, month FROM cpi, (SELECT DISTINCT series_key FROM prices)
     UNION SELECT series_key, month FROM rates, (SELECT DISTINCT series_key FROM prices)) k
    LEFT JOIN prices p USING (series_key, month) LEFT JOIN cpi c USING (month) LEFT JOIN rates r USING (month)"""


@query(
    "C11 J7",
    sql(
        f"""SELECT l.series_key, strftime(l.month, '%Y-%m') AS month, import_qty_lag_0, order_value_lag_2, discount_lag_1, tax_lag_7,
        imputed AS is_imputed, p.price FROM lagged l JOIN prices p ON p.series_key = l.series_key AND p.month = l.month
        WHERE l.month >= DATE '{START_MONTH}' AND tax_lag_7 IS NOT NULL AND order_value_lag_2 IS NOT NULL AND discount_lag_1 IS NOT NULL""",
        "prices",
        "cpi",
        "rates",
        outer_features=OUTER,
        filled=FILLED.format(src="outer_features"),
        lagged=LAGGED_FILL,
    ),
)
def offline_features(spark, sf_dir):
    monthly = materialize(roles.monthly_sales(spark, sf_dir), "sales")
    own = [monthly.select("series_key", "month", F.col("qty").alias("import_qty"))]
    shared = [roles.index(spark, sf_dir).withColumnRenamed("cpi", "order_value"), roles.monthly_rates(monthly)]
    history, _ = feature_plans.offline_features(
        own,
        shared,
        roles.priced(monthly).select("series_key", "month", "price"),
        LAGS,
        ["import_qty", "order_value"],
        start=month(START_MONTH),
        end=month(HORIZON_END),
    )
    return report(history)


@query(
    "I8",
    sql(
        f"""SELECT series_key, strftime(min(month), '%Y-%m') AS first_month, strftime(max(month), '%Y-%m') AS last_month,
        min(month) = DATE '2000-01-01' AND max(month) = DATE '2001-01-01' AS is_current FROM spend WHERE month >= DATE '2000-01-01' GROUP BY 1""",
        "spend",
    ),
)
def horizon_check(spark, sf_dir):
    future = roles.spend(spark, sf_dir).filter(F.col("month") >= month("2000-01-01"))
    return report(calendar.horizon_check(future, month("2000-01-01"), month("2001-01-01")))


