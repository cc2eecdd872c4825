"""Catalog: projections, filters, joins, aggregates, reshaping and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidetable.functions import dates, nested, numeric, text
from tidetable.operators import joins, panel, ranking, reshape, stats
from tidetable.operators.calendar import align, spine
from tidetable.plans import features as feature_plans
from tidetable.plans import roles
from tidetable.plans.catalog import query, report
from tidetable.plans.roles import BASE_MONTH, HORIZON_END, REGION_WEIGHTS, REGIONS, START_MONTH, month, sql, table
from tidetable.session import materialize

YM = "strftime(month, '%Y-%m')"


# --- aggregates ---------------------------------------------------------------


@query("A1 A3 P1", sql(f"SELECT series_key, {YM} AS month, qty FROM prices", "prices"))
def monthly_sum(spark, sf_dir):
    return report(roles.prices(spark, sf_dir).select("series_key", "month", "qty"))


@query("A2", sql(f"SELECT series_key, partner, {YM} AS month, qty FROM partner_quantities", "partner_quantities"))
def partner_sum(spark, sf_dir):
    return report(roles.partner_quantities(spark, sf_dir))


@query("A3 P19", sql(f"SELECT series_key, {YM} AS month, amount, price, round(price / 100, 6) AS price_hundreds FROM prices", "prices"))
def unit_price(spark, sf_dir):
    df = roles.prices(spark, sf_dir)
    return report(df.select("series_key", "month", "amount", "price", (F.col("price") / 100).alias("price_hundreds")))


@query(
    "A4 A5 A6",
    sql(
        """SELECT series_key, strftime(day, '%Y-%m-%d') AS day, round(avg(v), 6) AS mean_value,
        round(avg(CASE WHEN v > 10 THEN v END), 6) AS mean_large, round(max(v), 6) AS max_value, count(*) AS n
        FROM (SELECT series_key, day, user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100.0 / count(*) AS v
              FROM readings GROUP BY 1, 2, 3) GROUP BY 1, 2""",
        "readings",
    ),
)
def national_mean(spark, sf_dir):
    """Mean of user means; the inner sums are exact, so a mean is the same in any order of addition."""
    one = F.count(F.lit(1))
    mean = numeric.money_sum("value") / one
    cities = roles.readings(spark, sf_dir).groupBy("series_key", "day", "user_id").agg(mean.alias("v"))
    large = F.when(F.col("v") > 10, F.col("v"))
    out = cities.groupBy("series_key", "day").agg(
        F.avg("v").alias("mean_value"), F.avg(large).alias("mean_large"), F.max("v").alias("max_value"), one.alias("n")
    )
    return report(out)


@query(
    "A7 F13",
    sql("SELECT series_key, year(month) AS year, round(avg(price), 6) AS price, count(*) AS n_months FROM prices GROUP BY 1, 2", "prices"),
)
def yearly_mean(spark, sf_dir):
    df = roles.prices(spark, sf_dir).groupBy("series_key", F.year("month").alias("year"))
    return report(df.agg(F.avg("price").alias("price"), F.count(F.lit(1)).alias("n_months")))


@query(
    "A8",
    sql(
        "SELECT series_key, strftime(min(month), '%Y-%m') AS first_period, strftime(max(month), '%Y-%m') AS last_period FROM spend GROUP BY 1",
        "spend",
    ),
)
def period_range(spark, sf_dir):
    return report(stats.period_range(roles.spend(spark, sf_dir)))


@query(
    "A9",
    "SELECT o_orderpriority AS series_key, count(DISTINCT o_custkey) AS n_distinct FROM orders GROUP BY 1",
)
def distinct_count(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("series_key"), "o_custkey")
    return report(stats.distinct_count(orders, "o_custkey", "series_key"))


@query(
    "A10 T1",
    "SELECT DISTINCT o_orderpriority AS label, o_orderstatus AS status FROM orders ORDER BY 1, 2",
)
def sorted_distinct(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderpriority").alias("label"), F.col("o_orderstatus").alias("status")).distinct().orderBy("label", "status")


@query(
    "A11",
    sql(
        """SELECT series_key, count(*) AS rows, count(*) - count(day) AS missing_date,
        count(*) - count(level) AS missing_target,
        count(*) - count(DISTINCT (user_id, coalesce(day, DATE '1900-01-01'), coalesce(level, -1))) AS duplicate_rows,
        count(*) - count(DISTINCT coalesce(day, DATE '1900-01-01')) AS duplicate_dates
        FROM (SELECT series_key, user_id, CASE WHEN value >= 1 THEN day END AS day,
              CASE WHEN value < 100 THEN floor(value / 10) END AS level FROM readings) GROUP BY 1""",
        "readings",
    ),
)
def quality_profile(spark, sf_dir):
    df = roles.readings(spark, sf_dir).select(
        "series_key",
        "user_id",
        F.when(F.col("value") >= 1, F.col("day")).alias("day"),
        F.when(F.col("value") < 100, F.floor(F.col("value") / 10)).alias("level"),
    )
    return report(stats.quality_profile(df, "series_key", "day", "level"))


@query(
    "A12",
    sql(
        """SELECT column_name, round(missing_pct, 6) AS missing_pct FROM (
        SELECT avg(CASE WHEN high IS NULL THEN 1.0 ELSE 0 END) * 100 AS high,
               avg(CASE WHEN spend IS NULL THEN 1.0 ELSE 0 END) * 100 AS spend,
               avg(CASE WHEN series_key IS NULL THEN 1.0 ELSE 0 END) * 100 AS series_key
        FROM (SELECT series_key, spend, CASE WHEN spend >= 250000 THEN spend END AS high FROM spend_aligned))
        UNPIVOT (missing_pct FOR column_name IN (high, spend, series_key))""",
        "spend_aligned",
    ),
)
def missing_pct(spark, sf_dir):
    df = align(roles.spend(spark, sf_dir)).withColumn("high", F.when(F.col("spend") >= 250000, F.col("spend")))
    return report(stats.missing_percent(df, ["series_key", "spend", "high"]).orderBy(F.desc("missing_pct")))


# --- prices, units, blends ----------------------------------------------------


@query(
    "P20 J13 J3 C7",
    sql(
        f"""SELECT series_key, {YM} AS month, price AS price_before_adjustment, cpi,
        round(price * (SELECT cpi FROM cpi WHERE month = DATE '{BASE_MONTH}') / cpi, 2) AS price_adjusted
        FROM prices JOIN cpi USING (month)""",
        "prices",
        "cpi",
    ),
)
def deflate(spark, sf_dir):
    from tidetable.plans.silver import adjusted_prices

    return report(adjusted_prices(roles.prices(spark, sf_dir), roles.index(spark, sf_dir), month(BASE_MONTH)))


@query(
    "J8 P21",
    sql(
        f"""SELECT p.series_key, strftime(p.month, '%Y-%m') AS month, c.cpi,
        round(p.price * c.cpi / (SELECT cpi FROM cpi WHERE month = DATE '{BASE_MONTH}'), 2) AS nominal
        FROM prices p ASOF LEFT JOIN cpi c ON p.month >= c.month""",
        "prices",
        "cpi",
    ),
)
def reinflate_asof(spark, sf_dir):
    index = joins.with_base(roles.index(spark, sf_dir), "cpi", month(BASE_MONTH), name="base_cpi")
    pair = index.select("month", F.struct("cpi", "base_cpi").alias("index"))
    based = joins.as_of_calendar(roles.prices(spark, sf_dir), pair, "index").select("*", "index.*")
    return report(based.select("series_key", "month", "cpi", numeric.reinflate("price", "cpi", "base_cpi").alias("nominal")))


@query(
    "J8",
    sql(
        """SELECT o.series_key, strftime(o.month, '%Y-%m') AS month, o.spend, u.spend AS last_urgent
        FROM spend o ASOF LEFT JOIN urgent u ON o.series_key = u.series_key AND o.month >= u.month""",
        "spend",
        urgent="""SELECT o_custkey AS series_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2""",
    ),
)
def asof_per_series(spark, sf_dir):
    urgent = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("series_key"), dates.month_start("o_orderdate").alias("month"))
        .agg(numeric.money_sum("o_totalprice").alias("last_urgent"))
    )
    out = joins.as_of(roles.spend(spark, sf_dir), urgent, "last_urgent", "series_key", unique_left=True)
    return report(out.select("series_key", "month", "spend", "last_urgent"))


@query(
    "P22",
    sql(
        f"""SELECT series_key, {YM} AS month, round(price * (SELECT cpi FROM cpi WHERE month = DATE '1998-01-01') / cpi, 4) AS rebased
        FROM prices JOIN cpi USING (month)""",
        "prices",
        "cpi",
    ),
)
def rebase(spark, sf_dir):
    based = joins.with_base(roles.index(spark, sf_dir), "cpi", month("1998-01-01"), name="base_cpi")
    df = joins.at_month(roles.prices(spark, sf_dir), based)
    return report(df.select("series_key", "month", numeric.deflate("price", "cpi", "base_cpi", 4).alias("rebased")))


@query(
    "A13 P18 C8",
    sql(
        f"""SELECT {YM} AS month, round(max(CASE WHEN state = 'ASIA' THEN mean_c END) * 0.7
        + max(CASE WHEN state = 'EUROPE' THEN mean_c END) * 0.2 + max(CASE WHEN state = 'AFRICA' THEN mean_c END) * 0.1, 6) AS mean_c
        FROM regional WHERE state IN ('ASIA', 'EUROPE', 'AFRICA') GROUP BY month""",
        "regional",
    ),
)
def blend_weights(spark, sf_dir):
    return report(feature_plans.blended_regions(roles.regional_values(spark, sf_dir), REGION_WEIGHTS, ["mean_c"]))


@query(
    "A13",
    sql(
        f"""SELECT {YM} AS month, max(CASE WHEN state = 'AFRICA' THEN mean_c END) AS "AFRICA",
        max(CASE WHEN state = 'AMERICA' THEN mean_c END) AS "AMERICA", max(CASE WHEN state = 'ASIA' THEN mean_c END) AS "ASIA",
        max(CASE WHEN state = 'EUROPE' THEN mean_c END) AS "EUROPE",
        max(CASE WHEN state = 'MIDDLE EAST' THEN mean_c END) AS "MIDDLE EAST" FROM regional GROUP BY month""",
        "regional",
    ),
)
def pivot_regions(spark, sf_dir):
    return report(reshape.pivot(roles.regional_values(spark, sf_dir), "month", "state", REGIONS, "mean_c"))


@query(
    "A14",
    sql(
        f"""SELECT series_key, {YM} AS month, sum(CASE WHEN partner = 'AFRICA' THEN qty END) AS "AFRICA",
        sum(CASE WHEN partner = 'AMERICA' THEN qty END) AS "AMERICA", sum(CASE WHEN partner = 'ASIA' THEN qty END) AS "ASIA",
        sum(CASE WHEN partner = 'EUROPE' THEN qty END) AS "EUROPE",
        sum(CASE WHEN partner = 'MIDDLE EAST' THEN qty END) AS "MIDDLE EAST" FROM partner_quantities GROUP BY series_key, month""",
        "partner_quantities",
    ),
)
def pivot_sum(spark, sf_dir):
    return report(reshape.pivot(roles.partner_quantities(spark, sf_dir), ["series_key", "month"], "partner", REGIONS, "qty", "sum"))


@query(
    "A15",
    sql(
        """SELECT strftime(day, '%Y-%m-%d') AS day, round(avg(CASE WHEN series_key = 'click' THEN value END), 6) AS click,
        round(avg(CASE WHEN series_key = 'error' THEN value END), 6) AS error,
        round(avg(CASE WHEN series_key = 'signup' THEN value END), 6) AS signup,
        round(avg(CASE WHEN series_key = 'view' THEN value END), 6) AS view,
        round(avg(CASE WHEN series_key = 'purchase' THEN value END), 6) AS purchase FROM readings GROUP BY day""",
        "readings",
    ),
)
def pivot_mean(spark, sf_dir):
    df = roles.readings(spark, sf_dir).select("day", "series_key", "value")
    return report(reshape.pivot(df, "day", "series_key", ["click", "error", "purchase", "signup", "view"], "value", "mean"))


@query(
    "A17 A16",
    sql(
        f"""SELECT {YM} AS month, variable, value FROM (SELECT month, unnest(['order_value', 'discount', 'tax']) AS variable,
        unnest([cpi, discount, tax]) AS value FROM cpi JOIN rates USING (month))""",
        "cpi",
        "rates",
    ),
)
def unpivot_long(spark, sf_dir):
    wide = roles.index(spark, sf_dir).withColumnRenamed("cpi", "order_value").join(roles.rates(spark, sf_dir), "month")
    return report(reshape.unpivot(wide, "month", ["order_value", "discount", "tax"]))


@query(
    "A16 F11",
    sql(f"SELECT series_key, {YM} AS month, qty FROM prices", "prices"),
)
def wide_months_long(spark, sf_dir):
    """A column for each month of the calendar, and back."""
    df = roles.prices(spark, sf_dir).withColumn("label", dates.month_name("month"))
    wide = reshape.pivot(df, "series_key", "label", dates.month_names_between(*roles.sales_months(spark, sf_dir)), "qty")
    long = reshape.wide_months_to_long(wide, "series_key", dates.month_of_long_name, value="qty")
    return report(long.filter(F.col("qty").isNotNull()))


# --- joins --------------------------------------------------------------------


@query("J1", sql(f"SELECT series_key, {YM} AS month, import_qty, order_value, discount, tax FROM features", "features"))
def inner_nway(spark, sf_dir):
    return report(roles.features(spark, sf_dir))


@query(
    "J2 J4 P2 P3",
    sql(
        f"""SELECT p.series_key, strftime(p.month, '%Y-%m') AS ref_date, p.price AS unit_price, q.qty AS asia_qty
        FROM prices p JOIN partner_quantities q ON p.series_key = q.series_key AND p.month = q.month WHERE q.partner = 'ASIA'""",
        "prices",
        "partner_quantities",
    ),
)
def renamed_join(spark, sf_dir):
    prices, partners = roles.prices_and_partners(spark, sf_dir)
    target = panel.rename(prices.select("series_key", "month", "price"), {"month": "ref_date", "price": "unit_price"})
    asia = partners.filter(F.col("partner") == "ASIA")
    asia = panel.rename(asia.select("series_key", "month", "qty"), {"series_key": "brand", "qty": "asia_qty"})
    out = joins.join_renamed(target, asia, {"series_key": "brand", "ref_date": "month"})
    return report(out.withColumn("ref_date", dates.month_label("ref_date")))


@query(
    "J5",
    sql(
        f"""SELECT p.series_key, {YM} AS month, p.price, c.cpi, r.discount, r.tax FROM prices p
        LEFT JOIN cpi c USING (month) LEFT JOIN rates r USING (month)""",
        "prices",
        "cpi",
        "rates",
    ),
)
def left_chain(spark, sf_dir):
    monthly = materialize(roles.monthly_sales(spark, sf_dir), "sales")
    target = roles.priced(monthly).select("series_key", "month", "price")
    priced = joins.at_month(target, roles.index(spark, sf_dir), "left")
    return report(joins.at_month(priced, roles.monthly_rates(monthly), "left"))


FLAGS = "SELECT o_custkey AS series_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n{f} FROM orders WHERE o_orderstatus = '{f}' GROUP BY 1, 2"


def _status_tables(spark, sf_dir, *statuses):
    """Order counts per customer and month, one table per status, from one pass over the orders."""
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("series_key"), dates.month_start("o_orderdate").alias("month"), F.col("o_orderstatus").alias("status"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    layer = materialize(counts, "statuses")
    return [layer.filter(F.col("status") == s).select("series_key", "month", F.col("n").alias(f"n{s}")) for s in statuses]


@query(
    "J6 J7",
    sql(
        f"""SELECT series_key, {YM} AS month, coalesce(nF, 0) AS "nF", coalesce(nO, 0) AS "nO", coalesce(nP, 0) AS "nP"
        FROM a FULL JOIN b USING (series_key, month) FULL JOIN c USING (series_key, month)""",
        a=FLAGS.format(f="F"),
        b=FLAGS.format(f="O"),
        c=FLAGS.format(f="P"),
    ),
)
def full_outer_nway(spark, sf_dir):
    frames = _status_tables(spark, sf_dir, "F", "O", "P")
    return report(joins.join_all(frames, ["series_key", "month"], "full").na.fill(0, ["nF", "nO", "nP"]))


@query(
    "J9 U2 U5",
    sql(
        f"""SELECT series_key, {YM} AS month, nF AS n, CAST(NULL AS DOUBLE) AS bound, 'F' AS kind FROM a
        UNION ALL SELECT b.series_key, strftime(b.month, '%Y-%m'), b.nO, CAST(b.nO * 2 AS DOUBLE), 'O' FROM b
        ANTI JOIN a ON a.series_key = b.series_key AND a.month = b.month""",
        a=FLAGS.format(f="F"),
        b=FLAGS.format(f="O"),
    ),
)
def anti_override(spark, sf_dir):
    final, opened = _status_tables(spark, sf_dir, "F", "O")
    actual = final.withColumnRenamed("nF", "n").withColumn("kind", F.lit("F"))
    other = opened.withColumnRenamed("nO", "n").withColumn("kind", F.lit("O"))
    other = other.withColumn("bound", F.col("n").cast("double") * 2)
    out = joins.override(actual, other, ["series_key", "month"])
    return report(out.select("series_key", "month", "n", "bound", "kind"))


@query(
    "J10 U4 I6",
    sql(
        f"""SELECT a.series_key, strftime(a.month, '%Y-%m') AS month, a.nF AS n FROM a SEMI JOIN
        (SELECT series_key, month FROM b INTERSECT SELECT series_key, month FROM c) k ON a.series_key = k.series_key AND a.month = k.month""",
        a=FLAGS.format(f="F"),
        b=FLAGS.format(f="O"),
        c=FLAGS.format(f="P"),
    ),
)
def semi_months(spark, sf_dir):
    on = ["series_key", "month"]
    final, opened, partial = _status_tables(spark, sf_dir, "F", "O", "P")
    both = joins.common_keys(opened, partial, on)
    return report(joins.restrict_to_common(final, both, on).withColumnRenamed("nF", "n"))


@query(
    "J11",
    """SELECT l.l_orderkey, l.l_linenumber, coalesce(s.label, 'Unknown') AS label FROM lineitem l
    LEFT JOIN (SELECT s_suppkey, n_name AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0) s
    ON l.l_suppkey = s.s_suppkey""",
)
def lookup_default(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 0)
    names = supplier.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("label")
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return report(joins.lookup(lines, names, "l_suppkey", {"label": "Unknown"}).drop("l_suppkey"))


@query(
    "J12 P26",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'other' END AS status,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'low' ELSE o_orderpriority END AS priority FROM orders""",
)
def code_labels(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return report(
        orders.select(
            "o_orderkey",
            joins.map_codes("o_orderstatus", {"F": "final", "O": "open"}, "other").alias("status"),
            reshape.recode("o_orderpriority", {"1-URGENT": "urgent", "5-LOW": "low"}).alias("priority"),
        )
    )


@query("J14 J15", sql(f"SELECT series_key, {YM} AS month, spend FROM spend_aligned", "spend_aligned"))
def spine_align(spark, sf_dir):
    return report(align(roles.spend(spark, sf_dir)))


@query(
    "J14",
    sql(
        f"""SELECT s.series_key, strftime(s.month, '%Y-%m') AS month, p.price FROM
        (SELECT series_key, CAST(unnest(generate_series(min(month), DATE '{HORIZON_END}', INTERVAL 1 MONTH)) AS DATE) AS month
        FROM prices GROUP BY series_key) s LEFT JOIN prices p ON s.series_key = p.series_key AND s.month = p.month""",
        "prices",
    ),
)
def spine_join(spark, sf_dir):
    df = roles.price_layer(spark, sf_dir).select("series_key", "month", "price")
    return report(spine(df, end=month(HORIZON_END)).join(df, ["series_key", "month"], "left"))


@query(
    "J17",
    sql(
        f"""SELECT series_key, {YM} AS month, coalesce(a.nF, b.nO) AS n FROM a FULL JOIN b USING (series_key, month)""",
        a=FLAGS.format(f="F"),
        b=FLAGS.format(f="O"),
    ),
)
def coalesce_sources(spark, sf_dir):
    first, second = _status_tables(spark, sf_dir, "F", "O")
    first, second = first.withColumnRenamed("nF", "n"), second.withColumnRenamed("nO", "n")
    return report(joins.fill_from(first, second, ["series_key", "month"]))


@query(
    "J16 U3 M13",
    sql(
        f"""SELECT {YM} AS month, cpi AS order_value, tax, mean_c AS asia FROM
        (SELECT month FROM cpi UNION SELECT month FROM rates UNION SELECT month FROM regional WHERE state = 'ASIA')
        LEFT JOIN cpi USING (month) LEFT JOIN rates USING (month)
        LEFT JOIN (SELECT month, mean_c FROM regional WHERE state = 'ASIA') USING (month)""",
        "cpi",
        "rates",
        "regional",
    ),
)
def aligned_series(spark, sf_dir):
    series = {
        "order_value": roles.index(spark, sf_dir).select("month", F.col("cpi").alias("value")),
        "tax": roles.rates(spark, sf_dir).select("month", F.col("tax").alias("value")),
        "asia": feature_plans.one_region(roles.regional_values(spark, sf_dir), "ASIA", ["mean_c"]).withColumnRenamed("mean_c", "value"),
    }
    return report(joins.align_series(series, "month", "value"))


@query(
    "J19 A1",
    sql(
        f"""SELECT p.series_key, strftime(p.month, '%Y-%m') AS month, p.price, q.qty FROM prices p LEFT JOIN
        (SELECT series_key, month, sum(qty) AS qty FROM partner_quantities WHERE partner IN ('ASIA', 'EUROPE') GROUP BY 1, 2) q
        ON p.series_key = q.series_key AND p.month = q.month""",
        "prices",
        "partner_quantities",
    ),
)
def aggregate_then_join(spark, sf_dir):
    prices, partners = roles.prices_and_partners(spark, sf_dir)
    total = partners.filter(F.col("partner").isin("ASIA", "EUROPE")).groupBy("series_key", "month").agg(F.sum("qty").alias("qty"))
    target = prices.select("series_key", "month", "price")
    return report(joins.join_all([target, total], ["series_key", "month"], "left"))


@query(
    "J3",
    """SELECT o_orderpriority AS priority, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def salted_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order"), "l_linenumber", "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order"), F.col("o_orderpriority").alias("priority"))
    joined = joins.salted_join(lines, orders, "order")
    return report(joined.groupBy("priority").agg(numeric.money_sum("l_extendedprice").alias("amount"), F.count(F.lit(1)).alias("n")))


@query(
    "J3",
    """SELECT priority, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS n FROM
    (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k, l_extendedprice FROM lineitem) JOIN
    (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey END AS k, min(o_orderpriority) AS priority FROM orders GROUP BY 1) USING (k) GROUP BY 1""",
)
def salted_join_hot(spark, sf_dir):
    """A third of the lines have one key, which is spread over many tasks."""
    hot = lambda c: F.when(F.col(c) % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col(c)).alias("k")
    lines = table(spark, sf_dir, "lineitem").select(hot("l_orderkey"), "l_extendedprice")
    orders = table(spark, sf_dir, "orders").groupBy(hot("o_orderkey")).agg(F.min("o_orderpriority").alias("priority"))
    joined = joins.salted_join(lines, orders, "k")
    return report(joined.groupBy("priority").agg(numeric.money_sum("l_extendedprice").alias("amount"), F.count(F.lit(1)).alias("n")))


# --- set operations -----------------------------------------------------------


@query(
    "U1 P5",
    sql(
        f"""SELECT 'index' AS source, {YM} AS month, cpi AS value FROM cpi
        UNION ALL SELECT 'tax', {YM}, tax FROM rates""",
        "cpi",
        "rates",
    ),
)
def union_all(spark, sf_dir):
    a = panel.insert_first(roles.index(spark, sf_dir).select("month", F.col("cpi").alias("value")), "source", F.lit("index"))
    b = panel.insert_first(roles.rates(spark, sf_dir).select("month", F.col("tax").alias("value")), "source", F.lit("tax"))
    return report(joins.stack([a, b]))


@query(
    "U3 U5",
    sql(
        """SELECT strftime(month, '%Y-%m') AS month, 'any' AS kind FROM (SELECT month FROM cpi UNION SELECT month FROM rates)
        UNION ALL SELECT strftime(month, '%Y-%m'), 'ahead' FROM (SELECT month FROM rates EXCEPT SELECT month FROM cpi)""",
        "cpi",
        "rates",
    ),
)
def month_sets(spark, sf_dir):
    cpi = materialize(roles.index(spark, sf_dir), "index")
    rates = materialize(roles.rates(spark, sf_dir), "rates")
    anywhere = joins.union_distinct_keys([cpi, rates], "month").withColumn("kind", F.lit("any"))
    ahead = joins.keys_only_in(rates, cpi, "month").withColumn("kind", F.lit("ahead"))
    return report(anywhere.unionByName(ahead))


# --- filters and scalar functions ---------------------------------------------


@query(
    "P4 P6 P7 P8 P9",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
    AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate <= TIMESTAMP '1997-12-31' AND l_suppkey IN (1, 2, 3, 5, 8) AND l_discount IS NOT NULL""",
)
def compound_filter(spark, sf_dir):
    ship = F.col("l_shipdate")
    lines = table(spark, sf_dir, "lineitem").filter(
        (F.col("l_returnflag") == "R")
        & (F.col("l_linestatus") == "F")
        & ship.between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1997-12-31").cast("timestamp_ntz"))
        & F.col("l_suppkey").isin(1, 2, 3, 5, 8)
        & F.col("l_discount").isNotNull()
    )
    kept = lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return report(panel.drop_present(kept, ["l_discount", "l_tax", "not_there"]))


@query(
    "P10 P11 P14",
    sql(
        f"""SELECT p.series_key, strftime(p.month, '%Y-%m') AS month, p.price FROM prices p
        JOIN (SELECT max(month) AS last FROM cpi) c ON p.month > c.last OR strftime(p.month, '%Y') = '1997'
        WHERE p.month >= DATE '{START_MONTH}'""",
        "prices",
        "cpi",
    ),
)
def month_filters(spark, sf_dir):
    df = roles.prices(spark, sf_dir).select("series_key", "month", "price").filter(F.col("month") >= month(START_MONTH))
    later = F.col("month") > roles.index(spark, sf_dir).agg(F.max("month")).scalar()
    return report(df.filter(later | dates.month_label("month").startswith("1997-")))


@query(
    "P12 P13",
    sql(
        f"""SELECT 'any' AS kind, count(*) AS n FROM (SELECT s.spend, c.cpi FROM spend_aligned s LEFT JOIN cpi c USING (month))
        WHERE spend IS NOT NULL AND cpi IS NOT NULL
        UNION ALL SELECT 'subset', count(*) FROM (SELECT s.spend, c.cpi FROM spend_aligned s LEFT JOIN cpi c USING (month)) WHERE spend IS NOT NULL""",
        "spend_aligned",
        "cpi",
    ),
)
def drop_nulls(spark, sf_dir):
    df = materialize(joins.at_month(align(roles.spend(spark, sf_dir)), roles.index(spark, sf_dir), "left"), "aligned")
    whole, subset = df.na.drop(how="any"), df.na.drop(subset=["spend"])
    counted = [d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n") for k, d in (("any", whole), ("subset", subset))]
    return report(joins.stack(counted))


@query(
    "P15 F8",
    """SELECT doc_id, lang, source FROM documents WHERE text ILIKE '%the%' AND NOT (text ILIKE '%license%')""",
)
def text_filter(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    wanted = text.contains_any_case("text", "THE") & ~text.contains_any_case("text", "License")
    return report(docs.filter(wanted).select("doc_id", "lang", "source"))


@query(
    "P17 F5 F6 X4",
    """SELECT doc_id, word, folded FROM (SELECT doc_id, word, lower(trim(strip_accents(word))) AS folded FROM
    (SELECT doc_id, unnest(regexp_split_to_array(text, '[^A-Za-zÀ-ÖØ-öø-ÿ]+')) AS word FROM documents) WHERE word <> '')
    WHERE folded = 'etre' GROUP BY ALL""",
)
def accent_folding(spark, sf_dir):
    words = (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.explode(F.split("text", "[^A-Za-zÀ-ÖØ-öø-ÿ]+")).alias("word"))
        .filter(text.same_name("word", "etre"))
    )
    return report(words.select("doc_id", "word", text.normalized_name("word").alias("folded")).distinct())


@query(
    "P17 F5 F6 X4",
    r"""SELECT word, lower(trim(regexp_replace(strip_accents(word), '[^\x00-\x7F]', '', 'g'))) AS folded
    FROM (SELECT unnest(regexp_split_to_array(text, '[^A-Za-zÀ-ÖØ-öø-ÿ]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1""",
)
def accent_folding_words(spark, sf_dir):
    """Every word of the texts and its plain form."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "[^A-Za-zÀ-ÖØ-öø-ÿ]+")).alias("word"))
    return report(words.filter("word <> ''").distinct().select("word", text.normalized_name("word").alias("folded")))


@query(
    "F7",
    r"""SELECT doc_id, regexp_replace(label, '\s+\d+(\s+\d+)?$', '') AS label FROM
    (SELECT doc_id, lang || ' ' || source || ' ' || n_chars || ' ' || doc_id AS label FROM documents)""",
)
def strip_footnotes(spark, sf_dir):
    label = F.concat_ws(" ", "lang", "source", F.col("n_chars").cast("string"), F.col("doc_id").cast("string"))
    return report(table(spark, sf_dir, "documents").select("doc_id", text.strip_footnotes(label).alias("label")))


@query(
    "F1 F2 F3 F4 F12 F14 F15",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS label, strftime(o_orderdate, '%B %Y') AS name,
    split_part(strftime(o_orderdate, '%Y-%m'), '-', 1) AS year_text, lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS month_text,
    strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m') AS following,
    CASE WHEN length(CAST(o_custkey AS VARCHAR)) >= 3 THEN CAST(o_custkey AS VARCHAR) ELSE lpad(CAST(o_custkey AS VARCHAR), 3, '0') END AS code,
    CASE WHEN strftime(o_orderdate, '%Y-%m') = substr(CAST(o_orderdate AS VARCHAR), 1, 7) THEN 1 ELSE 0 END AS same FROM orders""",
)
def date_parts(spark, sf_dir):
    d = F.col("o_orderdate")
    label = dates.month_label(d)
    rebuilt = dates.month_from_parts(text.period_parts(label)[0], text.period_parts(label)[1])
    return report(
        table(spark, sf_dir, "orders").select(
            "o_orderkey",
            label.alias("label"),
            dates.month_name(d).alias("name"),
            text.period_parts(label)[0].alias("year_text"),
            text.zero_pad(F.month(d).cast("string"), 2).alias("month_text"),
            dates.next_month(d).alias("following"),
            text.zero_pad(F.col("o_custkey").cast("string"), 3).alias("code"),
            (rebuilt == dates.month_of_text(d.cast("string"))).cast("bigint").alias("same"),
        )
    )


@query(
    "F9 F10 F11 F16",
    """SELECT o_orderkey, strftime(try_strptime(raw, '%Y%m'), '%Y-%m') AS compact, strftime(o_orderdate, '%Y-%m') AS short_name,
    TRY_CAST(number_text AS DOUBLE) AS number FROM (SELECT o_orderkey, o_orderdate,
    CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y') || '13' ELSE strftime(o_orderdate, '%Y%m') END AS raw,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS number_text FROM orders)""",
)
def parse_or_null(spark, sf_dir):
    d = F.col("o_orderdate")
    raw = F.when(F.col("o_orderstatus") == "P", F.concat(F.date_format(d, "yyyy"), F.lit("13"))).otherwise(F.date_format(d, "yyyyMM"))
    number = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    return report(
        table(spark, sf_dir, "orders").select(
            "o_orderkey",
            dates.month_of_compact(raw).alias("compact"),
            dates.month_of_short_name(F.date_format(d, "MMM-yyyy")).alias("short_name"),
            numeric.to_number(number).alias("number"),
        )
    )


@query(
    "F17 F18 F19 F20 F21 F22",
    """SELECT event_id, coalesce(small, 0) AS small, round(CAST(value AS DECIMAL(18,6)), 1)::DOUBLE AS tenth,
    round(CASE WHEN value > 1 THEN ln(value - 1) END, 6) AS log_over, round(sqrt(value), 6) AS root,
    CAST(CASE WHEN value > 10 THEN 1 WHEN value < 10 THEN -1 ELSE 0 END AS DOUBLE) AS side, round(abs(value - 10), 6) AS abs_error,
    round(abs(value - 10) / (value + 1e-8) * 100, 4) AS pct_error, CASE WHEN value BETWEEN 0 AND 10 THEN value ELSE 10.0 END AS guarded
    FROM (SELECT event_id, value, CASE WHEN value < 50 THEN value END AS small FROM events)""",
)
def number_functions(spark, sf_dir):
    v = F.col("value")
    df = table(spark, sf_dir, "events").select("event_id", "value", F.lit(10.0).alias("ten"))
    return report(
        df.select(
            "event_id",
            numeric.null_to_zero(F.when(v < 50, v)).alias("small"),
            numeric.round_half_up(v.cast("decimal(18,6)"), 1).alias("tenth"),
            numeric.safe_ln(v - 1).alias("log_over"),
            F.sqrt(v).alias("root"),
            F.signum(v - 10).alias("side"),
            numeric.absolute_error("value", "ten").alias("abs_error"),
            numeric.percent_error("value", "ten").alias("pct_error"),
            numeric.within("value", 0, 10, "ten").alias("guarded"),
        ),
        {"pct_error": 4},
    )


@query(
    "F23 F24 F25 F26",
    sql(
        """SELECT series_key, user_id, count(*) AS n_points, sum(CASE WHEN day = DATE '2024-01-15' THEN 1 ELSE 0 END)::BIGINT AS n_on_day,
        count(DISTINCT day) AS n_days, strftime(min(day), '%Y-%m-%d') AS first_day,
        CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total FROM readings GROUP BY 1, 2""",
        "readings",
    ),
)
def json_points(spark, sf_dir):
    rows = roles.readings(spark, sf_dir).select(
        "series_key", "user_id", F.col("day").cast("string").alias("refPer"), F.from_json("props", "k int")["k"].alias("k")
    )
    # events are summed by day first, so a document has no more points than the calendar has days
    daily = rows.groupBy("series_key", "user_id", "refPer").agg(F.sum("k").alias("k"), F.count(F.lit(1)).alias("n"))
    # a user's points of one kind form a document, as the raw layer holds them
    docs = daily.groupBy("series_key", "user_id").agg(F.to_json(F.collect_list(F.struct("refPer", "k", "n"))).alias("doc"))
    points = F.from_json("doc", "array<struct<refPer:string,k:bigint,n:bigint>>")
    opened = docs.select("series_key", "user_id", nested.points_or_empty(points, "struct<refPer:string,k:bigint,n:bigint>").alias("p"))
    periods = nested.periods_of("p")

    def events(array):
        return F.aggregate(array, F.lit(0).cast("bigint"), lambda total, point: total + point["n"])

    return report(
        opened.select(
            "series_key",
            "user_id",
            events("p").alias("n_points"),
            events(nested.points_of_period("p", F.lit("2024-01-15"))).alias("n_on_day"),
            F.size(periods).cast("bigint").alias("n_days"),
            periods[0].alias("first_day"),
            F.aggregate("p", F.lit(0).cast("bigint"), lambda acc, x: acc + x["k"]).alias("k_total"),
        )
    )


@query(
    "T2 T3",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 5",
)
def top_overall(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return report(ranking.top_k(lines, 5, "l_extendedprice", ["l_orderkey", "l_linenumber"]))


@query("T4", sql(f"SELECT series_key, {YM} AS month, qty FROM prices ORDER BY prices.series_key, prices.month LIMIT 5", "prices"))
def preview(spark, sf_dir):
    return report(ranking.preview(roles.prices(spark, sf_dir).select("series_key", "month", "qty"), 5, ["series_key", "month"]))


