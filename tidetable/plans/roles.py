"""The given tables in the roles of monthly statistics, and the same as SQL.

Sales play the price series, orders the price index, regional order values the
weather, discount and tax the exchange rate and the diesel price, customers a
large panel with gaps.  Sums of money are exact, so both engines agree.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.functions import dates, numeric
from tidetable.operators.joins import at_month, roll_up
from tidetable.session import materialize

BASE_MONTH = "1997-01-01"
START_MONTH = "1996-01-01"
HORIZON_END = "2002-03-01"
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
REGION_WEIGHTS = {"ASIA": 0.7, "EUROPE": 0.2, "AFRICA": 0.1}
LAGS = {"import_qty": 0, "order_value": 2, "discount": 1, "tax": 7}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month(text: str):
    return F.lit(text).cast("date")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        "l_discount",
        "l_tax",
        dates.month_start("l_shipdate").alias("month"),
        F.col("l_quantity").alias("qty"),
        numeric.hundredths("l_extendedprice").alias("amount"),
    )


def sales_months(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last month of the lines, two values that the calendar of a wide table needs."""
    months = table(spark, sf_dir, "lineitem").select(dates.month_start("l_shipdate").alias("month"))
    first, last = months.agg(F.min("month"), F.max("month")).first()
    return first, last


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("series_key"))


def supplier_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("partner"))
    )


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("r_name").alias("state"))
    )


def monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per brand and month from one pass over the lines, money in hundredths; unused ones are pruned."""
    sums = {
        "qty": F.col("qty"),
        "amount": F.col("amount"),
        "discount": numeric.hundredths("l_discount"),
        "tax": numeric.hundredths("l_tax"),
        "n": F.lit(1),
    }
    dims = [(brands(spark, sf_dir), {"l_partkey": "p_partkey"})]
    return roll_up(sales(spark, sf_dir), dims, ["series_key", "month"], sums)


def priced(monthly: DataFrame) -> DataFrame:
    amount = F.col("amount") / F.lit(100.0)
    return monthly.select(
        "series_key", "month", "qty", amount.alias("amount"), numeric.whole_ratio("amount", F.col("qty") * 100, 4).alias("price")
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_key, month, qty, amount, price) per brand."""
    return priced(monthly_sales(spark, sf_dir))


def price_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`prices` written once, for plans that read it several times."""
    return materialize(prices(spark, sf_dir), "prices")


def partner_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_key, partner, month, qty, amount): brand sales by the region of the supplier."""
    return roll_up(
        sales(spark, sf_dir),
        [
            (brands(spark, sf_dir), {"l_partkey": "p_partkey"}),
            (supplier_regions(spark, sf_dir), {"l_suppkey": "s_suppkey"}),
        ],
        ["series_key", "partner", "month"],
        {"qty": F.col("qty"), "amount": F.col("amount")},
    )


def partner_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partner_sales(spark, sf_dir).drop("amount")


def prices_and_partners(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Prices and partner quantities from one pass over the lines."""
    layer = materialize(partner_sales(spark, sf_dir), "partners")
    monthly = layer.groupBy("series_key", "month").agg(F.sum("qty").alias("qty"), F.sum("amount").alias("amount"))
    return priced(monthly), layer.drop("amount")


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, cpi): mean order value, in thousands."""
    orders = table(spark, sf_dir, "orders").select(
        dates.month_start("o_orderdate").alias("month"), numeric.hundredths("o_totalprice").alias("v")
    )
    return orders.groupBy("month").agg(numeric.whole_ratio(F.sum("v"), F.count(F.lit(1)) * 100000, 4).alias("cpi"))


def regional_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(state, month, mean_c, n): mean order value per region, in thousands."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        dates.month_start("o_orderdate").alias("month"),
        numeric.hundredths("o_totalprice").alias("v"),
    )
    sums = roll_up(
        orders,
        [(customer_regions(spark, sf_dir), {"o_custkey": "c_custkey"})],
        ["state", "month"],
        {"v": F.col("v"), "n": F.lit(1)},
    )
    return sums.select("state", "month", numeric.whole_ratio("v", F.col("n") * 100000, 4).alias("mean_c"), "n")


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, discount, tax) as means in percent."""
    rows = table(spark, sf_dir, "lineitem").select(
        dates.month_start("l_shipdate").alias("month"),
        numeric.hundredths("l_discount").alias("discount"),
        numeric.hundredths("l_tax").alias("tax"),
        F.lit(1).alias("n"),
    )
    return monthly_rates(rows)


def monthly_rates(rows: DataFrame) -> DataFrame:
    """From lines, or from sums of lines, with both measures in hundredths."""
    n = F.sum("n")
    return rows.groupBy("month").agg(
        numeric.whole_ratio(F.sum("discount"), n, 4).alias("discount"),
        numeric.whole_ratio(F.sum("tax"), n, 4).alias("tax"),
    )


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_key, month, spend) per customer: many series, most months empty."""
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.col("o_custkey").alias("series_key"),
            dates.month_start("o_orderdate").alias("month"),
            "o_totalprice",
        )
        .groupBy("series_key", "month")
        .agg(numeric.money_sum("o_totalprice").alias("spend"))
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_key, day, value, ...) from events, one row per event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_key"),
        F.col("ts").cast("date").alias("day"),
        "user_id",
        "value",
        "event_id",
        "ts",
        "props",
    )


def features(spark: SparkSession, sf_dir: str, *, with_price: bool = False) -> DataFrame:
    """(series_key, month, import_qty, order_value, discount, tax[, price]) of months present in all inputs.

    Brand sums are written once; quantities, prices and rates all come from
    them, so the lines are read once.
    """
    monthly = materialize(monthly_sales(spark, sf_dir), "sales")
    own = priced(monthly).select("series_key", "month", F.col("qty").alias("import_qty"), *(["price"] if with_price else []))
    values = index(spark, sf_dir).withColumnRenamed("cpi", "order_value")
    columns = ["series_key", "month", "import_qty", "order_value", "discount", "tax", *(["price"] if with_price else [])]
    return at_month(at_month(own, values), monthly_rates(monthly)).select(*columns)


def feature_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`features` with the price, written once for plans that read it several times."""
    return materialize(features(spark, sf_dir, with_price=True), "features")


def _whole(top: str, bottom: str) -> str:
    """SQL twin of ``whole_ratio`` with four digits."""
    return f"CAST((20000 * {top} + {bottom}) // (2 * {bottom}) AS DOUBLE) / 10000.0"


def _hundredths(column: str) -> str:
    return f"sum(CAST(round({column} * 100) AS BIGINT))"


SQL = {
    "prices": f"""SELECT p_brand AS series_key, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
        sum(l_quantity) AS qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
        {_whole(_hundredths('l_extendedprice'), '(100 * CAST(sum(l_quantity) AS BIGINT))')} AS price
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "partner_quantities": """SELECT p_brand AS series_key, r_name AS partner,
        CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(l_quantity) AS qty
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3""",
    "cpi": f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
        {_whole(_hundredths('o_totalprice'), '(100000 * count(*))')} AS cpi
        FROM orders GROUP BY 1""",
    "regional": f"""SELECT r_name AS state, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
        {_whole(_hundredths('o_totalprice'), '(100000 * count(*))')} AS mean_c, count(*) AS n
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    "rates": f"""SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
        {_whole(_hundredths('l_discount'), 'count(*)')} AS discount, {_whole(_hundredths('l_tax'), 'count(*)')} AS tax FROM lineitem GROUP BY 1""",
    "spend": """SELECT o_custkey AS series_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend FROM orders GROUP BY 1, 2""",
    "readings": """SELECT event_type AS series_key, CAST(ts AS DATE) AS day, user_id, value, event_id, ts, props FROM events""",
    "features": """SELECT p.series_key, p.month, p.qty AS import_qty, c.cpi AS order_value, r.discount, r.tax
        FROM prices p JOIN cpi c USING (month) JOIN rates r USING (month)""",
    "spend_spine": """SELECT b.series_key, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
        FROM (SELECT series_key, min(month) AS lo, max(month) AS hi FROM spend GROUP BY 1) b""",
    "spend_aligned": """SELECT s.series_key, s.month, p.spend FROM spend_spine s LEFT JOIN spend p USING (series_key, month)""",
}
NEEDS = {
    "features": ("prices", "cpi", "rates"),
    "spend_spine": ("spend",),
    "spend_aligned": ("spend", "spend_spine"),
}


def sql(body: str, *roles: str, **extra: str) -> str:
    """``body`` with the named roles in front as common table expressions; ``extra`` adds local ones."""
    wanted: list[str] = []

    def add(role: str) -> None:
        for need in NEEDS.get(role, ()):
            add(need)
        if role not in wanted:
            wanted.append(role)

    for r in roles:
        add(r)
    parts = [f"{r} AS ({SQL[r]})" for r in wanted] + [f"{n} AS ({t})" for n, t in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
