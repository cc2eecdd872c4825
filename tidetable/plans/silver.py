"""Raw inputs to cleaned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.functions import dates, numeric, text
from tidetable.operators import joins, panel
from tidetable.operators.reshape import recode
from tidetable.sources import json


def prices(payload: DataFrame, vectors: DataFrame, *, geography: str = "Canada") -> DataFrame:
    """Vector documents to (series_key, month, price) of one geography.

    ``vectors`` is (vector_id, geography, product); ids it does not hold become
    ``Unknown`` and fall out with the geography filter.
    """
    points = json.vector_points(payload)
    named = joins.lookup(points, vectors, "vector_id", {"geography": "Unknown", "product": "Unknown"})
    return named.filter(F.col("geography") == geography).select(
        F.col("product").alias("series_key"), "month", F.col("value").alias("price")
    )


def price_index(payload: DataFrame) -> DataFrame:
    """Vector documents to (month, cpi), without empty values."""
    return json.vector_points(payload).filter(F.col("value").isNotNull()).select("month", F.col("value").alias("cpi"))


def imports(raw: DataFrame, codes: dict[str, str], countries: dict[str, str]) -> DataFrame:
    """All-text rows (period, code, country, quantity) to monthly quantity per product and partner.

    Codes lose their leading zeros upstream and get them back here; bad months
    drop the row, bad quantities count as 0.
    """
    cleaned = raw.select(
        dates.month_of_compact(F.trim("period")).alias("month"),
        joins.map_codes(text.zero_pad(F.trim("code"), 6), codes).alias("series_key"),
        joins.map_codes(F.trim("country"), countries).alias("partner"),
        F.coalesce(numeric.to_number("quantity"), F.lit(0.0)).alias("qty"),
    )
    wanted = cleaned.filter(
        F.col("month").isNotNull() & F.col("series_key").isNotNull() & F.col("partner").isNotNull()
    )
    return wanted.groupBy("series_key", "month", "partner").agg(F.sum("qty").alias("qty"))


def exchange_rates(early: dict[str, DataFrame], late: DataFrame, names: dict[str, str]) -> DataFrame:
    """Two single-series documents for the early years, one grouped document for the later ones."""
    singles = [json.coded_series(payload, code, names[code]) for code, payload in early.items()]
    early_wide = joins.join_all(singles, "month", "full")
    return joins.stack([early_wide, json.grouped_series(late, names)], allow_missing=True)


def weather(raw: DataFrame, names: dict[str, str], regions: list[str], renamed: dict[str, str]) -> DataFrame:
    """Typed regional readings: columns renamed, bad numbers to NULL, wanted regions only.

    ``names`` maps raw columns to (day, state_id, state, min_c, mean_c, max_c,
    precipitation_mm); ``renamed`` maps region names to the ones used here.
    """
    df = panel.rename(raw, names)
    measures = [c for c in ("min_c", "mean_c", "max_c", "precipitation_mm") if c in df.columns]
    df = df.withColumns({c: numeric.to_number(c) for c in measures})
    df = df.withColumns({"day": dates.date_of_text(F.col("day").cast("string")), "state": recode("state", renamed)})
    return df.filter(F.col("state").isin(regions) & F.col("day").isNotNull())


def diesel_us(payload: DataFrame, rates: DataFrame, *, litres: float = 3.78541) -> DataFrame:
    """US dollars per gallon to Canadian dollars per litre; months without a rate fall out."""
    us = json.response_data(payload)
    return us.join(rates.select("month", "usd_cad"), "month").select(
        "month", (F.col("value") * F.col("usd_cad") / litres).alias("us_cad_l")
    )


def diesel_canada(readings: DataFrame) -> DataFrame:
    """City readings in cents to a national mean in dollars."""
    return readings.groupBy("month").agg((F.avg("value") / 100).alias("ca_cad_l"))


def diesel(us: DataFrame, canada: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Months in both tables with the blended price."""
    weights = weights or {"us_cad_l": 0.8, "ca_cad_l": 0.2}
    return us.join(canada, "month").withColumn("integrated_gas_price", numeric.blend(weights))


def adjusted_prices(prices: DataFrame, index: DataFrame, base: Column) -> DataFrame:
    """Prices at the price level of the base month; only months with both inputs.

    ``index`` is one row per month, so it stays a calendar-sized table.
    """
    based = joins.with_base(index.select("month", "cpi"), "cpi", base, name="base_cpi")
    return joins.at_month(prices, based).select(
        "series_key",
        "month",
        F.col("price").alias("price_before_adjustment"),
        "cpi",
        numeric.deflate("price", "cpi", "base_cpi").alias("price_adjusted"),
    )
