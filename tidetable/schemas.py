"""Explicit schemas of the inputs and tables, as DDL text; nothing is inferred at scan time."""

from __future__ import annotations

VECTOR_POINT = "struct<refPer:string,value:double>"
VECTOR_PAYLOAD = f"status string, object struct<vectorId:bigint, vectorDataPoint:array<{VECTOR_POINT}>>"
RESPONSE_PAYLOAD = (
    "response struct<total:string, dateFormat:string, frequency:string, data:array<struct<period:string, value:string>>>"
)
IMPORT_COLUMNS = ("period", "code", "country", "quantity")
PRICE_SILVER = "series_key string, month date, price double"
PRICE_ADJUSTED = "series_key string, month date, price_before_adjustment double, cpi double, price_adjusted double"
FORECAST = "series_key string, month date, prediction double, lower_bound double, upper_bound double"


def coded_series(*codes: str) -> str:
    """``observations: [{d, CODE: {v}}]`` for one or several series codes."""
    fields = "".join(f", `{c}`: struct<v:string>" for c in codes)
    return f"observations array<struct<d:string{fields}>>"


def all_strings(*columns: str) -> str:
    return ", ".join(f"`{c}` string" for c in columns)
