from datetime import date


def month(text):
    y, m = text.split("-")
    return date(int(y), int(m), 1)


def months(start, n):
    y, m = (int(x) for x in start.split("-"))
    return [date(y + (m - 1 + i) // 12, (m - 1 + i) % 12 + 1, 1) for i in range(n)]


def series(spark, values, key="a", start="2020-01", name="x"):
    """One series with consecutive months; ``...`` leaves a month out."""
    rows = [(key, d, v) for d, v in zip(months(start, len(values)), values) if v is not ...]
    return spark.createDataFrame(rows, f"series_key string, month date, {name} double")


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*(order or ("series_key", "month"))).collect()]
