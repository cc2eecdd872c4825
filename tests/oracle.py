"""Run catalog queries next to DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return repr(v)
    return f"{type(v).__name__}:{v}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, x or "") for x in t))


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and its SQL; empty when names, types and values agree."""
    spark_rows = [tuple(r) for r in df.collect()]
    duck = con.execute(sql)
    names = [d[0] for d in duck.description]
    duck_rows = duck.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    a, b = _rows(df.columns, spark_rows), _rows(names, duck_rows)
    if len(a) != len(b):
        return [f"{len(a)} rows against {len(b)}"]
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return [f"{len(wrong)} of {len(a)} rows differ, columns {sorted(names)}: {wrong[:2]}"] if wrong else []


def main(sf_dir: str, names: list[str]) -> int:
    import pathlib

    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries

    from tidetable import build_session

    spark = build_session("check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = build(spark, sf_dir)
            problems = compare(df, con, oracles[name]) if name in oracles else [] if df.count() else ["no rows"]
        except Exception as e:
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {name:28s} {kind:4s} {time.time() - t0:6.2f}s {' '.join(problems)[:900]}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
