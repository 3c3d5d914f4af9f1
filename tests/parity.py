"""Compare a Spark query with its SQL in DuckDB: columns by name, rows in any order."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        return ("n", "nan") if math.isnan(v) else ("n", v + 0.0)
    if isinstance(v, int):
        return ("n", float(v)) if abs(v) < 2**53 else ("n", v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return ("t", v.isoformat())
    if v is None:
        return ("0", None)
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_plain(x) for x in v))
    return ("s", str(v))


def _ordered(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Differences as text; empty when equal."""
    names = df.columns
    spark_rows = _ordered([tuple(r) for r in df.collect()], names)
    result = con.execute(sql)
    duck_names = [d[0] for d in result.description]
    duck_rows = _ordered(result.fetchall(), duck_names)
    if sorted(names) != sorted(duck_names):
        return [f"columns {sorted(names)} vs {sorted(duck_names)}"]
    if len(spark_rows) != len(duck_rows):
        return [f"rows {len(spark_rows)} vs {len(duck_rows)}"]
    bad = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    return [f"{len(bad)} of {len(spark_rows)} rows differ, first {bad[0]}"] if bad else []
