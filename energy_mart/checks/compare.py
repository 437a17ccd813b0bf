"""Run a query on both engines and compare rows, column names and column types."""

from __future__ import annotations

import datetime
import decimal
import time
from collections import Counter
from pathlib import Path

import duckdb

from energy_mart.checks.registry import QUERIES, SQL

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        file = Path(sf_dir) / f"{name}.parquet"
        if file.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, sf_dir: str, name: str) -> dict:
    """Rows, seconds and a list of problems for one registered query."""
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    out = {"rows": len(rows), "sec": round(time.time() - start, 2), "problems": []}
    if name not in SQL:
        return out
    result = connect(sf_dir).sql(SQL[name])
    names, types = result.columns, dict(zip(result.columns, map(str, result.types)))
    other = result.fetchall()
    problems = out["problems"]
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
        return out
    for column, kind in df.dtypes:
        wanted = SAME_TYPE.get(kind, kind.upper().replace("DECIMAL", "DECIMAL"))
        if wanted != types[column]:
            problems.append(f"type of {column}: {kind} != {types[column]}")
    left, right = _bag(df.columns, rows), _bag(names, other)
    if left != right:
        problems.append(
            f"rows {len(rows)} != {len(other)}; only here {list((left - right))[:3]};"
            f" only there {list((right - left))[:3]}"
        )
    if not rows:
        problems.append("no rows")
    return out
