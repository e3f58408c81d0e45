"""Spark-vs-DuckDB result comparison used by the tests and scripts/compare.py."""

from __future__ import annotations

import decimal
import math

import duckdb

from .sources.fixtures import TABLES


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (list, tuple, dict)):
        return str(v)
    return v


def canonical(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in records), key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_df, con, sql: str) -> list[str]:
    """Empty list when equal (column names, row count, multiset of values)."""
    sp_cols = spark_df.columns
    sp = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    dk_cols = [d[0] for d in cur.description]
    dk = cur.fetchall()
    problems = []
    if sorted(sp_cols) != sorted(dk_cols):
        problems.append(f"columns {sorted(sp_cols)} vs {sorted(dk_cols)}")
    if len(sp) != len(dk):
        problems.append(f"rows {len(sp)} vs {len(dk)}")
    if not problems:
        a, b = canonical(sp_cols, sp), canonical(dk_cols, dk)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            problems.append(f"values differ, e.g. {diff}")
    return problems
