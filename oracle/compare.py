"""Compare a Spark result with a DuckDB result: column names, row count, order-insensitive
values (floats to 6 decimals)."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

from planscore.sources.tables import TABLE_NAMES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def compare(df, con, sql: str) -> tuple[bool, str]:
    cols = sorted(df.columns)
    srows = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    if sorted(dcols) != cols:
        return False, f"columns differ: spark={cols} duckdb={sorted(dcols)}"
    idx = [dcols.index(c) for c in cols]
    drows = Counter(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    if srows != drows:
        only_s = list((srows - drows).elements())[:3]
        only_d = list((drows - srows).elements())[:3]
        return False, f"values differ ({sum(srows.values())} vs {sum(drows.values())} rows): " \
                      f"spark-only={only_s} duckdb-only={only_d}"
    return True, f"{sum(srows.values())} rows"
