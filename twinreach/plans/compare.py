"""Order-insensitive comparison of a Spark result with a DuckDB result
(used by the tests and ``scripts/oracle_check.py``)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

from twinreach.sources.tables import TEST_TABLES


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, digits)
    if isinstance(v, decimal.Decimal):
        return round(float(v), digits)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def digest(cols, rows, digits: int = 12) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i], digits) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(keyed).encode()).hexdigest()[:12]


def compare(sdf, con, sql: str) -> list[str]:
    """Problems found (empty when the results agree)."""
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    problems = []
    if sorted(scols) != sorted(ocols):
        problems.append(f"columns {sorted(scols)} vs {sorted(ocols)}")
    if len(srows) != len(orows):
        problems.append(f"rows {len(srows)} vs {len(orows)}")
    if not problems:
        if digest(scols, srows, 6) != digest(ocols, orows, 6):
            problems.append("values differ")
        elif digest(scols, srows, 12) != digest(ocols, orows, 12):
            problems.append("values differ beyond 1e-6 only")
    return problems
