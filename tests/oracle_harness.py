"""Run registered Spark queries next to their DuckDB oracles and compare results.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of the values (doubles
rounded to 6 dp, timestamps normalised to naive UTC).
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from sluice.sources.driver_tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if not isinstance(v, (list, tuple, dict)) and not hasattr(v, "__len__") or isinstance(v, str) is False:
        try:
            if pd.isna(v):
                return None
        except (TypeError, ValueError):
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        if v is pd.NaT:
            return None
        if v.tzinfo is not None:
            v = v.tz_convert("UTC").tz_localize(None)
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = sorted(repr(tuple(_norm(r[c]) for c in cols)) for _, r in pdf.iterrows())
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(pdf), cols, h


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        sp = fn(spark, sf_dir).toPandas()
        st = time.time() - t
        if name not in sqls:
            results[name] = ("rows-only", len(sp), None)
            if verbose:
                print(f"{name:40s} rows-only  n={len(sp)}  {st:.2f}s")
            continue
        dd = con.sql(sqls[name]).df()
        a, b = digest(sp), digest(dd)
        ok = a == b
        results[name] = ("ok" if ok else "MISMATCH", a, b)
        if verbose:
            print(f"{name:40s} {'ok' if ok else 'MISMATCH'}  spark n={a[0]} duck n={b[0]}  {st:.2f}s")
            if not ok:
                if a[1] != b[1]:
                    print("   cols", a[1], b[1])
                else:
                    cols = a[1]
                    sa = set(repr(tuple(_norm(r[c]) for c in cols)) for _, r in sp.iterrows())
                    sb = set(repr(tuple(_norm(r[c]) for c in cols)) for _, r in dd.iterrows())
                    print("   spark-only", list(sa - sb)[:3])
                    print("   duck-only ", list(sb - sa)[:3])
    return results


if __name__ == "__main__":
    from sluice.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("mismatches:", bad)
