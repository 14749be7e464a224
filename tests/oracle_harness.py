"""Spark query vs DuckDB oracle: row count, column names, order-insensitive
values (columns sorted by name, doubles rounded)."""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import sys
import time

import duckdb

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))

from tidemark.sources.testdata import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, digits) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), digits) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [cols[i].lower() for i in order]


_DUCK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
         "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float", "SMALLINT": "smallint",
         "HUGEINT": "hugeint", "DATE": "date"}


def type_diffs(sdf, rel):
    st = {f.name.lower(): f.dataType.simpleString() for f in sdf.schema.fields}
    out = []
    for name, dtype in zip([d[0] for d in rel.description], [str(t) for t in rel.types]):
        d = _DUCK.get(dtype, dtype.lower())
        sp = st.get(name.lower())
        if sp is not None and sp != d:
            out.append(f"{name}: spark {sp} / duck {dtype}")
    return out


def compare(spark, con, name, fn, sql, sf_dir, verbose=True):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = sdf.collect()
    t1 = time.time()
    rel = con.sql(sql)
    tdiff = type_diffs(sdf, rel)
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    s, scols = _rows(sdf.columns, srows)
    d, dcols2 = _rows(dcols, drows)
    ok_cols = scols == dcols2
    ok_n = len(s) == len(d)
    ok_v = s == d
    if verbose:
        print(f"{name:32s} rows {len(s):7d}/{len(d):7d} cols={'ok' if ok_cols else 'DIFF'} "
              f"vals={'ok' if ok_v else 'DIFF'} spark={t1 - t0:.2f}s", flush=True)
        if tdiff:
            print("   types:", "; ".join(tdiff))
        if not ok_cols:
            print("   spark:", scols, "\n   duck: ", dcols2)
        elif not ok_v:
            sd = set(s) - set(d)
            dd = set(d) - set(s)
            print("   only spark:", sorted(sd, key=repr)[:3])
            print("   only duck: ", sorted(dd, key=repr)[:3])
    return ok_cols and ok_n and ok_v


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from tidemark.plans.registry import oracle_sql, queries
    from tidemark.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf)
    q, o = queries(), oracle_sql()
    bad = []
    for n in (names or sorted(q)):
        if n not in o:
            t0 = time.time()
            try:
                df = q[n](spark, sf)
                print(f"{n:32s} rows {df.count():7d}  (no oracle) {time.time() - t0:.1f}s", flush=True)
            except Exception as e:
                print(f"{n:32s} ERROR {type(e).__name__}: {str(e)[:400]}")
                bad.append(n)
            continue
        try:
            if not compare(spark, con, n, q[n], o[n], sf):
                bad.append(n)
        except Exception as e:  # report and continue
            print(f"{n:32s} ERROR {type(e).__name__}: {str(e)[:400]}")
            bad.append(n)
    print("FAILED:", bad)
