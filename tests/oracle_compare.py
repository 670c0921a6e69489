"""Run registered queries against their DuckDB oracles, the way the driver does.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v if isinstance(v, (bool, int, str)) else str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted([c for c in (cols[i] for i in order)]), sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = sdf.collect()
    t1 = time.time()
    s_cols, s_vals = rows_of(sdf.columns, s_rows)
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    d_cols_raw = [d[0] for d in res.description]
    d_rows = res.fetchall()
    d_cols, d_vals = rows_of(d_cols_raw, d_rows)
    ok = s_cols == d_cols and s_vals == d_vals
    info = {"name": name, "ok": ok, "rows": len(s_rows), "oracle_rows": len(d_rows), "spark_s": round(t1 - t0, 2)}
    if not ok:
        if s_cols != d_cols:
            info["cols"] = (s_cols, d_cols)
        else:
            sv, dv = set(s_vals), set(d_vals)
            info["only_spark"] = sorted(sv - dv, key=repr)[:3]
            info["only_oracle"] = sorted(dv - sv, key=repr)[:3]
    return info


def main(argv):
    sys.path.insert(0, ".")
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from stratum.session import get_session
    spark = get_session(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            info = compare(spark, con, name, qs[name], oracles.get(name), sf_dir)
        except Exception as exc:  # report and continue
            info = {"name": name, "ok": False, "error": f"{type(exc).__name__}: {str(exc)[:600]}"}
        bad += info.get("ok") is False
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
