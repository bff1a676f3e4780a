"""Run queries() against oracle_sql() the way the driver does: same parquet
tables, DuckDB for the SQL, row count + column names + order-insensitive value
hash with columns sorted by name."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if os.environ.get("ORACLE_STRICT") else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    sh, sl = digest(scols, srows)
    dh, dl = digest(dcols, drows)
    ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and sh == dh
    info = dict(name=name, ok=ok, spark_rows=len(srows), duck_rows=len(drows), spark_s=round(t1 - t0, 2),
                duck_s=round(t2 - t1, 2))
    if not ok:
        info["cols"] = (sorted(scols), sorted(dcols))
        only_s = sorted(set(sl) - set(dl))[:3]
        only_d = sorted(set(dl) - set(sl))[:3]
        info["only_spark"] = only_s
        info["only_duck"] = only_d
    return info


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from kenning.session import build_session
    sf_dir = "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    names = argv or list(qs)
    bad = 0
    for n in names:
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print({"name": n, "rows_only": df.count()})
            continue
        try:
            info = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            info = {"name": n, "ok": False, "error": repr(e)[:800]}
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
