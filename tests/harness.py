"""Spark-vs-DuckDB comparison used by the oracle tests and by hand.

Usage: ``python tests/harness.py [sf_dir] [key ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return format(v.quantize(decimal.Decimal("0.01")) if v.as_tuple().exponent >= -2 else v, "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def spark_type(t) -> str:
    s = t.simpleString()
    return _SPARK_TO_DUCK.get(s, s.upper())


def compare(spark, con, key: str, query, sql: str, sf_dir: str) -> dict:
    df = query(spark, sf_dir)
    s_names = df.columns
    s_types = {f.name: spark_type(f.dataType) for f in df.schema.fields}
    s_rows = df.collect()
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_rows = res.fetchall()
    d_types = {d[0]: str(d[1]) for d in res.description}
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    out["names_match"] = sorted(s_names) == sorted(d_names)
    out["type_mismatch"] = {
        n: (s_types.get(n), d_types.get(n)) for n in s_names if n in d_types and s_types.get(n) != d_types.get(n)
    }
    order = sorted(s_names)
    if out["names_match"]:
        s_bag = Counter(tuple(norm(r[n]) for n in order) for r in s_rows)
        idx = [d_names.index(n) for n in order]
        d_bag = Counter(tuple(norm(r[i]) for i in idx) for r in d_rows)
        out["values_match"] = s_bag == d_bag
        if not out["values_match"]:
            out["only_spark"] = list((s_bag - d_bag).items())[:3]
            out["only_oracle"] = list((d_bag - s_bag).items())[:3]
    else:
        out["values_match"] = False
        out["names"] = (sorted(s_names), sorted(d_names))
    out["ok"] = out["values_match"] and out["spark_rows"] == out["oracle_rows"] and not out["type_mismatch"]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from remitview.session import local_session

    spark = local_session(8)
    con = duck_connection(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        if k not in sqls:
            print(f"{k}: no oracle")
            continue
        r = compare(spark, con, k, qs[k], sqls[k], sf_dir)
        bad += not r["ok"]
        print(r if not r["ok"] else f"{k}: ok rows={r['spark_rows']}", flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
