"""Compare a Spark query with its DuckDB SQL oracle on the same parquet tables.

Used by the tests and runnable by hand:
``python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]``.
Values are compared exactly (after turning both sides into plain Python values),
rows order-insensitively, columns by name.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, bool):
        return str(v)
    return str(v) if not isinstance(v, int) else str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = cur.fetchall()
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in rows]


def _key(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(con, sql)
    if [c.lower() for c in s_cols] != [c.lower() for c in d_cols]:
        return False, f"{name}: columns differ spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: rows differ spark={len(s_rows)} duck={len(d_rows)}"
    s_sorted = sorted(s_rows, key=_key)
    d_sorted = sorted(d_rows, key=_key)
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            return False, f"{name}: first differing row\n spark={a}\n duck ={b}"
    return True, f"{name}: ok ({len(s_rows)} rows)"


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from cairn.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    con = duck_connection(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"{name}: no oracle, {df.count()} rows")
            continue
        try:
            ok, msg = compare(spark, con, sf_dir, name, qs[name], sqls[name])
        except Exception as e:  # report and go on
            ok, msg = False, f"{name}: error {type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(msg, flush=True)
    print(f"failed: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
