"""Run registered queries in Spark and their oracle SQL in DuckDB; compare unordered.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

EXACT = os.environ.get("ORACLE_EXACT") == "1"  # compare doubles bit for bit, as a value hash would
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else format(v, "f").rstrip("0")
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return v
    return v


def spark_type_name(t) -> str:
    from pyspark.sql import types as T

    simple = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.StringType: "VARCHAR", T.DoubleType: "DOUBLE",
              T.BooleanType: "BOOLEAN", T.FloatType: "FLOAT", T.ShortType: "SMALLINT", T.ByteType: "TINYINT",
              T.DateType: "DATE", T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.TimestampNTZType: "TIMESTAMP",
              T.BinaryType: "BLOB"}
    for k, v in simple.items():
        if isinstance(t, k):
            return v
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return t.simpleString().upper()


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    problems = []
    s_types = {f.name: spark_type_name(f.dataType) for f in sdf.schema.fields}
    d_types = {d[0]: str(d[1]).upper() for d in res.description}
    bad_types = {c: (s_types[c], d_types.get(c)) for c in s_types if c in d_types and s_types[c] != d_types[c]}
    if bad_types:
        problems.append(f"types differ: {bad_types}")
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
        return problems, len(s_rows), len(d_rows), t1 - t0, t2 - t1
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_norm = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows), key=_key)
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    if s_norm != d_norm:
        for a, b in zip(s_norm, d_norm):
            if a != b:
                cols = [s_cols[i] for i in order]
                diff = {c: (x, y) for c, x, y in zip(cols, a, b) if x != y}
                problems.append(f"first differing row: {diff}")
                break
        else:
            problems.append("values differ")
    return problems, len(s_rows), len(d_rows), t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)]
    import __spark_entry__ as entry
    from changelake.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connect(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sorted(qs):
        if names and name not in names:
            continue
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"ROWS-ONLY {name}: {n} rows")
            continue
        try:
            problems, ns, nd, ts, td = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            problems, ns, nd, ts, td = [f"error: {type(e).__name__}: {str(e)[:600]}"], -1, -1, 0, 0
        status = "OK " if not problems else "BAD"
        failed += bool(problems)
        print(f"{status} {name}: spark={ns} duck={nd} ({ts:.1f}s/{td:.1f}s) {' | '.join(problems)}")
    print(f"failed={failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
