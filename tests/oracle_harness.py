"""Run catalogue queries in Spark and their SQL in DuckDB, and compare.

Compares row count, column names and an order-insensitive hash of the values
(columns sorted by name; floats compared after rounding to 9 places).

    python tests/oracle_harness.py [/root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return names, len(lines), digest, lines


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spark_s = time.time() - t0
    s_names, s_n, s_hash, s_lines = canon(df.columns, rows)
    out = {"query": name, "rows": s_n, "spark_sec": round(spark_s, 2)}
    if sql is None:
        out["check"] = "rows-only"
        return out
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    d_names, d_n, d_hash, d_lines = canon(cols, d_rows)
    out.update(oracle_rows=d_n, names_ok=s_names == d_names, hash_ok=s_hash == d_hash)
    out["check"] = "ok" if (s_n == d_n and s_names == d_names and s_hash == d_hash) else "MISMATCH"
    if out["check"] != "ok":
        out["spark_cols"], out["duck_cols"] = s_names, d_names
        diff_s = sorted(set(s_lines) - set(d_lines))[:3]
        diff_d = sorted(set(d_lines) - set(s_lines))[:3]
        out["only_spark"], out["only_duck"] = diff_s, diff_d
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    if os.environ.get("SEEDWISE_PLAIN_SESSION"):
        # a session with Spark's defaults only, as a caller might bring
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        from seedwise.session import build_session
        spark = build_session("local[8]", shuffle_partitions=8, driver_memory="8g")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, con, sf_dir, name, qs[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            r = {"query": name, "check": "ERROR", "error": repr(e)[:600]}
        bad += r["check"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    print(f"done: {bad} failing of {len(names or qs)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
