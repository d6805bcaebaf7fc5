"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Mirrors the driver's correctness gate: column names, row count and an
order-insensitive comparison of all values (floats compared exactly after
normalising -0.0; timestamps as naive datetimes).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return 0.0 if v == 0 else v
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def rows_sorted(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
    "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT", "date": "DATE",
}


def type_mismatches(df, rel) -> list[str]:
    duck_types = {d[0]: str(t) for d, t in zip(rel.description, rel.types)}
    out = []
    for f in df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if duck_types.get(f.name) != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} vs duck {duck_types.get(f.name)}")
    return out


def compare(spark, sf_dir: str, names: list[str]) -> dict[str, str]:
    q = E.queries()
    sql = E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names:
        t0 = time.time()
        try:
            df = q[name](spark, sf_dir)
            s_cols = list(df.columns)
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:400]}"
            continue
        if name not in sql:
            results[name] = f"rows-only {len(s_rows)}"
            continue
        try:
            rel = con.sql(sql[name])
            d_cols = [c[0] for c in rel.description]
            types_bad = type_mismatches(df, rel)
            d_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {type(e).__name__}: {str(e)[:400]}"
            continue
        if sorted(s_cols) != sorted(d_cols):
            results[name] = f"COLUMNS differ spark={s_cols} duck={d_cols}"
            continue
        a = rows_sorted(s_cols, s_rows)
        b = rows_sorted(d_cols, d_rows)
        if len(a) != len(b):
            results[name] = f"ROWCOUNT spark={len(a)} duck={len(b)}"
            continue
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        dt = time.time() - t0
        if diff:
            results[name] = f"VALUES differ ({len(diff)}): {diff[:2]}"
        elif types_bad:
            results[name] = f"TYPES differ: {types_bad}"
        else:
            results[name] = f"OK rows={len(a)} ({dt:.1f}s)"
    return results


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[2:] or list(E.queries())
    res = compare(spark, sf, names)
    for k, v in res.items():
        print(f"{k:36s} {v}")
    bad = [k for k, v in res.items() if not v.startswith("OK")]
    print("FAILED:", bad if bad else "none")
