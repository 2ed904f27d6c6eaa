"""Spark-vs-DuckDB parity check for the registered queries.

Mirrors the driver's gate: same row count, same column names and types, and
the same order-insensitive multiset of rows (columns sorted by name). Floats compare
after rounding to 9 significant digits, timestamps as naive UTC.

    python tests/parity.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return _canon(v.item())
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return float(f"{float(v):.9g}")
    except Exception:  # pragma: no cover
        pass
    return v


# Spark simple type names and the DuckDB type each should come out as.
SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_canon(r[i]) for i in order) for r in records], sorted(columns)


def compare(spark, name: str, query, sql: str | None, sf_dir: str, con) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    s_rows, s_cols = rows_of(df.columns, spark_rows)
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    out["types_match"] = spark_types == duck_types
    if not out["types_match"]:
        out["type_diff"] = {c: (spark_types.get(c), duck_types.get(c)) for c in set(spark_types) | set(duck_types) if spark_types.get(c) != duck_types.get(c)}
    d_rows, d_cols_sorted = rows_of(d_cols, rel.fetchall())
    out["oracle_rows"] = len(d_rows)
    out["columns_match"] = s_cols == d_cols_sorted
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols_sorted
    cs, cd = Counter(s_rows), Counter(d_rows)
    out["values_match"] = cs == cd
    if not out["values_match"]:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        out["only_spark"], out["only_oracle"] = only_s, only_d
    out["status"] = "ok" if out["columns_match"] and out["values_match"] and out["types_match"] else "MISMATCH"
    return out


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from strata.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = set(argv[1:])
    spark = local_session()
    con = duck(sf_dir)
    sqls = oracle_sql()
    bad = 0
    for name, q in queries().items():
        if wanted and name not in wanted:
            continue
        try:
            res = compare(spark, name, q, sqls.get(name), sf_dir, con)
        except Exception as exc:  # report and continue
            res = {"name": name, "status": "ERROR", "error": repr(exc)[:600]}
        bad += res["status"] not in ("ok", "rows-only")
        print(res, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
