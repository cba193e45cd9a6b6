"""Run registered queries and their SQL side by side.

``python tests/compare.py [name ...]`` checks all or some at ``$SF_DIR``.
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fernwick.session import TABLES


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET threads=8")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t) or str(t) == "string_view":
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return f"list<{_kind(t.value_type)}>"
    return str(t)


def schema_of(table: pa.Table) -> dict[str, str]:
    return {f.name: _kind(f.type) for f in table.schema}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def rows_of(table: pa.Table) -> list[tuple]:
    cols = sorted(table.column_names)
    return sorted(zip(*[[_norm(v) for v in table[c].to_pylist()] for c in cols])) if cols else []


def compare(spark, con, folder, fn, sql):
    """None if equal, else a message; also the seconds Spark took and the number of rows."""
    start = time.time()
    got = fn(spark, folder).toArrow()
    took = time.time() - start
    if sql is None:
        return None, took, got.num_rows
    want = con.execute(sql).to_arrow_table()
    a, b = schema_of(got), schema_of(want)
    if a != b:
        diff = {k: (a.get(k), b.get(k)) for k in a.keys() | b.keys() if a.get(k) != b.get(k)}
        return f"schema spark/sql: {diff}", took, got.num_rows
    ra, rb = rows_of(got), rows_of(want)
    if ra != rb:
        sa, sb = set(ra), set(rb)
        return (f"{len(ra)} vs {len(rb)} rows; {sorted(a)}\n   spark only: {list(sa - sb)[:3]}\n"
                f"   sql only:   {list(sb - sa)[:3]}"), took, got.num_rows
    return None, took, got.num_rows


def session():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(names):
    from fernwick.plans.catalog import QUERIES, SQL

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = session(), duck(folder)
    bad = 0
    for name in names or QUERIES:
        try:
            msg, took, n = compare(spark, con, folder, QUERIES[name], SQL.get(name))
        except Exception as e:  # noqa: BLE001 - report and go on
            msg, took, n = f"{type(e).__name__}: {str(e)[:900]}", 0.0, 0
        bad += msg is not None
        print(f"{'FAIL' if msg else 'ok  '} {name} {took:.2f}s rows={n} {'' if name in SQL else '(rows only)'} {msg or ''}", flush=True)
    print(f"{bad} failures")


if __name__ == "__main__":
    main(sys.argv[1:])
