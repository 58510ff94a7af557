"""Run registered queries against their SQL and compare names, types and values.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if hasattr(value, "asDict"):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
               "TIMESTAMP": "timestamp", "BOOLEAN": "boolean"}


def compare(spark, db, name, query, sql, folder) -> str | None:
    """None when both sides agree, else what differs."""
    got = query(spark, folder)
    rows = got.collect()
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    types = dict(zip(names, (str(d[1]) for d in result.description)))
    for field in got.schema.fields:
        expected = SPARK_TYPES.get(types[field.name], types[field.name].lower())
        if field.dataType.simpleString().replace("_ntz", "") != expected:
            return f"type of {field.name}: {field.dataType.simpleString()} != {types[field.name]}"
    mine, theirs = rows_of(got.columns, rows), rows_of(names, want)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"values {sorted(names)}\n   spark  {a}\n   oracle {b}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from martwright.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", 8, spark__driver__memory="8g", spark__log__level="ERROR")
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = oracle_connection(folder), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, db, name, queries[name], oracles[name], folder)
            else:
                problem, rows = None, queries[name](spark, folder).count()
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
