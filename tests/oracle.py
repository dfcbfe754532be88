"""Runs a registered query and its SQL on the same tables and compares all rows.

As a script: ``python tests/oracle.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> DuckDB type; decimals are compared by name as they are.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, query) -> tuple[int, list[str]]:
    """Number of rows of ``df``, and what differs from the query's SQL (empty: the same)."""
    answer = con.execute(query.sql)
    names = [d[0] for d in answer.description]
    found = []
    if sorted(df.columns) != sorted(names):
        return 0, [f"columns: {sorted(df.columns)} / {sorted(names)}"]
    described = con.execute("DESCRIBE " + query.sql).fetchall()
    types = {row[0]: row[1] for row in described}
    for field in df.schema.fields:
        spark_type = field.dataType.simpleString()
        wanted = SAME_TYPE.get(spark_type, spark_type.upper())
        if types[field.name] != wanted:
            found.append(f"type of {field.name}: {spark_type} / {types[field.name]}")
    left = _rows(df.columns, df.collect())
    right = _rows(names, con.execute(query.sql).fetchall())
    for label, extra in (("only Spark", left - right), ("only SQL", right - left)):
        if extra:
            found.append(f"{label}: {sum(extra.values())} rows, e.g. {list(extra)[:2]}")
    return sum(left.values()), found


def main() -> int:
    import __spark_entry__  # noqa: F401
    from perkline.session import build_session
    from workload.registry import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle", "local[8]", 8, {"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in wanted:
        started = time.time()
        try:
            rows, found = differences(QUERIES[name].build(spark, sf_dir), con, QUERIES[name])
        except Exception as error:  # report and go on with the next query
            rows, found = 0, [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} rows={rows} {time.time() - started:.1f}s", flush=True)
        for line in found:
            print("      ", line)
    print(f"{len(wanted) - bad}/{len(wanted)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main())
