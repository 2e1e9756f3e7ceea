"""Run registered queries and their SQL side by side; `python -m tests.compare [sf] [name ...]`."""

from __future__ import annotations

import datetime
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle_connection(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return value


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(out, key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    """Differences between query and SQL as text; empty when they agree exactly."""
    df = query(spark, sf_dir)
    columns, rows = table_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    wanted_columns, wanted = table_of([d[0] for d in cursor.description], cursor.fetchall())
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows != {len(wanted)}"
    different = [(a, b) for a, b in zip(rows, wanted) if repr(a) != repr(b)]
    return f"{len(different)} of {len(rows)} rows differ, first {different[0]}" if different else ""


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from plumbline.catalog.oracle import ORACLE
    from plumbline.catalog.queries import QUERIES
    from plumbline.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    for name in chosen:
        began = time.time()
        try:
            if name in ORACLE:
                problem = compare(spark, con, name, QUERIES[name], ORACLE[name], sf_dir) or "ok"
            else:
                problem = f"rows only: {len(QUERIES[name](spark, sf_dir).collect())}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - began:6.1f}s  {problem}", flush=True)


if __name__ == "__main__":
    main()
