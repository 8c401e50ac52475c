"""Run registered queries beside their DuckDB statements: ``python -m tests.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(value):
    """A value both engines print alike."""
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return rows_of(columns, cursor.fetchall())


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def main(argv):
    import __spark_entry__ as registry
    from eventlake.session import build_session

    folder = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    sql = registry.oracle_sql()
    failures = 0
    for name, query in registry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            got = spark_rows(query(spark, folder))
        except Exception as error:  # report and go on to the next query
            failures += 1
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
            continue
        took = time.time() - start
        if name not in sql:
            print(f"rows {name}: {len(got[1])} rows {took:.2f}s", flush=True)
            continue
        try:
            want = duck_rows(con, sql[name])
        except Exception as error:
            failures += 1
            print(f"FAIL {name}: oracle {str(error)[:800]}", flush=True)
            continue
        if got == want:
            print(f"ok   {name}: {len(got[1])} rows {took:.2f}s", flush=True)
        else:
            failures += 1
            print(f"DIFF {name}: {got[0]} {want[0]} rows {len(got[1])} vs {len(want[1])}")
            print("  spark only", [r for r in got[1] if r not in set(want[1])][:3])
            print("  duck only ", [r for r in want[1] if r not in set(got[1])][:3], flush=True)
    print("failures", failures)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
