"""Compare queries with their DuckDB oracles: ``python tests/oracle_check.py [sf_dir] [key ...]``."""

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """Differences as text; empty when equal."""
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, df.collect())
    result = con.sql(sql)
    want_columns, want = rows_of(result.columns, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        missing, extra = want - got, got - want
        return (
            f"{sum(got.values())} rows, {sum(want.values())} wanted; "
            f"missing {list(missing)[:2]}, extra {list(extra)[:2]}"
        )
    return "" if got else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from footfall.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8,
                          **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if name not in oracles or (sys.argv[2:] and name not in sys.argv[2:]):
            continue
        started = time.time()
        try:
            problem = compare(spark, con, name, query, oracles[name], sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{name}: {problem or 'ok'} ({time.time() - started:.1f}s)", flush=True)
    print("keys without oracle:", sorted(set(entry.queries()) - set(oracles)))
    print("bad:", bad)
