"""Compare catalog queries with their SQL twins in DuckDB.

    python check.py [--sf 0.01] [name ...]

Rows are compared without order, columns by name; floats to nine digits. A query without a twin
is only run, and is reported as such.
"""

from __future__ import annotations

import argparse
import datetime
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("doctag")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value if value is None or isinstance(value, (bool, int, str)) else str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(body, key=repr)


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str):
    cursor = con.execute(sql)
    return normal([c[0] for c in cursor.description], cursor.fetchall())


def compare(spark, con, sf_dir: str, query) -> tuple[bool, str]:
    got = spark_rows(query.run(spark, sf_dir))
    if query.sql is None:
        return True, f"{len(got[1])} rows, no twin"
    want = duck_rows(con, query.sql)
    if got == want:
        return True, f"{len(got[1])} rows"
    if got[0] != want[0]:
        return False, f"columns {got[0]} against {want[0]}"
    a, b = set(map(repr, got[1])), set(map(repr, want[1]))
    only = [sorted(x)[:1] for x in (a - b, b - a)]
    return False, f"{len(got[1])} against {len(want[1])} rows; only here {only[0]}; only there {only[1]}"[:1500]


def main() -> int:
    from doctag.plans.catalog import QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = alone = 0
    for name, query in QUERIES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, query)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {error}"[:1500]
        bad += not ok
        alone += ok and query.sql is None
        print(f"{'FAIL' if not ok else 'ok  ' if query.sql else 'rows'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{datetime.datetime.now():%H:%M} {bad} failures, {alone} queries without a twin")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
