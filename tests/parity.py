"""Run registered queries on both engines and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    """Equal rows up to order, under columns sorted by name; and a short account."""
    begun = time.time()
    df = query(spark, sf_dir)
    plan = df._jdf.queryExecution().toString()
    for pairs in ("CartesianProduct", "BroadcastNestedLoopJoin", "Join Cross"):
        if pairs in plan:
            return False, f"{name}: the plan has a {pairs}"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - begun
    if sql is None:
        return len(got) > 0, f"{name}: {len(got)} rows, no SQL, {spent:.1f}s"
    begun = time.time()
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = _rows(columns, cursor.fetchall())
    account = f"{name}: {len(got)} rows, spark {spent:.1f}s, sql {time.time() - begun:.1f}s"
    if sorted(columns) != sorted(df.columns):
        return False, f"{account}; columns {sorted(df.columns)} against {sorted(columns)}"
    if got == want:
        return True, account
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    only = f"{len(got)} against {len(want)} rows, {len(wrong)} differ"
    return False, f"{account}; {only}; first {str(wrong[:1])[:600]}"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        try:
            ok, account = compare(spark, con, name, query, sql.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, account = False, f"{name}: {type(error).__name__} {str(error)[:1500]}"
        print("ok  " if ok else "FAIL", account, flush=True)
