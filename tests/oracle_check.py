"""Run registered queries beside their oracle SQL and compare the rows.

    python -m tests.oracle_check [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

from annalist.sources.scratch import drop_scratch

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return round(value, 9)
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str:
    """'' when equal, otherwise a description of the difference."""
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    theirs_columns = [c[0] for c in result.description]
    theirs_types = {c[0]: str(c[1]) for c in result.description}
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(df.columns)} <> {sorted(theirs_columns)}"
    ours_types = dict(df.dtypes)
    odd = [
        (c, ours_types[c], theirs_types[c])
        for c in df.columns
        if (ours_types[c], theirs_types[c]) not in SAME_TYPES
    ]
    mine, other = bag(df.columns, rows), bag(theirs_columns, theirs)
    if mine != other:
        return (
            f"{sum(mine.values())} rows <> {sum(other.values())} rows;"
            f" only ours {list((mine - other).items())[:3]};"
            f" only theirs {list((other - mine).items())[:3]}"
        )
    return f"types {odd}" if odd else ""


SAME_TYPES = {
    ("bigint", "BIGINT"),
    ("int", "INTEGER"),
    ("string", "VARCHAR"),
    ("date", "DATE"),
    ("boolean", "BOOLEAN"),
    ("double", "DOUBLE"),
}


def main(argv: list[str]) -> int:
    import __spark_entry__ as contract
    from pyspark.sql import SparkSession

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in argv[1:] or queries:
        began = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = compare(df, con, oracles[name]) if name in oracles else f"{df.count()} rows, no oracle"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += bool(problem)
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - began:.1f}s {problem}", flush=True)
        drop_scratch(spark)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
