"""Compare registered queries with their SQL on DuckDB. Also runs as a script."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str:
    """Empty if both sides agree in column names and rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == wanted:
        return ""
    return (
        f"{sum(got.values())} rows instead of {sum(wanted.values())}; "
        f"extra {list((got - wanted).items())[:2]}; missing {list((wanted - got).items())[:2]}"
    )


def main() -> None:
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            outcome = difference(df, con, sql) if sql else f"rows only: {df.count()}"
        except Exception as error:
            outcome = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        bad += bool(outcome) and not outcome.startswith("rows only")
        print(f"{name:24s} {time.time() - start:6.2f}s {outcome or 'ok'}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
