"""Run every query and its SQL over the same tables and compare the rows.

Usage: python tools/check_queries.py [folder] [name ...]
"""

import collections
import datetime
import math
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quirework.queries import all_queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="check-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(names: list[str], data) -> collections.Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(spark, con, run, sql, folder) -> str | None:
    """None when equal, else what differs."""
    df = run(spark, folder)
    got = rows(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = rows(names, cursor.fetchall())
    if not want:
        return "SQL gives no rows"
    if got == want:
        return None
    missing, extra = list((want - got).items())[:2], list((got - want).items())[:2]
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; columns {sorted(names)}\n"
        f"  only in SQL: {missing}\n  only in Spark: {extra}"
    )


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, bad = session(), database(folder), []
    for name, (run, sql) in all_queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, run, sql, folder)
        except Exception as exc:
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        state = "ok" if problem is None else "DIFF"
        print(f"{state:5}{time.time() - start:7.2f}s  {name}", flush=True)
        if problem:
            print("   ", problem[:3000], flush=True)
            bad.append(name)
    print("differing:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
