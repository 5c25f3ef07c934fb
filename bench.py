"""Time every query once at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query's rows are produced in full and dropped (`noop` sink). A first untimed
query at the smallest scale starts the JVM and the Python workers. Names given as
arguments select queries.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quirework.queries import all_queries  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SMALL = "/root/testdata/sf0.001"


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {n: run for n, (run, _) in all_queries().items()}
    wanted = sys.argv[1:] or list(queries)
    for name in ("chat_examples", "parser_hook"):
        queries[name](spark, SMALL).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    # Throughput of the two text jobs, in documents per second.
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    rates = {
        f"{n}_docs_per_sec": round(documents / seconds[n])
        for n in ("clean_text", "segmented_blocks")
        if n in seconds
    }
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                **rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
