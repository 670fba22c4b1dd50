"""Run queries and their SQL side by side: check_queries.py SF_DIR [name ...]."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parents[1] / "tests")]

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from test_queries import TABLES, table  # noqa: E402

from workload.oracle import SQL  # noqa: E402
from workload.queries import QUERIES  # noqa: E402


def main() -> None:
    sf_dir, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name in names or QUERIES:
        print(name, end=" ", flush=True)
        start = time.time()
        frame = QUERIES[name](spark, sf_dir)
        rows = [tuple(r) for r in frame.collect()]
        print(f"spark {time.time() - start:.1f}s", end=" ", flush=True)
        start = time.time()
        result = con.execute(SQL[name])
        expected = table([c[0] for c in result.description], result.fetchall())
        print(f"sql {time.time() - start:.1f}s", end=" ", flush=True)
        actual = table(frame.columns, rows)
        print("ok" if actual == expected else "DIFFERENT", len(rows), "rows", flush=True)
        if actual != expected:
            print("  missing", list(set(expected[1]) - set(actual[1]))[:2])
            print("  extra  ", list(set(actual[1]) - set(expected[1]))[:2], flush=True)


if __name__ == "__main__":
    main()
