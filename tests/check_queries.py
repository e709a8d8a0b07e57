"""Command line: compare all (or the named) registered queries with their SQL.

    python tests/check_queries.py [--sf 0.01] [name ...]
"""

import argparse
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[1])]

from compare import compare, connect  # noqa: E402

import __spark_entry__  # noqa: E402


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    arguments = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{arguments.sf}"
    connection = connect(sf_dir)
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    failed = 0
    for name in arguments.names or queries:
        start = time.time()
        try:
            problems = compare(spark, connection, queries[name], sql[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", flush=True)
        for problem in problems:
            print("     ", problem, flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
