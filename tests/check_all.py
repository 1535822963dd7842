"""Compare every query with its SQL at one scale: ``python tests/check_all.py [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from compare import compare, connect  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sql = oracle_sql()
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            problem = compare(df, sql[name], connection) if name in sql else None
            note = "" if name in sql else f" rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem, note = f"{type(error).__name__}: {str(error)[:1500]}", ""
            if "-v" in sys.argv:
                traceback.print_exc()
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s{note} {problem or ''}", flush=True)
    print(f"{failed} of {len(names)} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
