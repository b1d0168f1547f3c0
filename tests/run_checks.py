"""Run every registered query (or those whose name contains an argument) against its SQL.

python -m tests.run_checks /root/testdata/sf0.01 [part-of-name ...]
"""

import sys
import time

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from tests.checking import connect, difference


def main() -> int:
    sf_dir, parts = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        begun = time.time()
        try:
            df = run(spark, sf_dir)
            note = difference(df, con, oracles[name]) if name in oracles else None
            ok = note is None
            note = note or f"{df.count()} rows{'' if name in oracles else ', no SQL'}"
        except Exception as problem:
            ok, note = False, f"{type(problem).__name__}: {str(problem)[:700]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - begun:.1f}s {note or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
