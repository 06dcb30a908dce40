"""Print rows, seconds and the SQL comparison of every registered query.

python tests/report.py SF_DIR [name ..]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from oracle_check import connect, difference  # noqa: E402
from workload.oracle import ORACLE  # noqa: E402
from workload.queries import QUERIES  # noqa: E402


def main(sf_dir, names):
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    for name in names or QUERIES:
        start = time.time()
        df = QUERIES[name](spark, sf_dir)
        rows = df.count()
        took = time.time() - start
        checked = difference(df, db, ORACLE[name]) if name in ORACLE else "no SQL"
        print(f"{name:28} {rows:9} rows {took:6.2f} s  {checked or 'equal'}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
