"""Run all queries against the oracle: python tests/check_all.py [folder] [name prefix ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import duck, mismatch  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as e  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = duck(sf_dir), e.oracle_sql(), 0
    for name, query in e.queries().items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                problem = mismatch(df, con, oracle[name])
            else:
                df.collect()
                problem = None
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:36s} {time.time() - start:6.2f}s "
              f"{'' if name in oracle else '(rows only) '}{problem or ''}", flush=True)
    print(f"{failed} failed")
    sys.exit(bool(failed))
