"""Check queries against DuckDB: python tests/run_oracle.py SF_DIR [name ...]"""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

import __spark_entry__ as entry_points  # noqa: E402
from presswork.session import build_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry_points.queries(), entry_points.oracle_sql()
    bad = 0
    for name in names or queries:
        start, rows = time.time(), ""
        try:
            df = queries[name](spark, sf_dir)
            problem = compare(df, con, oracle[name]) if name in oracle else None
            rows = "" if name in oracle else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or rows}", flush=True)
    print(f"{bad} problems")
    sys.exit(bool(bad))
