"""Command-line parity check: python -m tests.check_all [folder] [name ...]"""

import sys

from tests.parity import compare, connect
from wardstone.plans.catalog import ORACLES, QUERIES
from wardstone.session import build_session

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("parity", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in sys.argv[2:] or QUERIES:
        try:
            if name in ORACLES:
                problems, rows, seconds = compare(spark, con, QUERIES[name], ORACLES[name], folder)
            else:
                import time

                start = time.time()
                rows, problems = QUERIES[name](spark, folder).count(), ["rows only"]
                seconds = time.time() - start
        except Exception as error:  # noqa: BLE001
            problems, rows, seconds = [f"{type(error).__name__}: {str(error)[:600]}"], -1, 0.0
        wrong = problems not in ([], ["rows only"])
        bad += wrong
        print(f"{'BAD' if wrong else 'ok '} {name:28s} rows={rows:<7d} {seconds:6.2f}s {problems or ''}", flush=True)
    print("bad:", bad, "of", len(sys.argv[2:] or QUERIES))
