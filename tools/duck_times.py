"""Time the DuckDB twins of the bench queries on the same files (median of 3)."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import bench  # noqa: E402
from quarry.plans import ORACLE  # noqa: E402
from quarry.sources.files import TEST_TABLES  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    out = {}
    for name in bench.HEADLINE:
        if name not in ORACLE:
            continue
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            con.execute(ORACLE[name]).fetchall()
            runs.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(runs), 4)
    print(json.dumps({"duckdb": out, "total": round(sum(out.values()), 3)}))


if __name__ == "__main__":
    main()
