"""Time the oracle SQL (the published method written for DuckDB) on a single node.

    python tools/duckdb_baseline.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from bench import HEADLINE  # noqa: E402
from headway.plans.oracle import ORACLE  # noqa: E402
from tools.oracle_check import TABLES  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    names = [a for a in args if not os.path.isdir(a)] or HEADLINE
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    timings = {}
    for name in names:
        t0 = time.perf_counter()
        con.execute(ORACLE[name]).fetchall()
        timings[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"engine": f"duckdb {duckdb.__version__}", "threads": con.execute("select current_setting('threads')").fetchone()[0],
                      "value": round(sum(timings.values()), 3), "queries": timings, "sf_dir": sf_dir}))


if __name__ == "__main__":
    main()
