"""Single-node reference timings: the oracle SQL of the headline queries on DuckDB.

    python tests/oracle_timing.py [sf_dir]   -> one JSON line (median of 3 after a warm-up)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    import bench
    import __spark_entry__ as E
    from oracle_compare import duck
    con = duck(sf_dir)
    con.execute(f"SET threads TO {int(os.environ.get('BENCH_CPUS', '8'))}")
    oracles = E.oracle_sql()
    out = {}
    for name in bench.HEADLINE:
        sql = oracles[name]
        con.execute(sql).fetchall()
        ts = []
        for _ in range(3):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            ts.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(ts), 3)
    print(json.dumps({"engine": "duckdb", "sf_dir": sf_dir, "value": round(sum(out.values()), 3), "queries": out}))


if __name__ == "__main__":
    main()
