"""Run every query against its SQL: ``python tests/check_oracles.py [sf_dir] [query ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import difference, duck

import __spark_entry__ as contract
from trigramma.session import local_session


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.oracle_sql())
    shared = tempfile.mkdtemp(prefix="oracles-")
    spark = local_session("oracles", **{"spark.checkpoint.dir": f"file://{shared}"})
    connection, sql, bad = duck(sf_dir), contract.oracle_sql(), 0
    for name in names:
        start = time.perf_counter()
        result = contract.queries()[name](spark, sf_dir).toPandas()
        spent = time.perf_counter() - start
        problem = difference(result, connection.execute(sql[name]).df())
        bad += problem is not None
        print(f"{name:28} {spent:6.2f} s {len(result):8} rows  {problem or 'same'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
