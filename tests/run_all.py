"""Check all registered queries, or those named, against SQL: ``python tests/run_all.py DIR [query ...]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rtdw.session import build_session  # noqa: E402
from tests.compare import differences  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracles:
                problem = differences(spark, sf_dir, queries[name], oracles[name])
            else:
                problem = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
