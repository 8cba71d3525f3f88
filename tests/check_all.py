"""Run registered queries against their SQL equivalents: python tests/check_all.py [folder] [name part ...]"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[1])]

import oracle  # noqa: E402
from starfold.session import build_session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    from __spark_entry__ import oracle_sql, queries

    con, sqls, failed = oracle.connect(folder), oracle_sql(), 0
    for name, build in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        started = time.time()
        try:
            df = build(spark, folder)
            if name in sqls:
                problem = oracle.difference(df, con, sqls[name])
                rows = ""
            else:
                problem, rows = None, f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {rows}{problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
