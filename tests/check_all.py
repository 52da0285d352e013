"""Run every registered query (or those named) and compare with SQL: ``python -m tests.check_all [names]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tallyforge.session import build_session  # noqa: E402
from tests.compare import connect, difference  # noqa: E402


def main() -> None:
    base = os.environ.get("CHECK_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:]
    spark = build_session("local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(base)
    sql, bad = oracle_sql(), 0
    for name, fn in queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, base)
            if name in sql:
                diff = difference(df, con, sql[name])
                state = "ok" if diff is None else "DIFF " + diff[:700]
            else:
                state = f"rows {len(df.collect())}"
        except Exception as e:  # report and go on
            state = "FAIL " + str(e)[:1200]
            if names:
                traceback.print_exc()
        bad += state.startswith(("DIFF", "FAIL"))
        print(f"{name:32s} {time.time() - start:6.2f}s {state}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
