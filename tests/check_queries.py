"""python -m tests.check_queries [sf] [name ...]: compare registered queries with their SQL."""

import sys
import time

from __spark_entry__ import oracle_sql, queries
from seqtally.session import build_session
from tests.oracle import compare, connect


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("0") else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", shuffle_partitions=8, **{"spark.ui.enabled": "false",
                                                                      "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    sqls = oracle_sql()
    for name, run in queries().items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sqls:
                problem = compare(df, con, sqls[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s{'' if name in sqls else ' (rows only)'}"
              f"{'' if problem is None else '  ' + problem}", flush=True)
    print(f"{bad} problems")


main()
