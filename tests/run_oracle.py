"""All queries against their SQL, with times: python -m tests.run_oracle [folder] [name ...]"""

import sys
import time

from __spark_entry__ import oracle_sql, queries
from stopclock.session import build_session
from tests.oracle import connect, difference


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__sql__streaming__stateStore__providerClass=(
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), oracle_sql()
    failed = []
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sql:
                exact = difference(df, con, sql[name], exact=True) or ""
                wrong = exact and difference(df, con, sql[name])
                exact = wrong or (f"(float noise: {exact[:80]})" if exact else "")
            else:
                wrong, exact = None, f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            wrong = exact = f"{type(e).__name__}: {str(e)[:600]}"
        if wrong:
            failed.append(name)
        print(f"{'FAIL' if wrong else 'ok  '} {time.time() - start:6.2f}s {name} {exact}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
