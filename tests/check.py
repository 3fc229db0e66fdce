"""Compare registered queries by hand: ``python -m tests.check FOLDER [NAME...]``."""

import sys
import time

from tests.compare import compare, connect
from tests.session import make_session

import __spark_entry__ as entry


def main(folder, *names):
    spark, con = make_session(), connect(folder)
    oracles = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in oracles:
                rows = compare(spark, name, build, oracles[name], folder, con)[0]
                note = "ok"
            else:
                rows, note = build(spark, folder).count(), "no oracle"
        except Exception as error:
            bad += 1
            rows, note = "-", f"FAILED {str(error)[:1500]}"
        print(f"{name:28} {rows!s:>8} rows {time.time() - start:6.2f} s  {note}", flush=True)
    print("failed:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
