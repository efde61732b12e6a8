"""Run registered queries against their SQL: python -m tests.check FOLDER [NAME ...]"""

from __future__ import annotations

import sys
import time

from stackweave import session
from stackweave.plans import catalog, checks
from tests import compare


def main(folder: str, *names: str) -> int:
    spark = session.local_session(8)
    con = compare.connect(folder)
    bad = 0
    for name in names or catalog.QUERIES:
        start = time.time()
        try:
            df = catalog.QUERIES[name](spark, folder)
            sql = checks.STATEMENTS.get(name)
            if sql is None:
                result = f"rows only: {df.count()}"
            else:
                result = compare.difference(df, con, sql) or "equal"
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += result != "equal" and not result.startswith("rows only")
        print(f"{name:28} {time.time() - start:6.1f}s  {result}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
