"""CLI: run every registered query against its oracle at one scale."""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from meterlake.config import build_session  # noqa: E402
from tests.oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                res = compare(df, con, sqls[name])
            else:
                res = {"rows": df.count(), "ok": None}
        except Exception as exc:  # report and continue
            res = {"ok": False, "error": repr(exc)[:500]}
        res["sec"] = round(time.time() - t, 2)
        bad += res.get("ok") is False
        print(name, json.dumps(res, default=str), flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
