#!/usr/bin/env python
"""Compare every registered query with its DuckDB oracle at any scale.

    python tools/oracle_check.py /root/testdata/sf0.1 [query ...]

Prints one JSON line per query (status ``match``, ``rows-only`` or a
mismatch with the first differing rows) and a summary line; exits 1 on any
mismatch or error.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from segmint.plans.compare import compare  # noqa: E402
from segmint.plans.registry import ORACLE, QUERIES  # noqa: E402
from segmint.session import local_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(QUERIES)
    spark = local_session(app_name="segmint-oracle")
    bad = []
    for name in names:
        t0 = time.time()
        try:
            res = compare(spark, name, sf_dir, QUERIES, ORACLE)
        except Exception as e:  # report and go on with the next query
            res = {"query": name, "status": "error", "error": str(e)[:500]}
        res["sec"] = round(time.time() - t0, 2)
        print(json.dumps(res, default=str), flush=True)
        if res["status"] not in ("match", "rows-only"):
            bad.append(name)
    print(json.dumps({"sf_dir": sf_dir, "checked": len(names), "problems": bad}))
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
