#!/usr/bin/env python
"""Summarise the physical plan of every registered query (markdown table).

Counts operators in ``explain("formatted")``: shuffles (Exchange),
broadcasts, Python evaluation (ArrowEvalPython), windows, sorts, and the
scans' pruned read schema.  Queries that write data first (sinks, streams)
show the plan of the read-back DataFrame.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from segmint.plans.registry import QUERIES  # noqa: E402
from segmint.session import local_session  # noqa: E402


def summarise(plan: str) -> dict:
    ops = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    return {
        "shuffle": sum(1 for o in ops if o in ("Exchange",)),
        "broadcast": sum(1 for o in ops if o == "BroadcastExchange"),
        "python": sum(1 for o in ops if o in ("ArrowEvalPython", "BatchEvalPython")),
        "window": sum(1 for o in ops if o == "Window"),
        "sort": sum(1 for o in ops if o == "Sort"),
        "scans": sum(1 for o in ops if o in ("Scan", "BatchScan") or o.startswith("Scan")),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(app_name="segmint-plans")
    print("| query | scans | shuffles | broadcasts | python evals | windows | sorts |")
    print("|---|---|---|---|---|---|---|")
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        s = summarise(buf.getvalue())
        print(f"| `{name}` | {s['scans']} | {s['shuffle']} | {s['broadcast']} | {s['python']} "
              f"| {s['window']} | {s['sort']} |")
    spark.stop()


if __name__ == "__main__":
    main()
