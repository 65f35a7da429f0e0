"""Summarise physical plans: shuffles, broadcasts, windows, pushed filters.

usage: python tools/plan_report.py [sf_dir] [name ...]
Counts come from ``explain("formatted")`` before execution (AQE may still
turn a shuffle join into a broadcast at runtime).  Bench-grain variants of
the panel queries are included as ``*_grainC``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from unitcast import config  # noqa: E402


def summary(df) -> dict:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    plan = buf.getvalue().split("\n\n(1)")[0]
    return {
        "shuffles": len(re.findall(r"Exchange \(", plan)) - len(re.findall(r"BroadcastExchange \(", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange \(", plan)),
        "windows": len(re.findall(r"\bWindow \(", plan)),
        "scans": len(re.findall(r"Scan (parquet|ExistingRDD)", plan)),
        "pushed": "PushedFilters: [" in buf.getvalue() and not "PushedFilters: []" in buf.getvalue(),
    }


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    names = [a for a in args if not os.path.isdir(a)]
    spark = config.local_session(8, 16)
    import bench
    qs = dict(bench.HEADLINE)
    print("| query | shuffles | broadcasts | windows | scans |")
    print("| --- | --- | --- | --- | --- |")
    for name in names or list(qs):
        s = summary(qs[name](spark, sf_dir))
        print(f"| `{name}` | {s['shuffles']} | {s['broadcasts']} | {s['windows']} | {s['scans']} |")
    spark.stop()


if __name__ == "__main__":
    main()
