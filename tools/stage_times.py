"""Per-query stage times from a Spark event log (no UI needed).

usage: BENCH_EVENTLOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
       python tools/stage_times.py <event log dir or file> [top_n]
Jobs are grouped by their description (bench.py sets it to the query name).
"""

from __future__ import annotations

import collections
import glob
import json
import os
import sys


def read_lines(path):
    """Event log lines; Spark 4 compresses logs with zstd by default."""
    if path.endswith(".zstd"):
        import io
        import zstandard
        with open(path, "rb") as fh:
            data = zstandard.ZstdDecompressor().stream_reader(fh).read()
        return io.StringIO(data.decode("utf-8"))
    return open(path, encoding="utf-8")


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    files = [path] if os.path.isfile(path) else sorted(
        f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(f))
    stage_query, stage_info = {}, {}
    for f in files:
        for line in read_lines(f):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description", "?")
                    for sid in ev.get("Stage IDs", []):
                        stage_query[sid] = desc
                elif kind == "SparkListenerStageCompleted":
                    si = ev["Stage Info"]
                    if "Completion Time" in si and "Submission Time" in si:
                        stage_info[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"],
                                                      si["Stage Name"], si["Number of Tasks"])
    per = collections.defaultdict(list)
    for sid, (ms, name, tasks) in stage_info.items():
        per[stage_query.get(sid, "?")].append((ms, sid, name, tasks))
    for q, stages in per.items():
        total = sum(s[0] for s in stages) / 1000
        print(f"{q}: {len(stages)} stages, {total:.1f} s summed stage time")
        for ms, sid, name, tasks in sorted(stages, reverse=True)[:top]:
            print(f"    stage {sid:4d} {ms / 1000:6.2f} s  {tasks:4d} tasks  {name[:70]}")


if __name__ == "__main__":
    main()
