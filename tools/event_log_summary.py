"""Jobs and slowest stages from a Spark event log folder (plain or zstd-compressed).

Usage: BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py fact_star
       python tools/event_log_summary.py $BENCH_EVENT_LOG_DIR [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb")).read()
    return raw.decode().splitlines()


def summarise(folder: str, top: int = 15) -> None:
    files = sorted(p for p in glob.glob(os.path.join(folder, "**", "*"), recursive=True)
                   if os.path.isfile(p) and ("events_" in os.path.basename(p) or p.endswith(".inprogress")
                                             or os.path.basename(p).startswith("local-")))
    jobs, stages = {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None, len(e["Stage Infos"])]
            elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                          si["Number of Tasks"], si["Stage Name"][:70])
    busy = sum((end or start) - start for start, end, _ in jobs.values()) / 1000
    print(f"jobs: {len(jobs)}, stages: {len(stages)}, summed job time: {busy:.1f} s")
    print("slowest stages (ms, tasks, name):")
    for sid, (ms, tasks, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"  {sid:5d} {ms:8d} {tasks:6d}  {name}")


if __name__ == "__main__":
    summarise(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)
