"""Summarise a Spark event log: wall time per job and the slowest stages.

usage: python tools/stage_times.py <event-log-file> [top]
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path):
    """Event lines from a log file or a v2 log folder (rolling, maybe zstd)."""
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")]
             if os.path.isdir(path) else [path])
    for name in files:
        if name.endswith(".zstd"):
            import zstandard
            with open(name, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                yield from text
        else:
            with open(name) as f:
                yield from f


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, jobs = {}, {}
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            dur = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
            stages[info["Stage ID"]] = (dur, info["Stage Name"][:60], info["Number of Tasks"])
        elif kind == "SparkListenerJobStart":
            jobs[ev["Job ID"]] = [ev["Submission Time"], None]
        elif kind == "SparkListenerJobEnd" and ev["Job ID"] in jobs:
            jobs[ev["Job ID"]][1] = ev["Completion Time"]
    print(f"jobs: {len(jobs)}  stages: {len(stages)}  "
          f"total stage ms: {sum(d for d, _, _ in stages.values())}")
    for sid, (dur, name, tasks) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:5d} {dur:7d} ms  tasks={tasks:5d}  {name}")


if __name__ == "__main__":
    main()
