"""Per-stage task-time spread from a Spark event log (skew check).

Usage: python tests/stage_profile.py <event-log-file> [top]
Prints, for the slowest stages, task count, median and max executor run time
and the max/median ratio; one task far above the median is a hot key.
"""

import io
import json
import os
import statistics
import sys
from collections import defaultdict


def _lines(path: str):
    """Event lines from a log file or a rolling (v2) log folder, zstd or plain."""
    files = [os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")] \
        if os.path.isdir(path) else [path]
    for fp in files:
        if fp.endswith(".zstd"):
            import zstandard
            with open(fp, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def main(path: str, top: int = 12) -> None:
    tasks = defaultdict(list)
    names = {}
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerTaskEnd" and ev.get("Task Metrics"):
                tasks[ev["Stage ID"]].append(ev["Task Metrics"]["Executor Run Time"])
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                names[info["Stage ID"]] = info["Stage Name"][:60]
    rows = []
    for sid, times in tasks.items():
        med = statistics.median(times)
        rows.append((sum(times), sid, len(times), med, max(times), max(times) / med if med else float("inf")))
    for total, sid, n, med, mx, ratio in sorted(rows, reverse=True)[:top]:
        print(f"stage {sid:4d} tasks {n:4d} median {med:7.0f} ms  max {mx:7.0f} ms  max/med {ratio:6.1f}  {names.get(sid, '')}")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 12)
