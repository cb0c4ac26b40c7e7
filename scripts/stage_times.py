"""Summarize a Spark event log: wall time, stages, tasks and task time per job group.

usage: python scripts/stage_times.py EVENT_LOG_FILE_OR_FOLDER [top_n]
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """An event log file, or a rolling event-log folder (Spark 4 ``eventlog_v2_*``)."""
    files = [path]
    if os.path.isdir(path):
        files = sorted((os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_")),
                       key=lambda f: int(f.rsplit("/", 1)[-1].split("_")[1]))
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard
            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f) as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 25
    job_desc, stage_job = {}, {}
    per = defaultdict(lambda: {"stages": 0, "tasks": 0, "task_ms": 0, "stage_ms": 0})
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                props = ev.get("Properties") or {}
                desc = props.get("spark.job.description") or props.get("spark.jobGroup.id") or "?"
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = desc
                job_desc[ev["Job ID"]] = desc
            elif kind == "SparkListenerTaskEnd":
                info = ev.get("Task Info", {})
                d = stage_job.get(ev.get("Stage ID"), "?")
                per[d]["tasks"] += 1
                per[d]["task_ms"] += info.get("Finish Time", 0) - info.get("Launch Time", 0)
            elif kind == "SparkListenerStageCompleted":
                si = ev.get("Stage Info", {})
                d = stage_job.get(si.get("Stage ID"), "?")
                per[d]["stages"] += 1
                per[d]["stage_ms"] += (si.get("Completion Time", 0) or 0) - (si.get("Submission Time", 0) or 0)
    rows = sorted(per.items(), key=lambda kv: -kv[1]["stage_ms"])[:top]
    print(f"{'job':40s} {'stages':>6s} {'tasks':>6s} {'stage s':>8s} {'task s':>8s}")
    for desc, v in rows:
        print(f"{desc[:40]:40s} {v['stages']:6d} {v['tasks']:6d} {v['stage_ms'] / 1000:8.2f} {v['task_ms'] / 1000:8.2f}")


if __name__ == "__main__":
    main()
