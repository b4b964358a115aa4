"""Summarise a Spark event log per job group (bench.py tags each query).

usage: python scripts/eventlog_summary.py <event log file or folder>
Prints, per query: jobs, stages, tasks, summed task run time (s) and
shuffle bytes written.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def files(path):
    if os.path.isdir(path):
        for root, _, names in os.walk(path):
            for n in sorted(names):
                yield os.path.join(root, n)
    else:
        yield path


def lines(path):
    """Event-log lines; Spark compresses logs with zstd by default."""
    if path.endswith(".zstd") or path.endswith(".zst"):
        import io
        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main():
    stage_group, job_group = {}, {}
    acc = defaultdict(lambda: {"jobs": 0, "stages": set(), "tasks": 0, "run_ms": 0, "shuffle_w": 0})
    for f in files(sys.argv[1]):
        if os.path.basename(f).startswith(("appstatus", ".")):
            continue
        for line in lines(f):
            if not line.strip():
                continue
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                g = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
                job_group[ev["Job ID"]] = g
                acc[g]["jobs"] += 1
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = g
            elif kind == "SparkListenerTaskEnd":
                g = stage_group.get(ev.get("Stage ID"), "-")
                m = ev.get("Task Metrics") or {}
                acc[g]["stages"].add(ev.get("Stage ID"))
                acc[g]["tasks"] += 1
                acc[g]["run_ms"] += m.get("Executor Run Time", 0)
                acc[g]["shuffle_w"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    print(f"{'query':32} {'jobs':>5} {'stages':>6} {'tasks':>6} {'task_s':>8} {'shuffle_MB':>10}")
    for g, a in sorted(acc.items(), key=lambda kv: -kv[1]["run_ms"]):
        print(f"{g:32} {a['jobs']:5d} {len(a['stages']):6d} {a['tasks']:6d} {a['run_ms'] / 1000:8.2f} "
              f"{a['shuffle_w'] / 1e6:10.2f}")


if __name__ == "__main__":
    main()
