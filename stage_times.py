"""Summarise a Spark event log: time per query and its slowest stages.

usage: python stage_times.py EVENT_LOG [top]

EVENT_LOG is an event log file, a rolling event log folder (Spark 4 writes
eventlog_v2_<app>/events_*), or the folder given as spark.eventLog.dir.

Jobs are attributed to the query named in their job description (bench.py
sets it); stage time is completion minus submission.
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def log_lines(path):
    if os.path.isdir(path):
        files = sorted(glob.glob(os.path.join(path, "events_*")))
        if not files:  # the spark.eventLog.dir folder: take the newest app
            apps = sorted(glob.glob(os.path.join(path, "eventlog_v2_*")), key=os.path.getmtime)
            files = sorted(glob.glob(os.path.join(apps[-1], "events_*")))
        for f in files:
            yield from _open(f)
    else:
        yield from _open(path)


def _open(f):
    if f.endswith((".zstd", ".zst")):
        import io

        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")),
                                encoding="utf-8")
    return open(f, encoding="utf-8")


def main(argv):
    path, top = argv[1], int(argv[2]) if len(argv) > 2 else 3
    stage_query, stages = {}, []
    for line in log_lines(path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            q = (e.get("Properties") or {}).get("spark.job.description", "?")
            for sid in e.get("Stage IDs", []):
                stage_query[sid] = q
        elif ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if info.get("Submission Time") and info.get("Completion Time"):
                stages.append((info["Stage ID"], info["Stage Name"], info["Number of Tasks"],
                               (info["Completion Time"] - info["Submission Time"]) / 1000))
    by_q = defaultdict(list)
    for sid, name, ntasks, sec in stages:
        by_q[stage_query.get(sid, "?")].append((sec, sid, ntasks, name))
    for q, xs in sorted(by_q.items(), key=lambda kv: -sum(x[0] for x in kv[1])):
        print(f"{q}: {len(xs)} stages, {sum(x[0] for x in xs):.2f}s stage time")
        for sec, sid, ntasks, name in sorted(xs, reverse=True)[:top]:
            print(f"    stage {sid:4d} {sec:6.2f}s {ntasks:4d} tasks  {name[:70]}")


if __name__ == "__main__":
    main(sys.argv)
