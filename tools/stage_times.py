"""Summarise a Spark event log (written with spark.eventLog.enabled to a
scratch folder): wall time, stage count and the slowest stages per job
group (bench.py sets the job group to the query name).

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py <event log file or eventlog_v2 folder> [top_n]
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(f):
    if f.endswith(".zstd"):  # compressed event logs
        import io

        import zstandard
        with open(f, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    job_group, stage_job = {}, {}
    stages = {}
    jobs_of = defaultdict(list)
    files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events")) \
        if os.path.isdir(path) else [path]
    for line in (ln for f in files for ln in _lines(f)):
        if True:
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
                job_group[e["Job ID"]] = g
                jobs_of[g].append((e["Job ID"], e["Submission Time"]))
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = e["Job ID"]
            elif ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                if "Completion Time" in info and "Submission Time" in info:
                    stages[info["Stage ID"]] = (info["Completion Time"] - info["Submission Time"],
                                                info["Stage Name"], info["Number of Tasks"])
    per_group = defaultdict(list)
    for sid, (ms, name, ntasks) in stages.items():
        per_group[job_group.get(stage_job.get(sid), "-")].append((ms, sid, name, ntasks))
    for g, items in sorted(per_group.items(), key=lambda kv: -sum(i[0] for i in kv[1])):
        total = sum(i[0] for i in items)
        print(f"{g:28s} stages={len(items):4d} jobs={len(jobs_of[g]):4d} stage_ms={total}")
        for ms, sid, name, ntasks in sorted(items, reverse=True)[:top]:
            print(f"    {ms:7d} ms  stage {sid:5d}  tasks={ntasks:4d}  {name[:70]}")


if __name__ == "__main__":
    main()
