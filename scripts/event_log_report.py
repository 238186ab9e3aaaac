"""Per-query stage report from a Spark event log (no UI needed).

    BENCH_EVENT_LOG_DIR=file:///scratch/ev python bench.py
    python scripts/event_log_report.py /scratch/ev [query ...]

For every job group (bench tags each query's jobs with its name) it
prints each stage with its task count, the longest and median task time,
input rows and shuffle records read / written. Skew shows up as a
longest task far above the median, or one task reading most of a shuffle.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import statistics
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            data = zstandard.ZstdDecompressor().stream_reader(fh).read()
        return io.StringIO(data.decode()).readlines()
    with open(path) as fh:
        return fh.readlines()


def load(log_dir: str):
    log_dir = log_dir.removeprefix("file://")
    files = sorted(glob.glob(os.path.join(log_dir, "*", "events_*"))) or sorted(
        f for f in glob.glob(os.path.join(log_dir, "*")) if os.path.isfile(f))
    stage_group, stage_name = {}, {}
    tasks = collections.defaultdict(list)
    for path in files:
        for line in _lines(path):
            e = json.loads(line)
            kind = e["Event"]
            if kind == "SparkListenerJobStart":
                group = e.get("Properties", {}).get("spark.jobGroup.id")
                for sid in e["Stage IDs"]:
                    stage_group[sid] = group
            elif kind == "SparkListenerStageSubmitted":
                info = e["Stage Info"]
                stage_name[info["Stage ID"]] = info["Stage Name"]
            elif kind == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                info = e["Task Info"]
                tasks[e["Stage ID"]].append((
                    info["Finish Time"] - info["Launch Time"],
                    m.get("Input Metrics", {}).get("Records Read", 0),
                    m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0),
                    m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0),
                ))
    return stage_group, stage_name, tasks


def main() -> None:
    stage_group, stage_name, tasks = load(sys.argv[1])
    only = set(sys.argv[2:])
    print("| query | stage | tasks | max ms | median ms | input rows | shuffle read (max task / total) | shuffle written |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for sid in sorted(tasks):
        group = stage_group.get(sid)
        if only and group not in only:
            continue
        ts = tasks[sid]
        durs = [t[0] for t in ts]
        reads = [t[2] for t in ts]
        print(f"| {group} | {sid} {stage_name.get(sid, '')[:30]} | {len(ts)} | {max(durs)} | "
              f"{statistics.median(durs):.0f} | {sum(t[1] for t in ts)} | {max(reads)} / {sum(reads)} | "
              f"{sum(t[3] for t in ts)} |")


if __name__ == "__main__":
    main()
