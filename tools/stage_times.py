"""Summarise a Spark event log per job description (e.g. per bench query):
jobs, stages, tasks, executor run time, shuffle bytes and wall time.

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py $BENCH_EVENT_LOG
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def _open(path: str):
    """Plain or zstd-compressed event log file as text lines."""
    if path.endswith(".zstd"):
        import io

        import zstandard
        raw = open(path, "rb")
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    return open(path, encoding="utf-8")


def summarise(path: str) -> dict:
    files = [path] if os.path.isfile(path) else sorted(
        f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True)
        if os.path.isfile(f) and not f.endswith((".inprogress.crc", ".crc")) and "appstatus" not in f)
    job_desc, stage_job = {}, {}
    out = defaultdict(lambda: defaultdict(float))
    for f in files:
        with _open(f) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description", "(none)")
                    job_desc[ev["Job ID"]] = desc
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                    out[desc]["jobs"] += 1
                    out[desc]["_start"] = min(out[desc].get("_start", ev["Submission Time"]), ev["Submission Time"])
                elif kind == "SparkListenerJobEnd":
                    desc = job_desc.get(ev["Job ID"], "(none)")
                    out[desc]["_end"] = max(out[desc].get("_end", 0), ev["Completion Time"])
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    desc = job_desc.get(stage_job.get(info["Stage ID"]), "(none)")
                    q = out[desc]
                    q["stages"] += 1
                    q["tasks"] += info.get("Number of Tasks", 0)
                    for acc in info.get("Accumulables", []):
                        name, value = acc.get("Name", ""), acc.get("Value", 0)
                        if name == "internal.metrics.executorRunTime":
                            q["executor_ms"] += float(value)
                        elif name == "internal.metrics.shuffle.write.bytesWritten":
                            q["shuffle_write_bytes"] += float(value)
                        elif name == "internal.metrics.shuffle.read.remoteBytesRead" or \
                                name == "internal.metrics.shuffle.read.localBytesRead":
                            q["shuffle_read_bytes"] += float(value)
    result = {}
    for desc, q in out.items():
        wall = (q.pop("_end", 0) - q.pop("_start", 0)) if "_end" in q else 0
        result[desc] = {k: int(v) for k, v in q.items()} | {"wall_ms": int(wall)}
    return result


if __name__ == "__main__":
    for desc, stats in sorted(summarise(sys.argv[1]).items()):
        print(f"{desc:40s} {json.dumps(stats)}")
