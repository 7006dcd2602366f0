"""Per-stage task counts and durations of catalog queries, from Spark's event log.

Usage: python tools/stage_times.py SF_DIR QUERY [QUERY ...]
Runs each query (into the ``noop`` sink) twice with the event log written to a
new scratch folder, then prints every job of the second run: its stages, task
counts and milliseconds. No UI or REST server is involved.
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile

import zstandard

sys.path.insert(0, ".")

from tokentally.plans.catalog import QUERIES  # noqa: E402
from tokentally.session import local_session  # noqa: E402


def events(log_dir: str):
    for path in sorted(glob.glob(f"{log_dir}/**/events_*", recursive=True)):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = local_session(8, **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    spark.sparkContext.setLogLevel("ERROR")
    marks = {}
    for name in names:
        for attempt in range(2):
            spark.sparkContext.setJobGroup(f"{name}#{attempt}", name)
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        marks[name] = f"{name}#1"
    spark.stop()
    stages, jobs = {}, []
    for e in events(log_dir):
        if e["Event"] == "SparkListenerStageCompleted":
            s = e["Stage Info"]
            stages[s["Stage ID"]] = (s["Number of Tasks"], s["Completion Time"] - s["Submission Time"])
        elif e["Event"] == "SparkListenerJobStart":
            group = e.get("Properties", {}).get("spark.jobGroup.id")
            jobs.append((group, e["Job ID"], e["Stage IDs"], e["Submission Time"]))
        elif e["Event"] == "SparkListenerJobEnd":
            for i, j in enumerate(jobs):
                if j[1] == e["Job ID"]:
                    jobs[i] = j + (e["Completion Time"] - j[3],)
    for name, mark in marks.items():
        print(name)
        for group, job_id, stage_ids, _, *ms in jobs:
            if group != mark:
                continue
            done = [(sid, *stages[sid]) for sid in stage_ids if sid in stages]
            text = ", ".join(f"stage {sid}: {n} tasks {t} ms" for sid, n, t in done)
            print(f"  job {job_id} ({ms[0] if ms else '?'} ms): {text}")


if __name__ == "__main__":
    main()
