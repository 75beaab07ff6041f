"""Per-query stage facts from Spark's event log (no UI involved).

    python tools/stage_report.py [sf_dir]

Runs each headline query once with the event log written to a fresh
scratch folder, then sums per query: jobs, stages, tasks, rows read from
files, rows and bytes written to shuffles, and the longest task.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _acc(info, name):
    for a in info.get("Accumulables", []):
        if a.get("Name") == name:
            return int(a.get("Value") or 0)
    return 0


def summarize(log_dir):
    files = sorted(f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(f))
    job_query, stage_query = {}, {}
    facts = defaultdict(lambda: defaultdict(int))
    for f in files:
        for line in open(f):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                q = (ev.get("Properties") or {}).get("spark.job.description")
                if q:
                    job_query[ev["Job ID"]] = q
                    facts[q]["jobs"] += 1
                    for sid in ev.get("Stage IDs", []):
                        stage_query[sid] = q
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                q = stage_query.get(info["Stage ID"])
                if not q or "Completion Time" not in info:
                    continue
                facts[q]["stages"] += 1
                facts[q]["tasks"] += info.get("Number of Tasks", 0)
                facts[q]["input_rows"] += _acc(info, "internal.metrics.input.recordsRead")
                facts[q]["shuffle_write_bytes"] += _acc(info, "internal.metrics.shuffle.write.bytesWritten")
                facts[q]["shuffle_rows"] += _acc(info, "internal.metrics.shuffle.write.recordsWritten")
            elif kind == "SparkListenerTaskEnd":
                q = stage_query.get(ev.get("Stage ID"))
                if q:
                    ti = ev["Task Info"]
                    facts[q]["max_task_ms"] = max(facts[q]["max_task_ms"],
                                                  ti["Finish Time"] - ti["Launch Time"])
    return facts


if __name__ == "__main__":
    from bench import headline
    from tierline.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tierline-events-")
    spark = get_spark(master="local[8]", shuffle_partitions=16,
                      conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                            "spark.eventLog.compress": "false"})
    for name, build in headline(spark, sf).items():
        spark.sparkContext.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    facts = summarize(log_dir)
    print("| query | jobs | stages | tasks | rows read | rows shuffled | shuffle MB | longest task ms |")
    print("|---|---|---|---|---|---|---|---|")
    for q, f in facts.items():
        print(f"| {q} | {f['jobs']} | {f['stages']} | {f['tasks']} | {f['input_rows']:,} | "
              f"{f['shuffle_rows']:,} | {f['shuffle_write_bytes'] / 1e6:.1f} | {f['max_task_ms']} |")
