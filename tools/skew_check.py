"""Skew experiment: one key holds a third of all rows.

Runs a naive ``Window.partitionBy(key)`` running sum and the blocked scan on a
skewed copy of ``events`` (derived by Spark from the table, nothing is made
up), and reports, per run, the largest and the median shuffle-read records of
a task, read from Spark's event log in a fresh scratch folder.

    python tools/skew_check.py [--sf /root/testdata/sf0.1] [--copies 10]
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def task_records(log_dir: str, job_group: str) -> list[int]:
    """Shuffle records read per task in the largest shuffle-reading stage of
    the jobs tagged with ``job_group``."""
    stages, per_stage = set(), {}
    for path in sorted(glob.glob(f"{log_dir}/**/*", recursive=True)):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == job_group:
                        stages.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerTaskEnd" and ev.get("Stage ID") in stages:
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    n = m.get("Total Records Read", m.get("Local Records Read", 0) + m.get("Remote Records Read", 0))
                    if n:
                        per_stage.setdefault(ev["Stage ID"], []).append(int(n))
    return max(per_stage.values(), key=sum) if per_stage else []


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--copies", type=int, default=10)
    ap.add_argument("--partitions", type=int, default=32)
    a = ap.parse_args()

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tidewater.operators import keyed
    from tidewater.session import build_session

    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session("local[8]", a.partitions, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc = spark.sparkContext
    ev = spark.read.parquet(f"{a.sf}/events.parquet")
    span = ev.agg(F.max("event_id")).first()[0] + 1
    # a third of the rows belong to user 0; copies keep ids unique and ordered
    copies = ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(a.copies - 1))))
    skewed = (copies.select(
        (F.col("copy") * span + F.col("event_id")).alias("event_id"),
        F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
        "value"))

    runs = {
        "naive_window": lambda: skewed.withColumn(
            "running", F.sum("value").over(Window.partitionBy("user_id").orderBy("event_id"))),
        "blocked_scan_64k_ids": lambda: keyed.running_sum(skewed, "user_id", "event_id", "value",
                                                          block_size=1 << 16),
        "blocked_scan_8k_ids": lambda: keyed.running_sum(skewed, "user_id", "event_id", "value",
                                                         block_size=1 << 13),
    }
    total = skewed.count()
    report = {"rows": total, "hot_key_rows": skewed.where("user_id = 0").count(), "runs": {}}
    for name, build in runs.items():
        sc.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    sc.setJobGroup("done", "done")
    spark.stop()
    for name in runs:
        recs = task_records(log_dir, name)
        report["runs"][name] = {"tasks": len(recs), "stage_records": sum(recs),
                                "max_task_records": max(recs),
                                "median_task_records": int(statistics.median(recs))}
    print(json.dumps(report, indent=1))


if __name__ == "__main__":
    main()
