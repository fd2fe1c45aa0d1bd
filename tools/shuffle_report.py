"""Per-query input and shuffle volumes from Spark's event log.

Usage: python tools/shuffle_report.py [sf_dir] [scratch_dir]
Runs every registered query once (noop sink) with the event log written to a scratch
folder (a new ``mktemp``-style folder under /tmp by default), then sums the task metrics of
each query's stages: bytes read from files, shuffle bytes written, records, tasks.
Prints a Markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from candleframe.plans.queries import queries as candle_queries  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    scratch = argv[2] if len(argv) > 2 else tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("candleframe-shuffle-report")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", scratch)
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs = candle_queries()
    for key in sorted(qs):
        spark.sparkContext.setJobDescription(key)
        qs[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_key: dict[int, str] = {}
    acc = defaultdict(lambda: defaultdict(int))
    paths = sorted(
        p for p in glob.glob(os.path.join(scratch, "**", "events_*"), recursive=True) if os.path.isfile(p)
    )
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerStageSubmitted":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    if desc:
                        stage_key[ev["Stage Info"]["Stage ID"]] = desc
                elif kind == "SparkListenerTaskEnd":
                    key = stage_key.get(ev["Stage ID"])
                    m = ev.get("Task Metrics") or {}
                    if not key or not m:
                        continue
                    a = acc[key]
                    a["tasks"] += 1
                    a["input_bytes"] += m.get("Input Metrics", {}).get("Bytes Read", 0)
                    a["input_records"] += m.get("Input Metrics", {}).get("Records Read", 0)
                    w = m.get("Shuffle Write Metrics", {})
                    a["shuffle_bytes"] += w.get("Shuffle Bytes Written", 0)
                    a["shuffle_records"] += w.get("Shuffle Records Written", 0)
    print(f"# Input and shuffle volume per query ({sf_dir}, local[8], AQE on)\n")
    print("Summed task metrics of each query's stages (event log). Checkpointed summaries are read")
    print("as RDD scans, so their bytes do not appear under input.\n")
    print("| key | tasks | input MB | input records | shuffle MB | shuffle records | shuffle / input records |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for key in sorted(acc):
        a = acc[key]
        ratio = a["shuffle_records"] / a["input_records"] if a["input_records"] else 0.0
        print(
            f"| `{key}` | {a['tasks']} | {a['input_bytes'] / 2**20:.2f} | {a['input_records']} | "
            f"{a['shuffle_bytes'] / 2**20:.2f} | {a['shuffle_records']} | {ratio:.2f} |"
        )


if __name__ == "__main__":
    main(sys.argv)
