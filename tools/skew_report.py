"""Task balance of the hot-key sequence: plain windows vs the range layout.

usage: python tools/skew_report.py [--sf DIR]

Runs ``ordered`` over lineitem re-keyed so that every 'N' line shares one
key (over a third of the rows), once with plain windows and once through the
range layout, with Spark's event log written to a fresh scratch folder.
Prints, per run, the largest number of shuffle records one task read and
the median over tasks of the stages that read shuffle data.
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


def task_reads(log_dir: str) -> dict[int, list[int]]:
    per_stage: dict[int, list[int]] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if n:
                    per_stage.setdefault(ev["Stage ID"], []).append(n)
    return per_stage


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    a = ap.parse_args()
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from stargrain.operators.ordered import ordered
    from stargrain.plans.catalog import LINE_ID

    for mode in ["plain", "range"]:
        log_dir = tempfile.mkdtemp(prefix=f"skew-{mode}-", dir="/tmp")
        spark = (SparkSession.builder.master("local[8]").appName(f"skew-{mode}")
                 .config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
                 .config("spark.eventLog.dir", log_dir).config("spark.eventLog.compress", "false")
                 .config("spark.sql.shuffle.partitions", "16")
                 .config("spark.sql.adaptive.enabled", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
        li = spark.read.parquet(f"{a.sf}/lineitem.parquet")
        t = li.select(F.when(F.col("l_returnflag") == "N", F.lit(-1)).otherwise(F.col("l_orderkey")).alias("k"),
                      *LINE_ID)
        order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]
        ordered(t, ["k"], order, seq="s", layout=mode).write.format("noop").mode("overwrite").save()
        spark.stop()
        reads = task_reads(log_dir)
        worst = max((max(v), sid) for sid, v in reads.items())
        print(json.dumps({"mode": mode, "stages_with_shuffle_reads": len(reads),
                          "max_task_records": worst[0],
                          "median_task_records_in_that_stage": statistics.median(reads[worst[1]]),
                          "tasks_in_that_stage": len(reads[worst[1]])}))


if __name__ == "__main__":
    main()
