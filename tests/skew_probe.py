"""Skew probe: the bridge join with one title and one person each holding a third of all credits.

Derives a skewed credits table from the driver's lineitem (a third of the rows re-keyed to one order,
another third to one part), builds the bridge three ways and reports, from the Spark event log, the
shuffle records read by the busiest task versus the median task of each join stage.

Usage: python tests/skew_probe.py <scratch_dir> [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from reelmart.operators import marts as M  # noqa: E402
from reelmart.operators.joins import find_hot_keys  # noqa: E402
from reelmart.operators.staging import credit_columns  # noqa: E402
from reelmart.plans.pipeline import build_from_driver_tables  # noqa: E402
from reelmart.session import get_session  # noqa: E402
from reelmart.sources.synthetic import RAW_TITLE_PRINCIPALS_SQL, read_driver_table  # noqa: E402


def main() -> None:
    scratch = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    events = f"{scratch}/events"
    os.makedirs(events, exist_ok=True)
    spark = get_session("local[8]", app_name="skew-probe", shuffle_partitions=32, conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": events, "spark.eventLog.compress": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",  # force shuffle joins, as at full scale
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    wh = build_from_driver_tables(spark, sf_dir, as_of_year=2024)
    titles = wh["dim_titles"]
    li = read_driver_table(spark, sf_dir, "lineitem")
    skewed_li = li.select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(3)).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        F.when(F.col("l_orderkey") % 3 == 1, F.lit(1)).otherwise(F.col("l_partkey")).alias("l_partkey"),
        "l_suppkey", "l_linenumber")
    credits = spark.sql(RAW_TITLE_PRINCIPALS_SQL, lineitem=skewed_li)
    root = f"{scratch}/out"
    variants = {
        "plain_no_aqe_skew": dict(hot_share=None, conf={"spark.sql.adaptive.skewJoin.enabled": "false"}),
        "plain_aqe_skew": dict(hot_share=None, conf={"spark.sql.adaptive.skewJoin.enabled": "true",
                                                    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
                                                    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}),
        "salted": dict(hot_share=1 / 30, conf={"spark.sql.adaptive.skewJoin.enabled": "false"}),
    }
    walls = {}
    for name, v in variants.items():
        for k, val in v["conf"].items():
            spark.conf.set(k, val)
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        hot = find_hot_keys(credit_columns(credits), ["title_id", "person_id"], v["hot_share"]) if v["hot_share"] else None
        M.bridge_cast_crew_from_raw(credits, titles, wh["dim_people"], hot) \
            .write.mode("overwrite").parquet(f"{root}/{name}")
        walls[name] = time.perf_counter() - t0
        n = spark.read.parquet(f"{root}/{name}").count()
        walls[name + "_rows"] = n
    spark.stop()

    # per-stage shuffle records read per task, from the event log
    latest = max(glob.glob(f"{events}/*"), key=os.path.getmtime)
    files = sorted(glob.glob(f"{latest}/*")) if os.path.isdir(latest) else [latest]
    stage_desc, tasks = {}, {}
    for f in files:
        for line in open(f):
            ev = json.loads(line)
            if ev["Event"] == "SparkListenerStageSubmitted":
                props = ev.get("Properties") or {}
                stage_desc[ev["Stage Info"]["Stage ID"]] = props.get("spark.job.description")
            elif ev["Event"] == "SparkListenerTaskEnd":
                m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                recs = m.get("Total Records Read", 0)
                tasks.setdefault(ev["Stage ID"], []).append(recs)
    report = {"wall_seconds": {k: round(v, 2) if isinstance(v, float) else v for k, v in walls.items()},
              "join_stages": []}
    for sid, recs in sorted(tasks.items()):
        if sum(recs) < 100_000:
            continue
        report["join_stages"].append({"variant": stage_desc.get(sid), "stage": sid, "tasks": len(recs),
                                      "max_task_records": max(recs),
                                      "median_task_records": int(statistics.median(recs)),
                                      "total_records": sum(recs)})
    print(json.dumps(report, indent=1))


if __name__ == "__main__":
    main()
