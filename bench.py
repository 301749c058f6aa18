"""Time the query catalogue and two landing workloads; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 2; each time is the best of that many runs),
BENCH_X16=1 adds a 16x lineitem landing on the shuffle path; BENCH_EVENT_LOG=1 writes Spark's
event log to a fresh temp folder and adds executor task seconds per item.
Each catalogue query is evaluated in full through the ``noop`` sink (no
rows to the driver). The landing workloads time ``land_table`` runs on the
largest tables: a full load, an incremental run, and a rerun with nothing new.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.config import TableConfig  # noqa: E402
from tidemark.plans.landing import land_table  # noqa: E402
from tidemark.queries import QUERIES  # noqa: E402
from tidemark.session import local_session, scratch_folder  # noqa: E402

RUN_1 = datetime(2025, 1, 1)
RUN_2 = datetime(2025, 1, 2)
RUN_3 = datetime(2025, 1, 3)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


JOBS: dict[str, list[int]] = {}


def _counted(spark, label, fn):
    """Run ``fn`` and record how many Spark jobs it submitted (public status tracker)."""
    sc = spark.sparkContext
    group = f"{label}-{len(JOBS.get(label, []))}"
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    JOBS.setdefault(label, []).append(len(sc.statusTracker().getJobIdsForGroup(group)))


def land_lineitem(spark, sf_dir):
    """Composite key (with duplicates): first load of older lines, then all, then rerun."""
    li = _table(spark, sf_dir, "lineitem")
    cfg = TableConfig("lineitem", scratch_folder(spark, "bench-lineitem"),
                      "l_orderkey,l_linenumber", "unused", source_format="parquet")
    early = li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    _counted(spark, "land_lineitem", lambda: land_table(spark, cfg, RUN_1, source=early))
    _counted(spark, "land_lineitem", lambda: land_table(spark, cfg, RUN_2, source=li))
    _counted(spark, "land_lineitem", lambda: land_table(spark, cfg, RUN_3, source=li))


def land_documents(spark, sf_dir):
    """Single key over the widest table (long texts): full load, then rerun with nothing new."""
    docs = _table(spark, sf_dir, "documents")
    cfg = TableConfig("documents", scratch_folder(spark, "bench-documents"), "doc_id", "unused",
                      source_format="parquet")
    _counted(spark, "land_documents", lambda: land_table(spark, cfg, RUN_1, source=docs))
    _counted(spark, "land_documents", lambda: land_table(spark, cfg, RUN_2, source=docs))


def land_lineitem_x16(spark, sf_dir):
    """Lineitem replicated 16x under new keys (explode, no join), landed on the shuffle path."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    big = (li.select("*", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("copy"))
           .withColumn("l_orderkey", F.col("l_orderkey") * 16 + F.col("copy")).drop("copy"))
    staged = scratch_folder(spark, "bench-x16-src")
    big.write.parquet(staged)
    src = spark.read.parquet(staged)
    cfg = TableConfig("lineitem_x16", scratch_folder(spark, "bench-x16"), "l_orderkey,l_linenumber",
                      "unused", source_format="parquet", join_strategy="shuffle")
    early = src.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    _counted(spark, "land_lineitem_x16", lambda: land_table(spark, cfg, RUN_1, source=early))
    _counted(spark, "land_lineitem_x16", lambda: land_table(spark, cfg, RUN_2, source=src))
    _counted(spark, "land_lineitem_x16", lambda: land_table(spark, cfg, RUN_3, source=src))


WORKLOADS = {"land_lineitem": land_lineitem, "land_documents": land_documents}
if os.environ.get("BENCH_X16") == "1":
    WORKLOADS["land_lineitem_x16"] = land_lineitem_x16


def _task_seconds(event_dir: str) -> dict[str, float]:
    """Executor run time summed per bench item, from the Spark event log (stage names)."""
    stage_item: dict[int, str] = {}
    totals: dict[str, float] = {}
    files = [os.path.join(base, f) for base, _d, names in os.walk(event_dir) for f in names
             if not f.startswith((".", "appstatus"))]
    for path in files:
        with open(path, encoding="utf-8") as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerStageSubmitted":
                    info = ev["Stage Info"]
                    label = info.get("Stage Name", "")
                    if label.startswith("bench:"):
                        stage_item[info["Stage ID"]] = label[len("bench:"):]
                elif kind == "SparkListenerTaskEnd":
                    item = stage_item.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    if item:
                        totals[item] = totals.get(item, 0.0) + metrics.get("Executor Run Time", 0) / 1000
    return {k: round(v, 2) for k, v in sorted(totals.items())}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    extra = {}
    event_dir = None
    if os.environ.get("BENCH_EVENT_LOG") == "1":
        event_dir = tempfile.mkdtemp(prefix="tidemark-events-")
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir,
                 "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}
    spark = local_session(cpus, **extra)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    # warm-up (JIT, file system caches), not timed
    _table(spark, sf_dir, "orders").write.format("noop").mode("overwrite").save()

    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))

    def best_of(run) -> float:
        best = None
        for _ in range(repeats):
            t0 = time.perf_counter()
            run()
            took = time.perf_counter() - t0
            best = took if best is None else min(best, took)
        return round(best, 3)

    timings = {}
    sc = spark.sparkContext
    for name, fn in QUERIES.items():
        sc.setLocalProperty("callSite.short", f"bench:{name}")
        timings[name] = best_of(
            lambda fn=fn: fn(spark, sf_dir).write.format("noop").mode("overwrite").save())
    for name, fn in WORKLOADS.items():
        sc.setLocalProperty("callSite.short", f"bench:{name}")
        timings[name] = best_of(lambda fn=fn: fn(spark, sf_dir))
        JOBS[name] = JOBS[name][: len(JOBS[name]) // repeats]
    sc.setLocalProperty("callSite.short", None)
    spark.stop()
    total = round(sum(timings.values()), 3)
    task_seconds = _task_seconds(event_dir) if event_dir else None
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": int(cpus), "repeats": repeats,
                      "spark_jobs_per_landing_run": JOBS,
                      **({"task_seconds": task_seconds, "event_log": event_dir} if event_dir else {})}))


if __name__ == "__main__":
    main()
