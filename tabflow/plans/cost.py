"""What a DataFrame's scans read when it runs: bytes, rows out of the file format
(after whole partitions and row groups are skipped, before the row filter) and tasks."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class ScanCost:
    bytes_read: int
    rows_read: int
    tasks: int


# Parquet's vectored reads run on threads of their own, whose bytes no task counts
COUNTED_READS = {"parquet.hadoop.vectored.io.enabled": "false"}


def scan_cost(df: DataFrame, wait: float = 30.0) -> ScanCost:
    """Run ``df`` without keeping a row and sum the input metrics of its stages.

    All rows are computed, none reach the driver. Read Parquet with the options
    ``COUNTED_READS``, or local bytes are short. Spark offers these sums in no public call, so
    the one internal handle is its status store (classic sessions only; no web page). The store
    is filled by events, so a finished stage is waited for up to ``wait`` seconds."""
    sc = df.sparkSession.sparkContext
    group = f"scan-cost-{uuid.uuid4().hex}"
    before = {k: sc.getLocalProperty(k) for k in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")}
    sc.setJobGroup(group, "scan cost")
    try:
        df.write.format("noop").mode("overwrite").save()
    finally:
        for key, value in before.items():
            sc.setLocalProperty(key, value)
    tracker, store, end = sc.statusTracker(), sc._jsc.sc().statusStore(), time.monotonic() + wait
    cost = [0, 0, 0]
    for job in tracker.getJobIdsForGroup(group):
        while tracker.getJobInfo(job).status == "RUNNING" and time.monotonic() < end:
            time.sleep(0.05)
        for stage in tracker.getJobInfo(job).stageIds:
            data = store.lastStageAttempt(stage)
            while data.status().toString() in ("ACTIVE", "PENDING") and time.monotonic() < end:
                time.sleep(0.05)
                data = store.lastStageAttempt(stage)
            if data.status().toString() == "SKIPPED":  # its shuffle files were there already
                continue
            for i, n in enumerate((data.inputBytes(), data.inputRecords(), data.numTasks())):
                cost[i] += n
    return ScanCost(*cost)
