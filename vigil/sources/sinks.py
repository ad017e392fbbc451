"""Sinks: predictions and run log (once per run id), evaluation report."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import config as C
from vigil.sources.commit import commit_once, replace_version
from vigil.sources.zones import refresh_zones

#: Formats whose tables are folders; others (connectors) get plain appends, and a unique key on the run id is theirs to keep.
FOLDER_FORMATS = {"parquet", "orc", "json", "csv", "avro"}


def append_predictions(preds: DataFrame, path: str, fmt: str = "parquet", run_id: str | None = None) -> bool:
    """Append the predictions of a run, laid out by processing date and reading date: alert reads prune by the one, time
    slices by the other. They appear at once when all are written, and once for a ``run_id`` (None: a run of its own):
    False if it has its predictions already."""
    out = preds.withColumns({"processed_date": F.to_date("processed_at"), "date": F.to_date("source_timestamp")})

    def write(folder: str, mode: str = "overwrite") -> None:
        out.write.format(fmt).mode(mode).partitionBy("processed_date", "date").save(folder)

    if fmt in FOLDER_FORMATS:
        done = commit_once(preds.sparkSession, path, run_id or uuid.uuid4().hex, write)
        if done and fmt == "parquet":
            refresh_zones(preds.sparkSession, path, "source_timestamp")
        return done
    write(path, "append")
    return True


def append_run_log(spark: SparkSession, path: str, run_id: str, records: int, anomalies: int, threshold: float,
                   cached: bool, split: str, processed_at: datetime | None = None, fmt: str = "parquet") -> bool:
    """One audit row per run, keyed by ``spark_run_id``: False if the run has its row already."""
    at = processed_at or datetime.now(timezone.utc)
    row = spark.createDataFrame([(run_id, at, int(records), int(anomalies), float(threshold), bool(cached), split)], C.RUN_LOG_SCHEMA).coalesce(1)
    if fmt in FOLDER_FORMATS:
        return commit_once(spark, path, run_id, lambda folder: row.write.format(fmt).mode("overwrite").save(folder))
    row.write.format(fmt).mode("append").save(path)
    return True


def save_report(report: DataFrame, path: str) -> None:
    """The tidy evaluation report as JSON lines (a handful of rows, one file); a report that can't be written leaves the old one."""
    replace_version(report.sparkSession, path, lambda folder: report.coalesce(1).write.mode("overwrite").json(folder))
