"""Mergeable partial results of the dashboard: records, score sums and newest score of each hour, score band and label.

Any threshold from 3 to 15 is then answered from the sums of the bands above it and, if it lies inside a band, the rows of
that one band; a slice that begins inside an hour reads that hour's rows. Each run adds its part once, by its id. Bands are
``STEP`` wide and hold their upper end, so a threshold at an end reads no rows.
"""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import config as C
from vigil.operators import serve
from vigil.sources.commit import commit_once

STEP = 0.5                                  # a power of two: products with 1 / STEP are exact
LOW, HIGH = 3.0, 15.0                       # thresholds that can be asked for
BOTTOM, TOP = round(LOW / STEP), round(HIGH / STEP) + 1
PARTS, ROWS = "parts", "rows"


def band(score: Column) -> Column:
    """Band b holds the scores above (b - 1) * STEP up to b * STEP; the lowest and the highest are open. NaN is above all,
    as it is for Spark; a null score has no band."""
    b = F.least(F.greatest(F.ceil(score / F.lit(STEP)), F.lit(BOTTOM)), F.lit(TOP))
    return F.when(F.isnan(score), F.lit(TOP)).otherwise(b).cast("int")


def add_partials(predictions: DataFrame, path: str, run_id: str) -> None:
    """Add a run's partial results and its rows by band, each once."""
    spark = predictions.sparkSession
    rows = predictions.select("source_timestamp", "anomaly_score", "fault_hint", F.date_trunc("hour", "source_timestamp").alias("hour"),
                              band(F.col("anomaly_score")).alias("band"))
    newest = F.when(F.col("source_timestamp").isNotNull(), F.struct("source_timestamp", "anomaly_score"))
    sums = rows.groupBy("hour", "band", "fault_hint").agg(
        F.count(F.lit(1)).alias("records"), F.count("anomaly_score").alias("scored"), F.sum("anomaly_score").alias("score_sum"),
        F.max(newest).alias("newest"))
    commit_once(spark, f"{path}/{ROWS}", run_id, lambda folder: rows.hint("rebalance", F.col("band")).write.mode("overwrite").partitionBy("band").parquet(folder))
    commit_once(spark, f"{path}/{PARTS}", run_id, lambda folder: sums.write.mode("overwrite").parquet(folder))


def _pieces(spark: SparkSession, path: str, threshold: float, hours: int | None) -> DataFrame:
    """``(fault_hint, records, above, scored, score_sum, newest)`` to be added up."""
    if not LOW <= threshold <= HIGH:
        raise ValueError(f"threshold must be within {LOW} .. {HIGH}")
    parts, rows = spark.read.parquet(f"{path}/{PARTS}"), spark.read.parquet(f"{path}/{ROWS}")
    rows = rows.join(parts.select("run").distinct(), "run", "left_semi")        # a run counts when its sums are there
    edge = math.ceil(threshold / STEP)
    over = F.col("anomaly_score") > F.lit(float(threshold))
    none, zero, kind = F.lit(None).cast(parts.schema["newest"].dataType), F.lit(0).cast("long"), parts.schema["hour"].dataType
    edges = None
    if hours is not None:
        if hours not in C.RECENT_HOURS:
            raise ValueError(f"hours must be one of {C.RECENT_HOURS}")
        last = parts.agg(F.max("newest.source_timestamp")).first()[0]
        if last is None:
            parts, rows = parts.where(F.lit(False)), rows.where(F.lit(False))
        else:
            start = last - timedelta(hours=hours)
            first = F.lit(start.replace(minute=0, second=0, microsecond=0)).cast(kind)
            edges = rows.where((F.col("hour") == first) & (F.col("source_timestamp") >= F.lit(start).cast(kind)))
            parts, rows = parts.where(F.col("hour") > first), rows.where(F.col("hour") > first)
    out = parts.select("fault_hint", "records", F.when(F.col("band") > edge, F.col("records")).otherwise(zero).alias("above"),
                       "scored", "score_sum", "newest")
    if threshold / STEP != edge:
        out = out.unionByName(rows.where((F.col("band") == edge) & over).select(
            "fault_hint", zero.alias("records"), F.lit(1).cast("long").alias("above"), zero.alias("scored"), F.lit(0.0).alias("score_sum"), none.alias("newest")))
    if edges is not None:
        out = out.unionByName(edges.select(
            "fault_hint", F.lit(1).cast("long").alias("records"), F.coalesce(over, F.lit(False)).cast("long").alias("above"),
            F.col("anomaly_score").isNotNull().cast("long").alias("scored"), F.col("anomaly_score").alias("score_sum"),
            F.struct("source_timestamp", "anomaly_score").alias("newest")))
    return out


def dashboard_kpis(spark: SparkSession, path: str, threshold: float = C.DASHBOARD_THRESHOLD, hours: int | None = None) -> DataFrame:
    """``serve.dashboard_kpis`` of all rows, or of the last ``hours`` up to the newest one."""
    total = _pieces(spark, path, threshold, hours).agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"), F.coalesce(F.sum("above"), F.lit(0)).alias("anomalies"),
        F.try_divide(F.sum("score_sum"), F.sum("scored").cast("double")).alias("avg_score"),
        F.max("newest").getField("anomaly_score").alias("latest_score"))
    return serve.kpi_row(total, threshold)


def fault_distribution(spark: SparkSession, path: str, threshold: float = C.DASHBOARD_THRESHOLD, hours: int | None = None) -> DataFrame:
    """``serve.fault_distribution`` of all rows, or of the last ``hours``."""
    counts = _pieces(spark, path, threshold, hours).groupBy("fault_hint").agg(F.sum("above").alias("count"))
    return counts.where("count > 0").orderBy(F.desc("count"), "fault_hint")
