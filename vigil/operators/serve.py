"""Serving queries over the sensor and prediction tables.

Time filters compare real timestamps against an ``as_of`` column (a literal or
a scalar subquery), never the wall clock inside an operator. "Newest N" first
finds a time bound from bucket counts, so the final top-k merge sees about N
rows plus one boundary bucket instead of N rows from every partition.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil import config as C
from vigil.functions import columns as X


def as_of_latest(df: DataFrame, ts_col: str) -> Column:
    """Scalar subquery: the newest timestamp of a table (no join, no driver round trip)."""
    return df.select(F.max(ts_col)).scalar()


def newest_time(df: DataFrame, ts_col: str) -> Column:
    """The newest timestamp as a literal: one lookup, after which filters on time can prune files."""
    return F.lit(df.agg(F.max(ts_col)).first()[0]).cast(df.schema[ts_col].dataType)


def since(as_of: Column, hours: int | None = None, minutes: int | None = None) -> Column:
    if hours is not None:
        return as_of - F.make_dt_interval(hours=F.lit(hours))
    return as_of - F.make_dt_interval(mins=F.lit(minutes))


def parse_timestamp(c: Column) -> Column:
    """Text to timestamp; unparseable text is NULL."""
    return F.try_to_timestamp(X.strip_ws(c))


_BUCKETS = ["day", "hour", "minute", "second"]


def newest_bound(df: DataFrame, ts_col: str, n: int, max_candidates: int | None = None) -> datetime | None:
    """Start of a time bucket such that rows at or after it hold the newest ``n`` rows.

    Counts per day, then per hour / minute / second inside the boundary bucket only, until that
    holds at most ``max_candidates`` rows (default 4n; this tunes the plan, not the result). Only the
    few newest buckets that reach ``n`` come to the driver. Returns None when the table has fewer
    than ``n`` timestamped rows.
    """
    limit = max_candidates or 4 * n
    kind = df.schema[ts_col].dataType
    stored = "date" in df.columns
    scope = df.select(ts_col, *(["date"] if stored else [])).filter(F.col(ts_col).isNotNull())
    need, bound = n, None
    for unit in _BUCKETS:
        bucket = F.col("date").cast(kind) if stored and unit == "day" else F.date_trunc(unit, ts_col).cast(kind)
        hist = scope.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("c"))
        above = F.sum("c").over(Window.orderBy(F.desc("b")))                  # over the buckets
        hit = hist.withColumn("total", above).where(F.col("total") >= need).orderBy(F.desc("b")).first()
        if hit is None:
            return bound
        bound = hit["b"]
        if hit["c"] <= limit:
            return bound
        need -= hit["total"] - hit["c"]
        scope = on_or_after(scope, ts_col, F.lit(bound).cast(kind)).where(bucket == F.lit(bound).cast(kind))
    return bound


def on_or_after(df: DataFrame, ts_col: str, start: Column) -> DataFrame:
    """Rows from ``start`` on; where the table is laid out by reading date, other dates aren't read."""
    out = df.filter(F.col(ts_col) >= start)
    return out.filter(F.col("date") >= F.to_date(start)) if "date" in df.columns else out


def latest_n(df: DataFrame, ts_col: str, n: int = C.RECENT_LIMIT) -> DataFrame:
    """Newest ``n`` rows (top-k; equal times by the other columns).

    A time bound found from bucket counts first narrows the input to about
    n + (one boundary bucket) rows, so the final top-k merge does not receive
    n rows from every partition of a large table.
    """
    bound = newest_bound(df, ts_col, n)
    src = df if bound is None else on_or_after(df, ts_col, F.lit(bound).cast(df.schema[ts_col].dataType))
    ties = [F.col(c) for c in df.columns if c != ts_col]
    return src.orderBy(F.col(ts_col).desc(), *ties).limit(n)


def recent_slice(df: DataFrame, ts_col: str, as_of: Column, hours: int = C.DEFAULT_RECENT_HOURS) -> DataFrame:
    """All rows with ts >= as_of - hours, oldest first. (For a display of the newest few, put ``latest_n`` before.)"""
    if hours not in C.RECENT_HOURS:
        raise ValueError(f"hours must be one of {C.RECENT_HOURS}")
    return on_or_after(df, ts_col, since(as_of, hours=hours)).orderBy(ts_col)


def recent_sensor_slice(sensors: DataFrame, as_of: Column, hours: int = C.DEFAULT_RECENT_HOURS) -> DataFrame:
    return recent_slice(sensors, "ts", as_of, hours)


def recent_prediction_slice(predictions: DataFrame, as_of: Column, hours: int = C.DEFAULT_RECENT_HOURS) -> DataFrame:
    return recent_slice(predictions, "source_timestamp", as_of, hours)


def rethreshold(predictions: DataFrame, threshold: float = C.DASHBOARD_THRESHOLD) -> DataFrame:
    """Recompute the flag at a user threshold; the stored fault_hint is kept as is."""
    if not 3.0 <= threshold <= 15.0:
        raise ValueError("threshold must be within 3.0 .. 15.0")
    return predictions.withColumn("is_anomaly", F.col("anomaly_score") > F.lit(float(threshold)))


def score_series(predictions: DataFrame, threshold: float = C.DASHBOARD_THRESHOLD) -> DataFrame:
    """Scores against time, flagged at the user threshold."""
    return rethreshold(predictions, threshold).select("source_timestamp", "anomaly_score", "is_anomaly").orderBy("source_timestamp")


def anomaly_points(predictions: DataFrame, threshold: float = C.DASHBOARD_THRESHOLD) -> DataFrame:
    """The points above the user threshold."""
    return (rethreshold(predictions, threshold).filter(F.col("is_anomaly"))
            .select("source_timestamp", "anomaly_score", "fault_hint").orderBy("source_timestamp"))


def sensor_signals(sensors: DataFrame, chosen=("TP2", "Motor_current", "Oil_temperature"),
                   ts_col: str = "ts") -> DataFrame:
    """Chosen sensors against time, long form (ts, sensor, value)."""
    return sensors.unpivot([ts_col], list(chosen), "sensor", "value")


def last_alerts(predictions: DataFrame, n: int = C.LAST_ALERTS, threshold: float = C.DASHBOARD_THRESHOLD) -> DataFrame:
    """Newest ``n`` rows above the user threshold, newest first (equal times by score and label)."""
    return (rethreshold(predictions, threshold).filter(F.col("is_anomaly"))
            .select("source_timestamp", "anomaly_score", "fault_hint")
            .orderBy(F.col("source_timestamp").desc(), "anomaly_score", "fault_hint").limit(n))


def alert_rows(predictions: DataFrame, as_of: Column, minutes: int = C.ALERT_WINDOW_MINUTES) -> DataFrame:
    """Stored alerts of the window; where predictions are laid out by processing date, older dates aren't read."""
    start = since(as_of, minutes=minutes)
    rows = predictions.filter(F.col("is_anomaly") & (F.col("processed_at") >= start))
    return rows.filter(F.col("processed_date") >= F.to_date(start)) if "processed_date" in predictions.columns else rows


def recent_alerts(predictions: DataFrame, as_of: Column, minutes: int = C.ALERT_WINDOW_MINUTES,
                  shown: int = C.ALERTS_SHOWN) -> DataFrame:
    """Flagged rows processed within the window: display projection, newest ``shown``."""
    return (alert_rows(predictions, as_of, minutes)
            .select("source_timestamp", "anomaly_score", "fault_hint")
            .orderBy(F.col("source_timestamp").desc(), "anomaly_score", "fault_hint").limit(shown))


def alert_count(predictions: DataFrame, as_of: Column, minutes: int = C.ALERT_WINDOW_MINUTES) -> DataFrame:
    return alert_rows(predictions, as_of, minutes).agg(F.count(F.lit(1)).alias("alerts"))


def dashboard_kpis(predictions: DataFrame, threshold: float = C.DASHBOARD_THRESHOLD) -> DataFrame:
    """Total, anomalies, share, mean score, latest score and status at the user threshold. Of several predictions with the
    newest time the highest score is the latest."""
    flagged = rethreshold(predictions, threshold)
    newest = F.when(F.col("source_timestamp").isNotNull(), F.struct("source_timestamp", "anomaly_score"))
    agg = flagged.agg(F.count(F.lit(1)).alias("total_records"),
                      F.count_if(F.col("is_anomaly")).alias("anomalies"),
                      F.avg("anomaly_score").alias("avg_score"),
                      F.max_by("anomaly_score", newest).alias("latest_score"))
    return kpi_row(agg, threshold)


def kpi_row(totals: DataFrame, threshold: float) -> DataFrame:
    """Share and status of ``totals`` (total_records, anomalies, avg_score, latest_score)."""
    return totals.select(
        "total_records", "anomalies",
        F.try_divide(F.lit(100.0) * F.col("anomalies"), F.col("total_records").cast("double")).alias("anomaly_pct"),
        "avg_score", "latest_score",
        F.when(F.col("latest_score") > F.lit(float(threshold)), F.lit("ANOMALY")).otherwise(F.lit("NORMAL"))
        .alias("status"))


def fault_distribution(predictions: DataFrame, threshold: float = C.DASHBOARD_THRESHOLD) -> DataFrame:
    """Counts of stored labels among rows flagged at the user threshold."""
    flagged = rethreshold(predictions, threshold).filter(F.col("is_anomaly"))
    return flagged.groupBy("fault_hint").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "fault_hint")


def time_bounds(df: DataFrame, ts_col: str) -> DataFrame:
    return df.agg(F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts"))


def dashboard(predictions: DataFrame, hours: int = C.DEFAULT_RECENT_HOURS, threshold: float = C.DASHBOARD_THRESHOLD) -> DataFrame:
    """The dashboard's chain: recent slice, flags at the user threshold, key figures."""
    recent = recent_slice(predictions, "source_timestamp", newest_time(predictions, "source_timestamp"), hours)
    return dashboard_kpis(recent, threshold)


def sample_record(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """The first row in the given order."""
    return df.orderBy(*order_cols).limit(1)
