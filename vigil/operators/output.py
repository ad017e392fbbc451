"""Run stamping and the 17-column predictions projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import config as C


def stamp_run(labeled: DataFrame, threshold: float, processed_at: Column, run_id: str,
              split: str | None = None) -> DataFrame:
    """Constants of one run: threshold, processing time, run id, split name."""
    out = labeled.withColumns({
        "threshold_used": F.lit(float(threshold)),
        "processed_at": processed_at,
        "spark_run_id": F.lit(run_id),
    })
    if split is not None:
        out = out.withColumn("data_split", F.lit(split))
    return out


def prediction_projection(stamped: DataFrame, ts_col: str = "ts") -> DataFrame:
    renames = {"source_timestamp": ts_col, "cluster_id": "cluster"}
    return stamped.select(*[F.col(renames.get(c, c)).alias(c) for c in C.PREDICTION_COLS])


def predictions(labeled: DataFrame, threshold: float, processed_at: Column, run_id: str,
                split: str | None = None, ts_col: str = "ts") -> DataFrame:
    return prediction_projection(stamp_run(labeled, threshold, processed_at, run_id, split), ts_col)
