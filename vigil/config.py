"""Fixed values, schemas and run parameters.

Everything that must equal the original pipeline's values for identical
results lives in the first block below, stated plainly and in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for the same results)
# ---------------------------------------------------------------------------
ANALOGUE_COLS = ["TP2", "TP3", "H1", "DV_pressure", "Reservoirs", "Oil_temperature", "Motor_current"]
DIGITAL_COLS = ["COMP", "DV_eletric", "Towers", "MPG", "LPS", "Pressure_switch", "Oil_level", "Caudal_impulses"]
DERIVED_COLS = ["pressure_diff_TP2_TP3", "pressure_diff_H1_DV", "motor_oil_ratio"]
ROLLING_COLS = ["rolling_mean_TP2", "rolling_std_TP2", "rolling_mean_motor", "rolling_std_motor"]
FEATURE_COLS = ANALOGUE_COLS
EXTENDED_COLS = ANALOGUE_COLS + DERIVED_COLS + ROLLING_COLS

ROLLING_PRECEDING = 180            # row frame: 180 preceding rows + current row
TRAIN_RATIO = 0.70
TEST_RATIO = 0.20
KMEANS_K = 8
KMEANS_SEED = 42
THRESHOLD_SIGMAS = 3.0             # threshold = mean + 3 * sample stddev of train scores

# Fault rules, first match wins; applied to anomalous rows only.
FAULT_RULES = [
    ("LOW_COMPRESSOR_PRESSURE", "TP2", "<", 8.0),
    ("HIGH_MOTOR_CURRENT", "Motor_current", ">", 25.0),
    ("OVERHEATING", "Oil_temperature", ">", 90.0),
    ("VALVE_PRESSURE_DROP", "DV_pressure", "<", 0.5),
]
FAULT_OTHER = "GENERAL_ANOMALY"
FAULT_NONE = "NORMAL"

# Report checks.
RATE_LOW_PCT = 1.0
RATE_HIGH_PCT = 5.0
GOOD_GAP_FACTOR = 0.5              # gap > 0.5 * threshold -> GOOD
STRONG_GAP = 1.0                   # gap > 1.0 -> PASS
PERCENTILES = [0.50, 0.90, 0.95, 0.99]

# Serving.
DASHBOARD_THRESHOLD = 6.0          # user threshold, slider 3.0 .. 15.0
RECENT_HOURS = [1, 3, 6, 12, 24]
DEFAULT_RECENT_HOURS = 6
RECENT_LIMIT = 5000
LAST_ALERTS = 10
ALERT_WINDOW_MINUTES = 15
ALERTS_SHOWN = 5

PREDICTION_COLS = [
    "source_timestamp", "anomaly_score", "is_anomaly", "fault_hint", "cluster_id", "threshold_used",
    "TP2", "Motor_current", "Oil_temperature", "DV_pressure", "pressure_diff_TP2_TP3", "motor_oil_ratio",
    "rolling_mean_TP2", "rolling_mean_motor", "processed_at", "spark_run_id", "data_split",
]

# Table names (one configuration for all readers and writers).
RAW_TABLE = "raw_readings"
STREAM_TABLE = "landed_readings"
PREDICTIONS_TABLE = "predictions"
RUN_LOG_TABLE = "run_log"


# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
# Stream message: every field is read as text and coerced like a CSV field, so one bad field costs that field only.
MESSAGE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ["timestamp", *ANALOGUE_COLS, *DIGITAL_COLS]]
)

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("spark_run_id", T.StringType(), False),
    T.StructField("processed_at", T.TimestampType(), False),
    T.StructField("records_processed", T.LongType(), False),
    T.StructField("anomalies_found", T.LongType(), False),
    T.StructField("threshold_used", T.DoubleType(), False),
    T.StructField("model_loaded_from_cache", T.BooleanType(), False),
    T.StructField("data_split", T.StringType(), False),
])


@dataclass(frozen=True)
class Paths:
    """Where a deployment keeps its tables and model; every path is a Hadoop path."""

    root: str
    fmt: str = "parquet"

    @property
    def raw(self) -> str:
        return f"{self.root}/{RAW_TABLE}"

    @property
    def stream(self) -> str:
        return f"{self.root}/{STREAM_TABLE}"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejected_messages"

    @property
    def predictions(self) -> str:
        return f"{self.root}/{PREDICTIONS_TABLE}"

    @property
    def run_log(self) -> str:
        return f"{self.root}/{RUN_LOG_TABLE}"

    @property
    def model(self) -> str:
        return f"{self.root}/model"

    @property
    def report(self) -> str:
        return f"{self.root}/evaluation_report"
