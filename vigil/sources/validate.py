"""Warn-only schema validation: a ``violations`` array per row and counts per rule.

Rows are never rejected. A field breaks its rule when it is missing, NULL (a loader
writes every field, so the source value was missing or bad), or not of the declared type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import config as C

# (field, declared type, required)
RAW_RULES = ([("timestamp", "string", True)]
             + [(c, "double", False) for c in C.ANALOGUE_COLS]
             + [(c, "int", False) for c in C.DIGITAL_COLS]
             + [("_loaded_at", "timestamp", False)])
PREDICTION_RULES = [
    ("source_timestamp", "timestamp", True), ("anomaly_score", "double", True), ("is_anomaly", "bool", True),
    ("fault_hint", "string", False), ("cluster_id", "int", False), ("threshold_used", "double", False),
    ("TP2", "double", False), ("Motor_current", "double", False), ("Oil_temperature", "double", False),
    ("DV_pressure", "double", False), ("pressure_diff_TP2_TP3", "double", False), ("motor_oil_ratio", "double", False),
    ("rolling_mean_TP2", "double", False), ("rolling_mean_motor", "double", False),
    ("processed_at", "timestamp", True), ("spark_run_id", "string", False), ("data_split", "string", False),
]


def rule_name(field: str, kind: str, required: bool) -> str:
    return f"{field}:required" if required else f"{field}:not_{kind}"


# declared type -> Spark types that hold it, and the cast that text must pass
_TYPES = {"double": (("double", "float"), "double"), "int": (("int", "bigint", "smallint", "tinyint"), "int"),
          "bool": (("boolean",), "boolean"), "timestamp": (("timestamp", "timestamp_ntz"), "timestamp_ntz"),
          "string": (("string",), "string")}


def breaks(df: DataFrame, field: str, kind: str) -> Column:
    """True where the field is missing, NULL, of another type, or text that isn't of the declared type."""
    if field not in df.columns:
        return F.lit(True)
    held, cast = _TYPES[kind]
    given = df.schema[field].dataType.simpleString()
    if given in held:
        return F.col(field).isNull()
    return F.col(field).try_cast(cast).isNull() if given == "string" else F.lit(True)


def validate_schema(df: DataFrame, rules=RAW_RULES) -> DataFrame:
    """Add ``violations``: names of the rules a row breaks (empty when valid)."""
    checks = []
    for field, kind, required in rules:
        checks.append(F.when(breaks(df, field, kind), F.lit(rule_name(field, kind, required))))
    return df.withColumn("violations", F.array_compact(F.array(*checks)))


def violation_counts(validated: DataFrame) -> DataFrame:
    """Rows breaking each rule, from the per-row ``violations`` column."""
    return (validated.select(F.explode("violations").alias("rule"))
            .groupBy("rule").agg(F.count(F.lit(1)).alias("violations")))


def rule_counts(df: DataFrame, rules=RAW_RULES) -> DataFrame:
    """Same result as ``violation_counts(validate_schema(df))`` in one aggregation pass.

    One ``count_if`` per rule (a single partial aggregate per task), then the
    one-row result is unpivoted; rules nobody breaks are left out.
    """
    names = [rule_name(f, k, r) for f, k, r in rules]
    aggs = [F.count_if(breaks(df, f, k)).alias(f"_{i}") for i, (f, k, _) in enumerate(rules)]
    one = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("violations"))
                      for i, n in enumerate(names)])
    return one.select(F.inline(pairs)).filter(F.col("violations") > 0)
