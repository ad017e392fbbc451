"""Sensor views over the driver's ``events`` table.

The test tables carry no sensor columns, so every registered query reads
``events`` through these views. The select lists are plain SQL understood by
both Spark and DuckDB (``e0`` literals keep arithmetic in doubles), so the same
text defines the view on both sides of the oracle check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sensor view: 7 analogue doubles, 8 digital ints, time key (ts, event_id).
SENSOR_SELECT = [
    "event_id", "ts", "user_id as asset_id",
    "6e0+cast(c % 600 as double)/100e0 as TP2",
    "8e0+cast(c % 170 as double)/100e0 as TP3",
    "8e0+cast(c % 230 as double)/100e0 as H1",
    "cast(c % 130 as double)/100e0 as DV_pressure",
    "85e-1+cast(c % 90 as double)/100e0 as Reservoirs",
    "case when event_id % 97 = 0 then null else 50e0+cast(c % 450 as double)/10e0"
    " + (case when event_id % 211 = 5 then 150e0 else 0e0 end) end as Oil_temperature",
    "case when event_id % 89 = 0 then null else cast(c % 280 as double)/10e0"
    " + (case when event_id % 173 = 7 then 120e0 else 0e0 end) end as Motor_current",
    "cast(event_id % 2 as int) as COMP",
    "cast(event_id % 3 % 2 as int) as DV_eletric",
    "cast(event_id % 5 % 2 as int) as Towers",
    "cast(event_id % 7 % 2 as int) as MPG",
    "cast(case when event_id % 101 = 0 then null else event_id % 11 % 2 end as int) as LPS",
    "cast(event_id % 13 % 2 as int) as Pressure_switch",
    "cast(event_id % 17 % 2 as int) as Oil_level",
    "cast(event_id % 19 % 2 as int) as Caudal_impulses",
]
SENSOR_BASE = "(select *, cast(round(value*100e0) as bigint) as c from events)"

# Raw text view: the sensor view as CSV-like text with malformed fields by rule
# (blank timestamp, padding, object text, nan, inf, underscore and suffix forms,
# float text in digital fields).
RAW_TEXT_SELECT = [
    "event_id",
    "case when event_id % 53 = 0 then '   ' else cast(ts as string) end as timestamp",
    "case when event_id % 5 = 0 then '  ' || cast(TP2 as string) || ' ' else cast(TP2 as string) end as TP2",
    "case when event_type = 'error' and event_id % 7 = 0 then props else cast(TP3 as string) end as TP3",
    "case when event_id % 31 = 0 then 'nan' else cast(H1 as string) end as H1",
    "case when event_id % 41 = 0 then '0.5d' else cast(DV_pressure as string) end as DV_pressure",
    "case when event_id % 37 = 0 then '1_0' else cast(Reservoirs as string) end as Reservoirs",
    "cast(Oil_temperature as string) as Oil_temperature",
    "case when event_id % 43 = 0 then '-inf' else cast(Motor_current as string) end as Motor_current",
    "cast(cast(COMP as double) as string) as COMP",
    "cast(DV_eletric as string) as DV_eletric",
    "case when event_id % 47 = 0 then 'x' else cast(Towers as string) end as Towers",
    "cast(MPG as string) as MPG",
    "cast(LPS as string) as LPS",
    "case when event_id % 29 = 0 then ' 1e0 ' else cast(Pressure_switch as string) end as Pressure_switch",
    "cast(Oil_level as string) as Oil_level",
    "case when event_id % 23 = 0 then '1.9' else cast(Caudal_impulses as string) end as Caudal_impulses",
]


def sensor_view_sql() -> str:
    return f"select {', '.join(SENSOR_SELECT)} from {SENSOR_BASE}"


def raw_text_view_sql() -> str:
    return (f"select {', '.join(RAW_TEXT_SELECT)} from "
            f"(select s.*, e.event_type, e.props from ({sensor_view_sql()}) s "
            f"join events e on s.event_id = e.event_id)")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor_readings(events: DataFrame) -> DataFrame:
    """Sensor view from an events DataFrame (column-pruned scan: event_id, ts, user_id, value)."""
    base = events.select("event_id", "ts", "user_id", "value").withColumn(
        "c", F.round(F.col("value") * F.lit(100.0)).cast("bigint"))
    return base.selectExpr(*SENSOR_SELECT)


def sensor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_readings(read_table(spark, sf_dir, "events"))


def raw_text_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV-like text rows derived from events (no join needed: one pass over events)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "event_type", "props")
    base = ev.withColumn("c", F.round(F.col("value") * F.lit(100.0)).cast("bigint"))
    sensors = base.selectExpr(*SENSOR_SELECT, "event_type", "props")
    return sensors.selectExpr(*RAW_TEXT_SELECT)
