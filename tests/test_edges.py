"""Edge tables (FIXTURES F8): empty, one row, around the frame length, division by zero, ties."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil import config as C
from vigil.operators import model as M
from vigil.operators import ordered as O
from vigil.operators import report as R

SCHEMA = ("event_id long, ts timestamp_ntz, TP2 double, TP3 double, H1 double, DV_pressure double, "
          "Reservoirs double, Oil_temperature double, Motor_current double, LPS int")


def rows(n, oil=70.0):
    t0 = dt.datetime(2024, 1, 1)
    return [(i, t0 + dt.timedelta(seconds=10 * i), 9.0 + (i % 7) * 0.1, 8.8, 9.1, 1.2, 9.0, oil, 5.0 + (i % 5),
             None if i % 3 == 0 else 1) for i in range(n)]


def frame(spark, n, oil=70.0):
    return spark.createDataFrame(rows(n, oil), SCHEMA)


def global_features(df):
    w = Window.orderBy("ts", "event_id").rowsBetween(-C.ROLLING_PRECEDING, 0)
    return {r.event_id: r for r in df.select(
        "event_id", F.avg("TP2").over(w).alias("m"), F.coalesce(F.stddev_samp("Motor_current").over(w),
                                                                F.lit(0.0)).alias("s")).collect()}


def test_empty_table(spark):
    idx = O.row_index(frame(spark, 0))
    assert idx.n == 0
    feat = O.engineer_features(idx)
    assert feat.count() == 0
    labeled = O.temporal_split(feat, idx.n)
    assert labeled.count() == 0
    assert R.fault_breakdown(labeled.withColumn("is_anomaly", F.lit(True)).withColumn("fault_hint", F.lit("x"))) \
        .count() == 0


def test_one_row_std_is_zero(spark):
    feat = O.engineer_features(O.row_index(frame(spark, 1)))
    r = feat.first()
    assert r.rolling_std_TP2 == 0.0 and r.rolling_std_motor == 0.0 and r.rolling_mean_TP2 == r.TP2
    assert r.LPS == 0                                       # null digital filled with 0


@pytest.mark.parametrize("n", [180, 181, 182, 400])
def test_around_frame_length(spark, n):
    df = frame(spark, n)
    expected = global_features(df)
    idx = O.row_index(df, partitions=3)
    for r in O.engineer_features(idx, block=O.MIN_BLOCK, method="frame").collect():
        assert r.rolling_mean_TP2 == expected[r.event_id].m
        assert r.rolling_std_motor == expected[r.event_id].s
    for r in O.engineer_features(idx, block=362, method="linear").collect():
        e = expected[r.event_id]
        assert abs(r.rolling_mean_TP2 - e.m) <= 1e-12 * abs(e.m)
        assert abs(r.rolling_std_motor - e.s) <= 1e-9 * max(1.0, e.s)


def test_oil_minus_one_gives_zero_ratio(spark):
    feat = O.engineer_features(O.row_index(frame(spark, 5, oil=-1.0)))
    assert {r.motor_oil_ratio for r in feat.collect()} == {0.0}


def test_all_null_feature_drops_every_row(spark):
    df = frame(spark, 10).withColumn("H1", F.lit(None).cast("double"))
    assert O.drop_incomplete(df).count() == 0


def test_nan_feature_dropped(spark):
    df = frame(spark, 10).withColumn("TP3", F.when(F.col("event_id") == 3, F.lit(float("nan"))).otherwise(F.col("TP3")))
    assert O.drop_incomplete(df).count() == 9


def test_equal_fault_counts_order_by_label(spark):
    df = spark.createDataFrame([(True, "VALVE_PRESSURE_DROP"), (True, "OVERHEATING"), (True, "GENERAL_ANOMALY"),
                                (True, "GENERAL_ANOMALY"), (False, "NORMAL")], "is_anomaly boolean, fault_hint string")
    got = [(r.fault_hint, r["count"]) for r in R.fault_breakdown(df).collect()]
    assert got == [("GENERAL_ANOMALY", 2), ("OVERHEATING", 1), ("VALVE_PRESSURE_DROP", 1)]


def test_no_rule_fires_at_bounds(spark):
    df = spark.createDataFrame([(8.0, 25.0, 90.0, 0.5, 10.0)], "TP2 double, Motor_current double, "
                               "Oil_temperature double, DV_pressure double, anomaly_score double")
    assert M.label(df, 1.0).first().fault_hint == C.FAULT_OTHER
    assert R.sensor_breaches(df).first().asDict() == {f"breach_{c}": 0 for _, c, _, _ in C.FAULT_RULES}


def test_sizing_rounds_to_core_waves():
    from vigil.session import sizing
    conf = sizing(100 * 2**40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) % 8000 == 0
    assert int(conf["spark.sql.shuffle.partitions"]) * 256 * 2**20 >= 100 * 2**40
    assert sizing(10, 8)["spark.sql.shuffle.partitions"] == "8"
