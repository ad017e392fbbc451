"""Serving queries: bounded newest-N equals the plain top-k, including hot timestamps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.operators import serve as S
from vigil.sources.fixture import sensor_table


def plain(df, ts, n):
    return df.orderBy(F.col(ts).desc()).limit(n)


@pytest.mark.parametrize("n", [1, 10, 137, 999, 1000, 5000])
def test_latest_n_equals_plain_top_k(spark, n):
    df = sensor_table(spark, SF_SMALL)
    got = sorted(r.event_id for r in S.latest_n(df, "ts", n).collect())
    want = sorted(r.event_id for r in plain(df, "ts", n).collect())
    assert got == want


def test_latest_n_with_a_hot_timestamp(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=i)) for i in range(300)]
    rows += [(1000 + i, t0 + dt.timedelta(days=2)) for i in range(400)]        # one instant holds most rows
    rows += [(5000 + i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    for n in (3, 50, 399, 400, 401, 650, 700, 705, 800):
        got = S.latest_n(df, "ts", n).collect()
        want = plain(df, "ts", n).collect()
        assert len(got) == len(want)
        assert sorted((r.ts is None, r.ts) for r in got if r.ts is not None) == \
            sorted((r.ts is None, r.ts) for r in want if r.ts is not None)


def test_bound_is_fine_grained(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(seconds=7 * i)) for i in range(20000)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    bound = S.newest_bound(df, "ts", 100)
    cand = df.filter(F.col("ts") >= F.lit(bound).cast("timestamp_ntz")).count()
    assert 100 <= cand <= 500


def test_latest_score_of_equal_times_is_the_highest(spark):
    from vigil.operators import serve as S
    rows = [("2024-01-01 00:00:00", 9.0), ("2024-01-01 00:00:10", 2.0), ("2024-01-01 00:00:10", 7.0), ("2024-01-01 00:00:10", 3.0), (None, 50.0)]
    df = spark.createDataFrame(rows, "t string, anomaly_score double").selectExpr("cast(t as timestamp_ntz) as source_timestamp", "anomaly_score", "false as is_anomaly")
    for parts in (1, 2, 5):
        row = S.dashboard_kpis(df.repartition(parts)).first()
        assert (row.latest_score, row.status, row.total_records) == (7.0, "ANOMALY", 5)
    assert S.dashboard_kpis(df.filter("source_timestamp is null")).first().latest_score is None
