"""Zone maps and dashboard partials: the answers of a full scan, whatever has landed since, from few files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.operators import partials as D
from vigil.operators import report as R
from vigil.operators import serve as S
from vigil.sources import ingest, sinks, zones
from vigil.sources.fixture import sensor_table

T0 = dt.datetime(2024, 1, 1)


def plain(df):
    return sorted(map(str, df.collect()))


def land(spark, path, first, n):
    df = spark.createDataFrame([(i, T0 + dt.timedelta(minutes=7 * i)) for i in range(first, first + n)] + [(-first, None)], "id long, ts timestamp_ntz")
    df.coalesce(1).write.mode("append").parquet(path)


def same(spark, path):
    z, full = zones.zoned(spark, path, "ts"), spark.read.parquet(path)
    assert zones.time_bounds(z).collect() == S.time_bounds(full, "ts").collect()
    assert zones.table_summary(z, "t").collect() == R.table_summary(full, "t", "ts").collect()
    assert zones.freshness(z).collect() == R.freshness(full).collect()
    for hours in (1, 6, 24):
        assert zones.recent_slice(z, hours).collect() == S.recent_slice(full, "ts", S.newest_time(full, "ts"), hours).collect()
    for n in (1, 3, 100, 101, 250, 10_000):
        got = zones.latest_n(z, n)
        assert plain(got) == plain(S.latest_n(full, "ts", n))
    return z


def test_zone_map_before_within_and_after_landings(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t x")
    land(spark, path, 0, 100)
    same(spark, path)                                   # no map yet
    zones.refresh_zones(spark, path, "ts")
    land(spark, path, 100, 100)
    same(spark, path)                                   # the second file isn't in the map
    zones.refresh_zones(spark, path, "ts")
    for k in range(2, 6):
        land(spark, path, 100 * k, 100)
    zones.refresh_zones(spark, path, "ts")
    z = same(spark, path)
    assert z.zones.count() == 6 and zones.ZONES not in " ".join(spark.read.parquet(path).inputFiles())
    assert len(zones.recent_slice(z, 6).inputFiles()) == 1 and len(zones.latest_n(z, 150).inputFiles()) == 2
    oldest = min(z.zones.collect(), key=lambda r: r.first_ts).file
    os.remove(oldest.removeprefix("file:").replace("%20", " "))
    assert same(spark, path).zones.count() == 5         # its zone no longer counts


def test_rows_without_times_and_empty_tables(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.createDataFrame([], "id long, ts timestamp_ntz").write.parquet(path)
    for _ in range(2):
        z = zones.zoned(spark, path, "ts")
        assert zones.freshness(z).first().records == 0 and zones.recent_slice(z).count() == zones.latest_n(z).count() == 0
        zones.refresh_zones(spark, path, "ts")
    spark.createDataFrame([(1, None), (2, None)], "id long, ts timestamp_ntz").write.mode("append").parquet(path)
    z = zones.zoned(spark, path, "ts")
    assert zones.freshness(z).first().records == 2 and zones.recent_slice(z).count() == 0 and zones.latest_n(z, 1).count() == 1


def test_landings_write_their_zones(spark, tmp_dir, monkeypatch):
    """Versions of a loaded table have maps of their own; run ids may hold any characters."""
    csv, raw, preds = (os.path.join(tmp_dir, n) for n in ("csv", "raw", "preds"))
    rows = sensor_table(spark, SF_SMALL).withColumn("timestamp", F.col("ts").cast("string")).drop("ts")
    rows.write.option("header", True).csv(csv)
    for _ in range(2):
        ingest.load_raw(spark, csv, raw, drop=True)
    p = rows.select(F.col("timestamp").cast("timestamp_ntz").alias("source_timestamp"), F.col("TP2").alias("anomaly_score"),
                    (F.col("TP2") > 9).alias("is_anomaly"), F.lit("x").alias("fault_hint"), F.lit(T0).alias("processed_at"))
    for run in ("a/1 =%[x]*", "b"):
        assert sinks.append_predictions(p, preds, run_id=run)
    monkeypatch.setattr(zones, "zone_rows", lambda *a: pytest.fail("scanned"))      # all zones are there
    z = zones.zoned(spark, raw, "ts")
    assert zones.freshness(z).first().records == 1000
    z, full = zones.zoned(spark, preds, "source_timestamp"), spark.read.parquet(preds)
    assert zones.table_summary(z, "p").collect() == R.table_summary(full, "p", "source_timestamp").collect()
    assert plain(zones.recent_slice(z, 24)) == plain(S.recent_slice(full, "source_timestamp", S.newest_time(full, "source_timestamp"), 24))


ODD = [None, float("nan"), float("inf"), float("-inf"), 0.0, 2.9, 3.0, 3.0000001, 3.5, 5.75, 6.0, 6.1, 6.2, 6.25, 6.5, 14.9, 15.0, 15.1, 900.0]


def test_partials_equal_the_full_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "d")
    rows = [(None if i % 23 == 5 else T0 + dt.timedelta(minutes=11 * (i // 3)), ODD[i * 7 % len(ODD)], f"f{i % 4}" if i % 9 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "source_timestamp timestamp_ntz, anomaly_score double, fault_hint string").withColumn("is_anomaly", F.lit(False))
    tame = df.where("anomaly_score is null or abs(anomaly_score) < 1000")       # sums without infinities can be compared
    for name, table in (("odd", df), ("tame", tame)):
        at = f"{path}-{name}"
        for run, part in (("a", table.where("fault_hint = 'f1'")), ("b", table.where("fault_hint is distinct from 'f1'"))):
            for _ in range(2):
                D.add_partials(part, at, run)
        for hours in (None, 1, 24):
            held = table if hours is None else S.recent_slice(table, "source_timestamp", S.newest_time(table, "source_timestamp"), hours)
            for t in (3.0, 3.2, 6.0, 6.2, 15.0):
                got, want = D.dashboard_kpis(spark, at, t, hours).first().asDict(), S.dashboard_kpis(held, t).first().asDict()
                avg = (got.pop("avg_score"), want.pop("avg_score"))
                assert str(got) == str(want) and (name == "odd" or avg[0] == pytest.approx(avg[1]))
                assert plain(D.fault_distribution(spark, at, t, hours)) == plain(S.fault_distribution(held, t))
    with pytest.raises(ValueError):
        D.dashboard_kpis(spark, f"{path}-odd", 2.0)


def test_a_threshold_reads_one_band(spark, tmp_dir):
    path = os.path.join(tmp_dir, "d")
    df = spark.range(20_000).select((F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("source_timestamp"),
                                    (F.col("id") % 1700 / 100).alias("anomaly_score"), F.lit("x").alias("fault_hint"))
    D.add_partials(df, path, "a")
    plan = D.dashboard_kpis(spark, path, 6.2)._jdf.queryExecution().executedPlan().toString()
    assert "(band#" in plan.split("PartitionFilters")[2 if plan.count("PartitionFilters") > 2 else 1] or "= 13)" in plan
    assert D.ROWS not in D.dashboard_kpis(spark, path, 6.0)._jdf.queryExecution().executedPlan().toString().replace("rows#", "")
    one = spark.read.parquet(f"{path}/{D.ROWS}").where("band = 13")
    assert one.count() < 20_000 / 20


def test_partials_of_a_run_that_was_killed(spark, tmp_dir, monkeypatch):
    """Rows without their sums don't count; the run's second attempt adds what is missing."""
    path = os.path.join(tmp_dir, "d")
    df = spark.createDataFrame([(T0, 6.3, "x")] * 5, "source_timestamp timestamp_ntz, anomaly_score double, fault_hint string")
    D.add_partials(df, path, "a")
    real = D.commit_once
    with monkeypatch.context() as m:
        m.setattr(D, "commit_once", lambda s, p, r, w: real(s, p, r, w) if p.endswith(D.ROWS) else pytest.fail("killed"))
        with pytest.raises(pytest.fail.Exception):
            D.add_partials(df, path, "b")
    assert D.dashboard_kpis(spark, path, 6.2).first().anomalies == 5
    D.add_partials(df, path, "b")
    assert D.dashboard_kpis(spark, path, 6.2).first()[:2] == (10, 10)
