"""End-to-end batch job: first run trains and saves, second run loads the cached model."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil import config as C
from vigil.plans.batch import run_batch, run_checks
from vigil.sources.commit import current_version
from vigil.sources.fixture import sensor_table


def test_run_batch_twice(spark, tmp_dir):
    paths = C.Paths(os.path.join(tmp_dir, "store"))
    sensors = sensor_table(spark, SF_SMALL).drop("asset_id")
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    r1 = run_batch(spark, sensors, paths, run_id="run-1", processed_at=at)
    assert not r1.model_loaded_from_cache
    assert r1.records == 978 and r1.train_rows + r1.test_rows + r1.demo_rows == r1.records
    preds = spark.read.parquet(paths.predictions)
    assert preds.count() == r1.demo_rows
    assert set(C.PREDICTION_COLS) <= set(preds.columns)
    r2 = run_batch(spark, sensors, paths, run_id="run-2", processed_at=at)
    assert r2.model_loaded_from_cache and r2.threshold == r1.threshold
    log = spark.read.parquet(paths.run_log).orderBy("spark_run_id").collect()
    assert [r.spark_run_id for r in log] == ["run-1", "run-2"]
    assert [r.model_loaded_from_cache for r in log] == [False, True]
    assert log[0].records_processed == r1.demo_rows and log[0].anomalies_found == r1.demo_anomalies
    report = spark.read.json(current_version(spark, paths.report))
    assert report.filter("section = 'overview' and metric = 'total_records'").first().value == r1.test_rows
    # the landed table the freshness gate reads
    sensors.write.parquet(paths.raw)
    out = run_checks(spark, paths, F.lit("2024-02-01 00:05:00").cast("timestamp"))
    assert out["landed_rows"] == 1000
    assert out["alerts"] == preds.filter("is_anomaly").count() * 2 and len(out["shown"]) <= C.ALERTS_SHOWN


def test_run_batch_leaves_no_intermediate_table(spark, tmp_dir):
    from vigil.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark)
    tables = os.path.join(root.replace("file:", ""), "tables")
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    paths = C.Paths(os.path.join(tmp_dir, "store2"))
    run_batch(spark, sensor_table(spark, SF_SMALL).drop("asset_id"), paths, run_id="run-x")
    after = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    assert not [t for t in after - before if t.startswith("featured-")]
