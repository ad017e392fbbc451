"""Plan guards over every registered query: no cross joins, no nested-loop joins."""

import __spark_entry__ as E
from conftest import SF_SMALL


def test_no_cross_or_nested_loop_joins(spark):
    bad = {}
    for name, fn in E.queries().items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        hits = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_serving_prunes_by_date(spark, tmp_dir):
    """Slices read only the dates they need, alerts only the processing dates; building them starts one lookup at most."""
    from pyspark.sql import functions as F

    from vigil.operators import serve as S
    from vigil.plans import catalog as K
    from vigil.sources import ingest, sinks

    raw, preds = f"{tmp_dir}/raw", f"{tmp_dir}/preds"
    ingest.write_raw_batches(K.prepared(spark, SF_SMALL).sensors, raw)
    sinks.append_predictions(K.fixed_predictions(spark, SF_SMALL), preds)
    sensors, predictions = spark.read.parquet(raw), spark.read.parquet(preds)

    def filters(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]

    slices = S.recent_sensor_slice(sensors, S.newest_time(sensors, "ts"), 3)
    assert "date" in filters(slices)
    days = {r.d for r in sensors.select(F.to_date("ts").alias("d")).distinct().collect()}
    assert len(slices.select("date").distinct().collect()) <= 2 < len(days)
    assert "date" in filters(S.recent_prediction_slice(predictions, S.newest_time(predictions, "source_timestamp")))
    assert "processed_date" in filters(S.recent_alerts(predictions, K.ntz(K.ALERT_AS_OF)))
    assert "processed_date" in filters(S.alert_count(predictions, K.ntz(K.ALERT_AS_OF)))
    assert "date" in filters(S.latest_n(sensors, "ts", 5))


def test_batch_job_takes_landed_tables(spark, tmp_dir):
    """What the CSV load and the stream land goes into the job as it is."""
    from vigil.config import Paths
    from vigil.plans import catalog as K
    from vigil.plans.batch import run_batch
    from vigil.sources.ingest import read_raw
    from vigil.streaming.ingest import run_ingest

    by_csv = K._store(spark, SF_SMALL)
    paths = Paths(f"{tmp_dir}/store")
    run_ingest(spark, paths, "text", {}, K._messages(spark, SF_SMALL, clean=True), available_now=True).awaitTermination()
    done = [run_batch(spark, read_raw(spark, p), by_csv, run_id=f"r{i}", processed_at=K.ntz(K.PROCESSED_AT))
            for i, p in enumerate((by_csv.raw, paths.stream))]
    assert done[0].records == done[1].records > 0 and done[0].demo_anomalies == done[1].demo_anomalies
    assert done[0].model_loaded_from_cache and done[1].model_loaded_from_cache
