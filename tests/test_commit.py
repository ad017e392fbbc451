"""Runs that are repeated, killed or raced; loads that fail half-way."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil import config as C
from vigil.plans import batch
from vigil.plans import catalog as K
from vigil.sources import ingest, sinks
from vigil.sources.commit import commit_once, current_version, replace_version
from vigil.sources.fixture import sensor_table

AT = "2024-02-01 00:00:00"


def rows(spark, path):
    return sorted(map(str, spark.read.parquet(path).drop("run").collect()))


def test_a_killed_job_is_run_again_with_its_id(spark, tmp_dir, monkeypatch):
    """Killed before the predictions appear, then between predictions and log: every row is there once."""
    paths = C.Paths(os.path.join(tmp_dir, "store"))
    sensors = sensor_table(spark, SF_SMALL).drop("asset_id")

    def run(run_id):
        return batch.run_batch(spark, sensors, paths, run_id=run_id, processed_at=F.lit(AT).cast("timestamp"))

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr("vigil.sources.commit.Folders.rename", killed)
        m.setattr(batch.sinks, "save_report", lambda *a: None)
        with pytest.raises(KeyboardInterrupt):
            run("a/1 =x")
    assert not [x for x in os.listdir(paths.predictions) if not x.startswith("_")]
    with monkeypatch.context() as m:
        m.setattr(batch.sinks, "append_run_log", killed)
        with pytest.raises(KeyboardInterrupt):
            run("a/1 =x")
    once = rows(spark, paths.predictions)
    assert once and not os.path.exists(paths.run_log)
    first, again, other = run("a/1 =x"), run("a/1 =x"), run("b")
    assert rows(spark, paths.predictions) == sorted(once + [r.replace("a/1 =x", "b") for r in once])
    log = {r.spark_run_id: r for r in spark.read.parquet(paths.run_log).collect()}
    assert len(log) == spark.read.parquet(paths.run_log).count() == 2
    assert len(once) == first.demo_rows == again.demo_rows == other.demo_rows == log["a/1 =x"].records_processed
    assert first.demo_anomalies == log["a/1 =x"].anomalies_found == log["b"].anomalies_found
    assert os.listdir(os.path.join(paths.predictions, "_staged")) == []


def test_the_first_of_two_writers_wins(spark, tmp_dir):
    """The second one begins before the first has committed."""
    path = os.path.join(tmp_dir, "t")

    def slow(folder):
        assert commit_once(spark, path, "r", lambda f: spark.range(3).write.parquet(f))
        spark.range(100, 105).write.parquet(folder)
    assert commit_once(spark, path, "r", slow) is False
    assert [r.id for r in spark.read.parquet(path).orderBy("id").collect()] == [0, 1, 2]
    assert commit_once(spark, path, "r", lambda f: pytest.fail("written again")) is False


def test_runs_without_an_id_are_runs_of_their_own(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")
    preds = K.fixed_predictions(spark, SF_SMALL)
    assert sinks.append_predictions(preds, path) and sinks.append_predictions(preds, path)
    assert spark.read.parquet(path).count() == 2 * preds.count()


def csv(folder, lines):
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("\n".join(["timestamp,TP2", *lines]) + "\n")
    return folder


def test_a_load_that_fails_leaves_the_old_table(spark, tmp_dir, monkeypatch):
    target = os.path.join(tmp_dir, "raw")
    old = csv(os.path.join(tmp_dir, "old"), ["2024-01-01 00:00:00,1.5", "2024-01-02 00:00:00,2.5"])
    new = csv(os.path.join(tmp_dir, "new"), ["2024-03-01 00:00:00,9.5"])
    ingest.load_raw(spark, old, target)
    began = ingest.read_raw(spark, target)                      # a reader of before
    before = sorted(r.TP2 for r in began.collect())
    write = ingest.write_raw_batches

    def half(df, folder, *args, **kwargs):
        write(df, folder, *args, **kwargs)
        raise OSError("disk")
    with monkeypatch.context() as m:
        m.setattr(ingest, "write_raw_batches", half)
        with pytest.raises(OSError):
            ingest.load_raw(spark, new, target, drop=True)
    assert sorted(r.TP2 for r in ingest.read_raw(spark, target).collect()) == before == [1.5, 2.5]
    assert ingest.load_raw(spark, new, target, drop=True)["inserted"] == 1
    assert [r.TP2 for r in ingest.read_raw(spark, target).collect()] == [9.5]
    assert sorted(r.TP2 for r in began.collect()) == before     # still whole for who reads it
    ingest.load_raw(spark, old, target, drop=True)
    assert len([x for x in os.listdir(target) if x.startswith("v-")]) == 2


def test_a_plain_folder_becomes_a_version(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(4).write.parquet(path)
    assert current_version(spark, path) == path
    replace_version(spark, path, lambda f: spark.read.parquet(path).filter("id > 1").write.parquet(f))     # reads what it replaces
    assert [r.id for r in ingest.read_raw(spark, path).orderBy("id").collect()] == [2, 3]
    replace_version(spark, path, lambda f: spark.range(1).write.parquet(f))
    replace_version(spark, path, lambda f: spark.range(2).write.parquet(f))
    assert not [x for x in os.listdir(path) if x.startswith("part-")] and ingest.read_raw(spark, path).count() == 2


def test_a_hot_hour_is_written_by_several_tasks(spark, tmp_dir):
    """One hour holds nearly all rows; the other days share a task."""
    hot = spark.range(200_000).select(F.expr("timestamp_ntz'2024-01-01 05:00:00' + make_interval(0,0,0,0,0,0, id % 3600)").alias("ts"), F.rand(1).alias("TP2"))
    cold = spark.range(40).select(F.expr("timestamp_ntz'2024-01-02 00:00:00' + make_interval(0,0,0,cast(id % 8 as int))").alias("ts"), F.rand(2).alias("TP2"))
    path, size = os.path.join(tmp_dir, "raw"), spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        ingest.write_raw_batches(hot.unionByName(cold), path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = {d: len([f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")]) for d in os.listdir(path) if d.startswith("date=")}
    assert files.pop("date=2024-01-01") >= 3 and set(files.values()) == {1} and len(files) == 8
    assert spark.read.parquet(path).count() == 200_040
