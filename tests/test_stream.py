"""Structured Streaming: landing with checkpoints, replay, and micro-batch scoring."""

import json
import os
import shutil
from datetime import timedelta

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from vigil import config as C
from vigil.operators import model as M
from vigil.operators import ordered as O
from vigil.plans.fixture_model import fixed_model
from vigil.sources import codec
from vigil.sources.fixture import sensor_table
from vigil.streaming import scoring
from vigil.streaming.ingest import replay_batch, stream_source
from vigil.streaming.scoring import late_rows, stream_score


def write_messages(spark, sensors, folder, name, lo, hi):
    part = sensors.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi)) \
        .withColumn("timestamp", F.col("ts").cast("string")).drop("ts", "asset_id")
    rows = [r.value for r in codec.encode_json(part, key="event_id").collect()]
    ids = [r.event_id for r in part.select("event_id").collect()]
    with open(os.path.join(folder, name), "w") as f:
        for i, v in zip(ids, rows):
            d = json.loads(v)
            d["event_id"] = i
            f.write(json.dumps(d) + "\n")
    return len(rows)


@pytest.mark.parametrize("sizes", [[0], [1], [499, 500, 501]])
def test_replay_lands_every_message_once(spark, tmp_dir, sizes):
    sensors = sensor_table(spark, SF_MID)
    src, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "sink", "ckpt"))
    os.makedirs(src)
    total, lo = 0, 0
    for i, n in enumerate(sizes):
        total += write_messages(spark, sensors, src, f"b{i}.json", lo, lo + n)
        lo += n
    replay_batch(spark, src, sink, ckpt).awaitTermination()
    landed = spark.read.parquet(sink) if total else None
    assert (landed.count() if landed else 0) == total
    # restart on the same checkpoint: nothing is landed twice; new files are picked up
    extra = write_messages(spark, sensors, src, "late.json", 5000, 5010)
    replay_batch(spark, src, sink, ckpt).awaitTermination()
    landed = spark.read.parquet(sink)
    assert landed.count() == total + extra
    assert landed.select("timestamp").distinct().count() == total + extra
    assert "ingested_at" in landed.columns


def test_only_undecodable_messages_and_blank_times_are_rejected(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "sink", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "m.json"), "w") as f:
        f.write(json.dumps({"timestamp": "2024-01-01 00:00:00", "TP2": 9.0, "COMP": 1.0}) + "\n")
        f.write("{broken\n")
        f.write(json.dumps({"timestamp": "2024-01-01 00:00:10", "TP2": "x"}) + "\n")
        f.write(json.dumps({"timestamp": "", "TP2": 1.0}) + "\n")
    replay_batch(spark, src, sink, ckpt).awaitTermination()
    rows = spark.read.parquet(sink).orderBy("ts").collect()
    assert len(rows) == 2 and rows[0].COMP == 1 and rows[0].TP2 == 9.0
    assert rows[1].TP2 is None and str(rows[1].ts) == "2024-01-01 00:00:10"
    from vigil.streaming.ingest import message_counts, rejects
    msgs = spark.read.text(src)
    assert sorted((r.reason, r.raw[:7]) for r in rejects(msgs).collect()) == [("no_timestamp", '{"times'), ("not_json", "{broken")]
    assert tuple(message_counts(msgs).first()) == (2, 2)


def test_the_callers_batch_size_wins():
    from vigil.streaming.ingest import source_options
    assert "maxOffsetsPerTrigger" not in source_options("kafka", {})
    assert source_options("kafka", {"maxOffsetsPerTrigger": "9", "startingOffsets": "latest"}) == {
        "maxOffsetsPerTrigger": "9", "startingOffsets": "latest"}


def write_file(src, k, rows):
    with open(os.path.join(src, f"b{k:02d}.json"), "w") as f:
        for r in rows:
            f.write(json.dumps({"timestamp": str(r["ts"]), **{c: r[c] for c in C.ANALOGUE_COLS + C.DIGITAL_COLS}}) + "\n")
    os.utime(os.path.join(src, f"b{k:02d}.json"), (1_700_000_000 + k * 60,) * 2)


def score_files(spark, tmp_dir, delay, key=None, **options):
    source = stream_source(spark, "text", {"maxFilesPerTrigger": "1", **options}, os.path.join(tmp_dir, "src"))
    query = stream_score(source, os.path.join(tmp_dir, "preds"), os.path.join(tmp_dir, "ckpt"), fixed_model().with_threshold(5.0), "run", delay, key)
    query.awaitTermination()
    return query


def policy(files, delay):
    """The stated policy, one reading at a time: what is scored (with the mean of its frame), what is late, what still waits."""
    def passed(seen):
        newest = max(r["ts"] for f in seen for r in f)
        return newest.replace(microsecond=newest.microsecond // 1000 * 1000) - delay
    taken, late = [], []
    for k, rows in enumerate(files):
        mark = passed(files[:k - 1]) if k >= 2 else None
        for r in rows:
            (late if mark is not None and r["ts"] <= mark else taken).append(r)
    taken.sort(key=lambda r: r["ts"])
    means = {r["ts"]: sum(x["TP2"] for x in taken[max(0, i - 180):i + 1]) / min(i + 1, 181) for i, r in enumerate(taken)}
    return {t: m for t, m in means.items() if t <= passed(files)}, late, [r for r in taken if r["ts"] > passed(files)]


def test_readings_within_the_delay_in_any_order_and_late_ones(spark, tmp_dir):
    """14 micro-batches, 9 of them with late readings; then a second run on the same checkpoint takes what waited."""
    rows = [r.asDict() for r in O.drop_incomplete(sensor_table(spark, SF_SMALL)).orderBy("ts", "event_id").collect()]
    os.makedirs(src := os.path.join(tmp_dir, "src"))
    files = [rows[60 * k:60 * (k + 1)] for k in range(14)]
    for k in range(5, 14):                              # readings of three files before, and some from the file before
        files[k - 3], moved = files[k - 3][:-3], files[k - 3][-3:]
        files[k - 1], near = files[k - 1][:-5], files[k - 1][-5:]
        files[k] = moved + files[k][::-1] + near
    for k, f in enumerate(files):
        write_file(src, k, f)
    delay = timedelta(hours=40)
    query = score_files(spark, tmp_dir, "40 hours")
    want, late, waiting = policy(files, delay)
    got = {r.source_timestamp: r.rolling_mean_TP2 for r in spark.read.parquet(os.path.join(tmp_dir, "preds")).collect()}
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 14
    assert set(got) == set(want) and all(abs(got[t] - m) < 1e-9 for t, m in want.items())
    assert late_rows(query) == len(late) and len({r["ts"] for r in late}) >= 9 and waiting
    # restarted: the frames go on where they were, nothing is scored twice
    files += [rows[840:900], rows[900:978]]
    for k in (14, 15):
        write_file(src, k, files[k])
    score_files(spark, tmp_dir, "40 hours")
    scored = [r.source_timestamp for r in spark.read.parquet(os.path.join(tmp_dir, "preds")).collect()]
    assert len(scored) == len(set(scored)) and {r["ts"] for r in waiting} <= set(scored)
    more = {r.source_timestamp: r.rolling_mean_TP2 for r in spark.read.parquet(os.path.join(tmp_dir, "preds")).collect()}
    taken = sorted([r for f in files for r in f if r not in late], key=lambda r: r["ts"])
    for i, r in enumerate(taken):
        if r["ts"] in more and r["ts"] > rows[840]["ts"]:
            frame = [x["TP2"] for x in taken[max(0, i - 180):i + 1]]
            assert abs(more[r["ts"]] - sum(frame) / len(frame)) < 1e-9


def test_lost_state_stops_the_query(spark, tmp_dir):
    rows = [r.asDict() for r in O.drop_incomplete(sensor_table(spark, SF_SMALL)).orderBy("ts").limit(90).collect()]
    os.makedirs(src := os.path.join(tmp_dir, "src"))
    for k in range(2):
        write_file(src, k, rows[30 * k:30 * (k + 1)])
    score_files(spark, tmp_dir, "1 hour")
    shutil.rmtree(os.path.join(tmp_dir, "ckpt", "state"))
    spark._jvm.org.apache.spark.sql.execution.streaming.state.StateStore.stop()          # as on another executor: nothing is in memory
    write_file(src, 2, rows[60:])
    with pytest.raises(StreamingQueryException):
        score_files(spark, tmp_dir, "1 hour")


def test_a_micro_batch_is_handed_over_with_one_copy_of_the_state(spark, tmp_dir, monkeypatch):
    """Spark sends the whole state with every part of a key's readings: the parts are large, whatever the session's are."""
    rows = [r.asDict() for r in O.drop_incomplete(sensor_table(spark, SF_SMALL)).orderBy("ts").limit(120).collect()]
    real, parts = scoring.stream_sink, []
    monkeypatch.setattr(scoring, "stream_sink", lambda *a: parts.append(spark.conf.get(scoring.PART_CONF)) or real(*a))
    kept, found = spark.conf.get(scoring.PART_CONF), {}
    try:
        for part_rows, session in ((scoring.PART_ROWS, "7"), (7, "7"), (scoring.PART_ROWS, "0"), (7, "9")):
            folder = os.path.join(tmp_dir, f"{part_rows}-{session}")
            os.makedirs(src := os.path.join(folder, "src"))
            for k in range(3):
                write_file(src, k, rows[40 * k:40 * (k + 1)][::-1])
            monkeypatch.setattr(scoring, "PART_ROWS", part_rows)
            spark.conf.set(scoring.PART_CONF, session)
            score_files(spark, folder, "30 hours")
            assert spark.conf.get(scoring.PART_CONF) == session
            preds = spark.read.parquet(os.path.join(folder, "preds")).collect()
            found[part_rows, session] = sorted((r.source_timestamp, r.anomaly_score, r.rolling_mean_TP2, r.rolling_mean_motor) for r in preds)
    finally:
        spark.conf.set(scoring.PART_CONF, kept)
    assert parts == ["1000000", "7", "0", "9"]
    one, *others = found.values()
    assert len(one) > 60 and all(o == one for o in others)


def test_waiting_readings_are_packed_small(spark):
    rows = O.drop_incomplete(sensor_table(spark, SF_MID)).select(*scoring.SCORE_COLS).toPandas()
    packed = scoring.packed_rows(rows)
    assert len(packed) < rows.memory_usage(index=False).sum() / 3
    back = pa.ipc.open_stream(packed).read_all().to_pandas()
    pd.testing.assert_frame_equal(back, rows)


def test_assets_have_states_of_their_own(spark, tmp_dir):
    """Two assets in one stream, told apart by a message column (here the folder); each sees its own readings only."""
    rows = [r.asDict() for r in O.drop_incomplete(sensor_table(spark, SF_SMALL)).orderBy("ts").limit(400).collect()]
    for k, part in enumerate((rows[:200], rows[200:])):
        for asset in (0, 1):
            os.makedirs(folder := os.path.join(tmp_dir, "src", f"asset={asset}"), exist_ok=True)
            write_file(folder, k, part[asset::2])
    read = spark.readStream.schema("value string, asset int").option("maxFilesPerTrigger", 2).text(os.path.join(tmp_dir, "src"))
    stream_score(read, os.path.join(tmp_dir, "preds"), os.path.join(tmp_dir, "ckpt"), fixed_model().with_threshold(5.0), "run", "0 seconds", "asset").awaitTermination()
    got = {r.source_timestamp: r.rolling_mean_TP2 for r in spark.read.parquet(os.path.join(tmp_dir, "preds")).collect()}
    assert len(got) == 399                   # the newest waits for the watermark
    for asset in (0, 1):
        own = [r for r in rows[asset::2] if r["ts"] in got]
        for i, r in enumerate(own):
            frame = [x["TP2"] for x in own[max(0, i - 180):i + 1]]
            assert abs(got[r["ts"]] - sum(frame) / len(frame)) < 1e-9


def test_stream_scoring_agrees_with_batch(spark, tmp_dir):
    sensors = sensor_table(spark, SF_SMALL)
    labeled, n = O.prepare(sensors, block=400)
    fitted = M.train_model(labeled.filter("data_split = 'train'"))
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    bounds = [0, 300, 310, 700, 1000]
    for i in range(len(bounds) - 1):
        write_messages(spark, sensors, src, f"b{i}.json", bounds[i], bounds[i + 1])
    msgs = stream_source(spark, "text", {"maxFilesPerTrigger": "4"}, src)
    stream_score(msgs, os.path.join(tmp_dir, "preds"), os.path.join(tmp_dir, "ckpt"), fitted.model, "stream-run", "0 seconds").awaitTermination()
    preds = spark.read.parquet(os.path.join(tmp_dir, "preds"))
    assert preds.count() == n - 1            # the newest stands above the watermark's millisecond
    batch = M.score(labeled, fitted.model).select(
        F.col("ts").alias("source_timestamp"), F.col("rolling_mean_TP2").alias("b_mean"),
        F.col("anomaly_score").alias("b_score"))
    j = preds.join(batch, "source_timestamp")
    assert j.count() == n - 1
    worst = j.agg(F.max(F.abs(F.col("rolling_mean_TP2") - F.col("b_mean"))),
                  F.max(F.abs(F.col("anomaly_score") - F.col("b_score")))).first()
    assert worst[0] < 1e-9 and worst[1] < 1e-9


def test_run_ingest_job_lands_into_configured_table(spark, tmp_dir):
    from vigil.streaming.ingest import run_ingest
    sensors = sensor_table(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    n = write_messages(spark, sensors, src, "m.json", 0, 120)
    paths = C.Paths(os.path.join(tmp_dir, "store"))
    run_ingest(spark, paths, "text", {"maxFilesPerTrigger": "1"}, src, available_now=True).awaitTermination()
    assert spark.read.parquet(paths.stream).count() == n


def test_ingest_reads_once_counts_and_writes_a_retried_batch_once(spark, tmp_dir, monkeypatch):
    """Killed between the two tables: the micro-batch is done again, and neither table has a row twice."""
    from vigil.streaming import ingest as I
    os.makedirs(src := os.path.join(tmp_dir, "src"))
    good = [json.dumps({"timestamp": f"2024-01-01 00:{i:02d}:00", "TP2": float(i)}) for i in range(30)]
    for k in range(3):
        with open(os.path.join(src, f"b{k}.json"), "w") as f:
            f.write("\n".join([*good[10 * k:10 * k + 10], "{broken", '{"TP2": 1.0}'][:12 if k else 10]) + "\n")
        os.utime(os.path.join(src, f"b{k}.json"), (1_700_000_000 + k * 60,) * 2)
    paths = C.Paths(os.path.join(tmp_dir, "store"))

    def run(**more):
        job = I.run_ingest(spark, paths, "text", {"maxFilesPerTrigger": "1"}, src, available_now=True, **more)
        job.awaitTermination()
        return job
    real = I.commit_once

    def killed(spark_, path, name, write):
        if path == paths.rejects:
            raise RuntimeError("killed")
        return real(spark_, path, name, write)
    with monkeypatch.context() as m:
        m.setattr(I, "commit_once", killed)
        with pytest.raises(StreamingQueryException):
            run()
    assert spark.read.parquet(paths.stream).count() == 20          # of the first two micro-batches
    job = run()
    assert [(c["landed"], c["rejected"]) for c in job.counts()] == [(10, 2), (10, 2)]
    assert job.query.lastProgress.numInputRows == 12                # a message is read once
    assert spark.read.parquet(paths.stream).count() == 30 and spark.read.parquet(paths.rejects).count() == 4
    assert spark.read.parquet(paths.stream).select("timestamp").distinct().count() == 30
    # another checkpoint has micro-batches of its own, with the same numbers
    run(checkpoint=os.path.join(tmp_dir, "other"))
    assert spark.read.parquet(paths.stream).count() == 60


def test_a_replayed_segment_lands_once(spark, tmp_dir):
    from vigil.streaming import ingest as I
    os.makedirs(src := os.path.join(tmp_dir, "src"))
    good = [json.dumps({"timestamp": f"2024-01-01 00:{i:02d}:00", "TP2": float(i)}) for i in range(40)]
    for k, part in enumerate((good[:20], good[10:30], good[:5] + good[:5], good[25:])):
        with open(os.path.join(src, f"b{k}.json"), "w") as f:
            f.write("\n".join(part) + "\n")
        os.utime(os.path.join(src, f"b{k}.json"), (1_700_000_000 + k * 60,) * 2)
    for once, rows in (("1 hour", 40), (None, 65)):
        paths = C.Paths(os.path.join(tmp_dir, f"store{rows}"))
        I.run_ingest(spark, paths, "text", {"maxFilesPerTrigger": "1"}, src, available_now=True, once=once).awaitTermination()
        assert spark.read.parquet(paths.stream).count() == rows
        assert spark.read.parquet(paths.stream).select("timestamp").distinct().count() == 40


def test_replay_takes_the_next_rows_of_each_run(spark, tmp_dir, monkeypatch):
    """Three runs of 300 take 900 different rows in order; one that is killed is done again; the last takes what is left."""
    from vigil.streaming import ingest as I
    sensors = sensor_table(spark, SF_SMALL).withColumn("ts", F.when(F.col("event_id") % 3 == 0, F.col("ts")).otherwise(F.date_trunc("week", "ts").cast("timestamp_ntz")))
    path, order = os.path.join(tmp_dir, "messages"), ["ts", "event_id"]
    assert [I.replay_rows(sensors, path, 300, order) for _ in range(2)] == [300, 300]
    with monkeypatch.context() as m:
        m.setattr("vigil.sources.commit.Folders.rename", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            I.replay_rows(sensors, path, 300, order)
    assert [I.replay_rows(sensors, path, 300, order) for _ in range(4)] == [300, 100, 0, 0]
    sent = spark.read.text(path).select("run", F.get_json_object("value", "$.timestamp").cast("timestamp_ntz").alias("ts"),
                                        F.get_json_object("value", "$.TP2").cast("double").alias("v")).collect()
    ranked = sensors.orderBy(*order).collect()
    for run in range(4):
        assert sorted((r.ts, r.v) for r in sent if r.run == run) == sorted((r.ts, r.TP2) for r in ranked[300 * run:300 * run + 300])
