"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

All read the driver's tables through the fixture views. The prepared table
(clean, indexed, featurized, split) is built once per session and table
folder, written as parquet under the shared checkpoint folder and shared by
the queries. Sinks, streams and jobs are registered as round trips through
scratch folders under the same shared folder. Doubles are rounded to 6 places
so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.ml.functions import vector_to_array

from vigil import config as C
from vigil.functions import columns as X
from vigil.operators import ghost as G
from vigil.operators import model as M
from vigil.operators import ordered as O
from vigil.operators import output as P
from vigil.operators import partials as D
from vigil.operators import report as R
from vigil.operators import serve as S
from vigil.plans.batch import run_batch, run_checks
from vigil.plans.fixture_model import fixed_model
from vigil.session import scratch_path, write_table
from vigil.sources import codec, fixture, ingest, sinks, validate, zones
from vigil.sources.commit import current_version
from vigil.streaming.ingest import replay_batch, replay_rows, run_ingest, stream_source
from vigil.streaming.scoring import stream_score

PLACES = 6
CAP = 500                                   # rows that the cap_rows query asks for
STREAM_FILES = 14                           # message files of the stream_score query, and how long a message may be on its way
STREAM_DELAY = "3 days"
REPLAY_RUNS = 12                            # scheduled runs of the replay_batch query
RUN_ID = "fixture-run"
THRESHOLDS = [3.0, 6.0, 6.2, 9.75, 15.0]     # of the queries on partial results: at ends of bands and inside
PROCESSED_AT = "2024-02-01 00:00:00"
ALERT_AS_OF = "2024-02-01 00:05:00"
SENSOR_COLS = ["event_id", "ts", "asset_id"] + C.ANALOGUE_COLS + C.DIGITAL_COLS
FEATURE_OUT = SENSOR_COLS + ["row_idx"] + C.DERIVED_COLS + C.ROLLING_COLS


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


@dataclass
class Prepared:
    sensors: DataFrame
    clean: DataFrame
    labeled: DataFrame          # featured + data_split
    n: int


_MEMO: dict = {}


def _key(spark: SparkSession, sf_dir: str, what: str):
    return (spark.sparkContext.applicationId, sf_dir, what)


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    k = _key(spark, sf_dir, "prepared")
    if k not in _MEMO:
        sensors = fixture.sensor_table(spark, sf_dir)
        clean = O.drop_incomplete(sensors)
        featured, rolled = G.engineer_rows(clean)
        labeled = write_table(O.temporal_split(featured, rolled.n), "featured", ("data_split",))  # window once
        rolled.release()
        _MEMO[k] = Prepared(sensors, clean, labeled, rolled.n)
    return _MEMO[k]


def indexed(spark: SparkSession, sf_dir: str) -> O.Indexed:
    k = _key(spark, sf_dir, "indexed")
    if k not in _MEMO:
        _MEMO[k] = O.row_index(prepared(spark, sf_dir).clean)
    return _MEMO[k]


def fixed_scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, float]:
    """All rows scored with the fixed model; threshold fitted on the train split."""
    k = _key(spark, sf_dir, "fixed")
    if k not in _MEMO:
        pr = prepared(spark, sf_dir)
        scored = M.anomaly_scores(pr.labeled, fixed_model())
        thr = M.fit_threshold(scored.filter(F.col("data_split") == "train"))
        _MEMO[k] = (M.label(scored, thr), thr)
    return _MEMO[k]


def fixed_test(spark, sf_dir) -> tuple[DataFrame, float]:
    lab, thr = fixed_scored(spark, sf_dir)
    return lab.filter(F.col("data_split") == "test"), thr


def fixed_predictions(spark, sf_dir) -> DataFrame:
    lab, thr = fixed_scored(spark, sf_dir)
    demo = lab.filter(F.col("data_split") == "demo")
    return P.predictions(demo, thr, ntz(PROCESSED_AT), RUN_ID)


def trained(spark, sf_dir) -> M.Fitted:
    k = _key(spark, sf_dir, "trained")
    if k not in _MEMO:
        pr = prepared(spark, sf_dir)
        _MEMO[k] = M.train_model(pr.labeled.filter(F.col("data_split") == "train"))
    return _MEMO[k]


def raw_text(spark, sf_dir) -> DataFrame:
    return fixture.raw_text_table(spark, sf_dir)


def coerced(spark, sf_dir) -> DataFrame:
    return ingest.coerce_sensor_rows(raw_text(spark, sf_dir), keep=("event_id",))


def spoiled(event_id):
    """The column ``value`` with some messages broken: 3 of 50 no JSON, 7 of 50 text in a number, 11 of 50 a blank time."""
    value, k = F.col("value"), event_id % 50
    return (F.when(k == 3, F.concat(F.lit("{"), F.substring(value, 3, 40)))
            .when(k == 7, F.replace(value, F.lit('"TP3":'), F.lit('"TP3":"x","was":')))
            .when(k == 11, F.regexp_replace(value, '"timestamp":"[^"]*"', '"timestamp":" "')).otherwise(value))


# ---------------------------------------------------------------------------
# 2.1 sources, sinks, ingest
# ---------------------------------------------------------------------------
def q_read_raw(spark, d):
    return rounded(prepared(spark, d).sensors.select(*SENSOR_COLS))


def q_coerce_sensor_rows(spark, d):
    return rounded(coerced(spark, d).drop("timestamp"))


def q_resolve_timestamp(spark, d):
    rows = ingest.resolve_timestamp(coerced(spark, d))
    return rows.select("event_id", F.col("timestamp").try_cast("timestamp_ntz").alias("ts"))


def q_ingest_counts(spark, d):
    return ingest.ingest_counts(coerced(spark, d))


def q_stamp_ingest(spark, d):
    rows = ingest.stamp_ingest(ingest.resolve_timestamp(coerced(spark, d)), ntz(PROCESSED_AT))
    return rows.select("event_id", "_loaded_at")


def q_validate_schema(spark, d):
    raw = validate.rule_counts(ingest.stamp_ingest(coerced(spark, d), ntz(PROCESSED_AT))).select(F.lit(C.RAW_TABLE).alias("table_name"), "*")
    preds = validate.rule_counts(fixed_predictions(spark, d), validate.PREDICTION_RULES) \
        .select(F.lit(C.PREDICTIONS_TABLE).alias("table_name"), "*")
    return raw.unionByName(preds)


def q_decode_json(spark, d):
    msgs = codec.encode_json(prepared(spark, d).sensors.drop("ts", "asset_id"), key="event_id")
    out = codec.decode_json(msgs.withColumn("value", spoiled(F.col("key").cast("long"))), keep=("key",))
    return rounded(out.select(F.col("key").cast("long").alias("event_id"), *C.ANALOGUE_COLS, *C.DIGITAL_COLS,
                              F.col(codec.CORRUPT).isNotNull().alias("corrupt")))


def q_encode_json(spark, d):
    """The messages' fields, taken out of the JSON text one by one."""
    msgs = codec.encode_json(prepared(spark, d).sensors.drop("asset_id"), key="event_id")

    def field(name: str, kind: str):
        return F.get_json_object("value", f"$.{name}").try_cast(kind).alias(name)

    return rounded(msgs.select(F.col("key").cast("long").alias("event_id"), field("ts", "timestamp_ntz"),
                               *[field(c, "double") for c in C.ANALOGUE_COLS], *[field(c, "int") for c in C.DIGITAL_COLS]))


# ---------------------------------------------------------------------------
# 2.2 projections, filters, scalar expressions
# ---------------------------------------------------------------------------
def q_drop_incomplete(spark, d):
    return rounded(prepared(spark, d).clean.select(*SENSOR_COLS))


def q_cap_rows(spark, d):
    return O.cap_rows(indexed(spark, d), CAP).df.select("event_id", "row_idx")


def _clean_expr(spark, d, col):
    return rounded(prepared(spark, d).clean.select("event_id", col))


def q_pressure_diff_TP2_TP3(spark, d):
    return _clean_expr(spark, d, X.pressure_diff_tp2_tp3())


def q_pressure_diff_H1_DV(spark, d):
    return _clean_expr(spark, d, X.pressure_diff_h1_dv())


def q_motor_oil_ratio(spark, d):
    return _clean_expr(spark, d, X.motor_oil_ratio())


def q_fill_zero(spark, d):
    return rounded(O.fill_zero(prepared(spark, d).sensors.select(*SENSOR_COLS)))


def q_flag_anomaly(spark, d):
    lab, _ = fixed_scored(spark, d)
    return lab.select("event_id", "data_split", "is_anomaly")


def q_fault_hint(spark, d):
    lab, _ = fixed_scored(spark, d)
    return lab.select("event_id", "is_anomaly", "fault_hint")


def q_sensor_breach_flags(spark, d):
    return prepared(spark, d).clean.select("event_id", *X.breach_flags())


def q_prediction_projection(spark, d):
    return rounded(fixed_predictions(spark, d))


def q_stamp_run(spark, d):
    lab, thr = fixed_scored(spark, d)
    st = P.stamp_run(lab.filter(F.col("data_split") == "demo"), thr, ntz(PROCESSED_AT), RUN_ID, "demo")
    return rounded(st.select("event_id", "threshold_used", "processed_at", "spark_run_id", "data_split"))


def q_recent_sensor_slice(spark, d):
    sensors = prepared(spark, d).sensors.select(*SENSOR_COLS)
    return rounded(S.recent_sensor_slice(sensors, S.newest_time(sensors, "ts"), C.DEFAULT_RECENT_HOURS))


def q_recent_prediction_slice(spark, d):
    preds = fixed_predictions(spark, d)
    return rounded(S.recent_prediction_slice(preds, S.newest_time(preds, "source_timestamp")))


def q_parse_timestamp(spark, d):
    return raw_text(spark, d).select("event_id", S.parse_timestamp(F.col("timestamp")).alias("ts"))


def q_rethreshold(spark, d):
    out = S.rethreshold(fixed_predictions(spark, d), C.DASHBOARD_THRESHOLD)
    return rounded(out.select("source_timestamp", "anomaly_score", "is_anomaly", "fault_hint"))


def q_score_series(spark, d):
    return rounded(S.score_series(fixed_predictions(spark, d)))


def q_anomaly_points(spark, d):
    return rounded(S.anomaly_points(fixed_predictions(spark, d)))


def q_sensor_signals(spark, d):
    return rounded(S.sensor_signals(prepared(spark, d).sensors))


def q_recent_alerts(spark, d):
    return rounded(S.recent_alerts(fixed_predictions(spark, d), ntz(ALERT_AS_OF)))


def q_alert_count(spark, d):
    return S.alert_count(fixed_predictions(spark, d), ntz(ALERT_AS_OF))


# ---------------------------------------------------------------------------
# 2.3 windows and ordered operators
# ---------------------------------------------------------------------------
def _feature(spark, d, col):
    return rounded(prepared(spark, d).labeled.select("event_id", col))


def q_rolling_mean_TP2(spark, d):
    return _feature(spark, d, "rolling_mean_TP2")


def q_rolling_std_TP2(spark, d):
    return _feature(spark, d, "rolling_std_TP2")


def q_rolling_mean_motor(spark, d):
    return _feature(spark, d, "rolling_mean_motor")


def q_rolling_std_motor(spark, d):
    return _feature(spark, d, "rolling_std_motor")


def q_engineer_features(spark, d):
    return rounded(prepared(spark, d).labeled.select(*FEATURE_OUT))


def q_row_index(spark, d):
    return indexed(spark, d).df.select("event_id", "row_idx")


def q_temporal_split(spark, d):
    return prepared(spark, d).labeled.select("event_id", "row_idx", "data_split")


# ---------------------------------------------------------------------------
# 2.4 model operators
# ---------------------------------------------------------------------------
def _test_rows(spark, d):
    return prepared(spark, d).labeled.filter(F.col("data_split") == "test")


def q_assemble_features(spark, d):
    out = M.assembler().transform(_test_rows(spark, d)).select("event_id", vector_to_array("raw_features").alias("v"))
    return rounded(out.select("event_id", *[F.col("v")[i].alias(f"raw_{f}") for i, f in enumerate(C.EXTENDED_COLS)]))


def q_scale_features(spark, d):
    train = prepared(spark, d).labeled.filter(F.col("data_split") == "train")
    pipe = M.fit_scaler(train.select(*C.EXTENDED_COLS))
    sm = pipe.stages[-1]
    scaler = M.AnomalyModel(list(C.EXTENDED_COLS), list(map(float, sm.mean.toArray())),
                            list(map(float, sm.std.toArray())), [])
    z = M.scale_features(_test_rows(spark, d), scaler)
    return rounded(z.select("event_id", *[F.col(M.SCALED_PREFIX + f).alias(f"z_{f}") for f in C.EXTENDED_COLS]))


def _train_scored(spark, d):
    return M.anomaly_scores(prepared(spark, d).labeled.filter(F.col("data_split") == "train"), trained(spark, d).model)


def q_fit_kmeans(spark, d):
    """What holds for every fit: the clusters share out all train rows, and none is empty."""
    sizes = _train_scored(spark, d).groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.sum("size").alias("train_rows"), F.count(F.lit(1)).alias("clusters"),
                     (F.min("size") > 0).alias("none_empty"))


def q_assign_cluster(spark, d):
    lab, _ = fixed_scored(spark, d)
    return lab.select("event_id", "cluster")


def q_anomaly_score(spark, d):
    lab, _ = fixed_scored(spark, d)
    return rounded(lab.select("event_id", "cluster", "anomaly_score"))


def q_fit_threshold(spark, d):
    lab, _ = fixed_scored(spark, d)
    st = M.threshold_stats(lab.filter(F.col("data_split") == "train"))
    return rounded(st.select("score_mean", "score_std",
                             (F.col("score_mean") + F.lit(C.THRESHOLD_SIGMAS) * F.col("score_std")).alias("threshold")))


def q_train_model(spark, d):
    """What holds for every fit: its size, the scaler's moments, and the threshold from the train scores."""
    m, train = trained(spark, d).model, _train_scored(spark, d)
    i = m.features.index("TP2")
    again = (F.avg("anomaly_score") + F.lit(C.THRESHOLD_SIGMAS) * F.stddev_samp("anomaly_score"))
    return rounded(train.agg(F.lit(m.k).alias("k"), F.lit(len(m.features)).alias("n_features"),
                             F.lit(m.mean[i]).alias("mean_TP2"), F.lit(m.std[i]).alias("std_TP2"),
                             (F.abs(again - F.lit(m.threshold)) < 1e-9).alias("threshold_holds")))


def q_score(spark, d):
    """The whole application of a model (the fixed one) to the test split."""
    _, thr = fixed_scored(spark, d)
    out = M.score(_test_rows(spark, d), fixed_model().with_threshold(thr))
    return rounded(out.select("event_id", "cluster", "anomaly_score", "is_anomaly", "fault_hint"))


def flagship(spark, d):
    """Train on the train split and score the test split."""
    out = M.score(_test_rows(spark, d), trained(spark, d).model)
    return rounded(out.select("event_id", "cluster", "anomaly_score", "is_anomaly", "fault_hint"))


# ---------------------------------------------------------------------------
# 2.5 aggregations and reports (test split, fixed model)
# ---------------------------------------------------------------------------
def q_stage_counts(spark, d):
    pr = prepared(spark, d)
    return R.stage_counts(pr.sensors, pr.clean, pr.labeled)


def q_dataset_overview(spark, d):
    t, thr = fixed_test(spark, d)
    return rounded(R.dataset_overview(t, thr))


def q_score_distribution(spark, d):
    t, _ = fixed_test(spark, d)
    return rounded(R.score_distribution(t))


def q_class_separation(spark, d):
    t, thr = fixed_test(spark, d)
    return rounded(R.class_separation(t, thr))


def q_cluster_quality(spark, d):
    t, _ = fixed_test(spark, d)
    return rounded(R.cluster_quality(t))


def q_wcss_proxy(spark, d):
    t, _ = fixed_test(spark, d)
    return rounded(R.wcss_proxy(t))


def q_fault_breakdown(spark, d):
    t, _ = fixed_test(spark, d)
    return rounded(R.fault_breakdown(t))


def q_sensor_breaches(spark, d):
    t, _ = fixed_test(spark, d)
    return R.sensor_breaches(t)


def q_quality_checks(spark, d):
    t, _ = fixed_test(spark, d)
    return rounded(R.quality_checks(t))


def q_evaluation_report(spark, d):
    t, thr = fixed_test(spark, d)
    return rounded(R.evaluation_report(t, thr))


def q_run_summary(spark, d):
    lab, thr = fixed_scored(spark, d)
    return rounded(R.run_summary(lab.filter(F.col("data_split") == "demo"), thr, RUN_ID))


def q_table_summary(spark, d):
    sensors = prepared(spark, d).sensors
    preds = fixed_predictions(spark, d)
    log = _run_log(spark, d).withColumn("processed_at", ntz(PROCESSED_AT))
    return rounded(R.table_summary(sensors, C.RAW_TABLE, "ts")
                   .unionByName(R.table_summary(preds, C.PREDICTIONS_TABLE, "source_timestamp"))
                   .unionByName(R.table_summary(log, C.RUN_LOG_TABLE, "processed_at")))


def q_freshness_check(spark, d):
    return R.freshness(prepared(spark, d).sensors)


def q_dashboard(spark, d):
    return rounded(S.dashboard(fixed_predictions(spark, d)))


def q_dashboard_kpis(spark, d):
    return rounded(S.dashboard_kpis(fixed_predictions(spark, d)))


def q_fault_distribution(spark, d):
    return S.fault_distribution(fixed_predictions(spark, d))


# ---------------------------------------------------------------------------
# 2.6 sorts, limits, top-k
# ---------------------------------------------------------------------------
def q_latest_n(spark, d):
    return rounded(S.latest_n(prepared(spark, d).sensors.select(*SENSOR_COLS), "ts", C.RECENT_LIMIT))


def q_last_alerts(spark, d):
    return rounded(S.last_alerts(fixed_predictions(spark, d)))


def q_time_bounds(spark, d):
    return S.time_bounds(prepared(spark, d).sensors, "ts")


def q_sample_record(spark, d):
    return rounded(S.sample_record(prepared(spark, d).sensors.select(*SENSOR_COLS), O.ORDER_COLS))


def q_clusters_by_id(spark, d):
    lab, _ = fixed_scored(spark, d)
    return rounded(R.cluster_quality(lab))


def q_faults_by_count(spark, d):
    lab, _ = fixed_scored(spark, d)
    return rounded(R.fault_breakdown(lab))


# ---------------------------------------------------------------------------
# sinks, streams and jobs as round trips: derived rows go through the real sink
# into the shared checkpoint folder and are read back
# ---------------------------------------------------------------------------
def q_write_raw_batches(spark, d):
    path = scratch_path(spark, "raw")
    ingest.write_raw_batches(prepared(spark, d).sensors.select(*SENSOR_COLS), path)
    return rounded(spark.read.parquet(path).select(*SENSOR_COLS))


def q_append_predictions(spark, d):
    path = scratch_path(spark, "predictions")
    for _ in range(2):                                                  # the second attempt of the run adds nothing
        sinks.append_predictions(fixed_predictions(spark, d), path, run_id=RUN_ID)
    return rounded(spark.read.parquet(path).select(*C.PREDICTION_COLS))


def _zoned(spark, d) -> zones.Zoned:
    """The sensor rows landed in two parts; the zone map is from before the second one."""
    path, rows = scratch_path(spark, "zoned"), prepared(spark, d).sensors.select(*SENSOR_COLS)
    first = F.pmod(F.xxhash64("event_id"), F.lit(4)) > 0
    ingest.write_raw_batches(rows.where(first), path)
    zones.refresh_zones(spark, path, "ts")
    ingest.write_raw_batches(rows.where(~first), path)
    return zones.zoned(spark, path, "ts")


def q_zone_summary(spark, d):
    """Bounds, counts and freshness of landed tables from their zone maps."""
    preds = scratch_path(spark, "predictions")
    sinks.append_predictions(fixed_predictions(spark, d), preds, run_id=RUN_ID)
    landed, z = _zoned(spark, d), zones.zoned(spark, preds, "source_timestamp")
    return rounded(zones.table_summary(landed, C.RAW_TABLE, SENSOR_COLS).unionByName(zones.table_summary(z, C.PREDICTIONS_TABLE, C.PREDICTION_COLS)))


def q_zone_recent_slice(spark, d):
    return rounded(zones.recent_slice(_zoned(spark, d)).select(*SENSOR_COLS))


def q_zone_latest_n(spark, d):
    return rounded(zones.latest_n(_zoned(spark, d), C.RECENT_LIMIT).select(*SENSOR_COLS))


def _partials(spark, d) -> str:
    """Partial results of two runs, the second one repeated."""
    path, preds = scratch_path(spark, "partials"), fixed_predictions(spark, d)
    first = F.pmod(F.xxhash64("source_timestamp"), F.lit(3)) > 0
    for run, rows in (("a", preds.where(first)), ("b", preds.where(~first)), ("b", preds.where(~first))):
        D.add_partials(rows, path, run)
    return path


def q_partial_kpis(spark, d):
    """The dashboard's key figures at several thresholds, of all rows and of the last hours, from partial results."""
    path, out = _partials(spark, d), None
    for hours in (None, C.DEFAULT_RECENT_HOURS):
        for t in THRESHOLDS:
            one = D.dashboard_kpis(spark, path, t, hours).select(F.lit(hours).cast("int").alias("hours"), F.lit(t).alias("threshold"), "*")
            out = one if out is None else out.unionByName(one)
    return rounded(out)


def q_partial_faults(spark, d):
    path, out = _partials(spark, d), None
    for t in THRESHOLDS:
        one = D.fault_distribution(spark, path, t).select(F.lit(t).alias("threshold"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def q_save_report(spark, d):
    t, thr = fixed_test(spark, d)
    path = scratch_path(spark, "report")
    sinks.save_report(R.evaluation_report(t, thr), path)
    schema = "section string, key string, metric string, value double, note string"
    return rounded(spark.read.schema(schema).json(current_version(spark, path)))


def q_load_raw(spark, d):
    csv_dir, target = scratch_path(spark, "csv"), scratch_path(spark, "raw")
    raw_text(spark, d).write.option("header", True).csv(csv_dir)      # event_id rides along as an extra column
    ingest.load_raw(spark, csv_dir, target, drop=True, loaded_at=ntz(PROCESSED_AT))
    out = ingest.read_raw(spark, target)
    return rounded(out.select(F.col("timestamp").try_cast("timestamp_ntz").alias("ts"), *C.ANALOGUE_COLS,
                              *C.DIGITAL_COLS, "_loaded_at"))


def _run_log(spark, d):
    lab, thr = fixed_scored(spark, d)
    demo = lab.filter(F.col("data_split") == "demo")
    row = R.run_summary(demo, thr, RUN_ID).first()                   # one row
    path = scratch_path(spark, "run_log")
    for _ in range(2):                                                  # one row for a run id
        sinks.append_run_log(spark, path, RUN_ID, row["records_processed"], row["anomalies_found"], thr, False, "demo")
    return spark.read.parquet(path).drop("run")


def q_append_run_log(spark, d):
    return rounded(_run_log(spark, d).drop("processed_at"))            # a run parameter, not data


def _messages(spark, d, parts: int = 8, clean: bool = False) -> str:
    """The sensor rows as JSON message files (text), the stream source's input; some messages are broken."""
    path = scratch_path(spark, "messages")
    rows = prepared(spark, d).sensors.withColumn("timestamp", F.col("ts").cast("string"))
    msgs = codec.encode_json(rows.drop("ts", "asset_id"), key="event_id")
    if not clean:
        msgs = msgs.withColumn("value", spoiled(F.col("key").cast("long")))
    msgs.select("value").repartition(parts).write.text(path)
    return path


def _landed(spark, path):
    return rounded(spark.read.parquet(path).select("ts", *C.ANALOGUE_COLS, *C.DIGITAL_COLS))


def q_stream_ingest(spark, d):
    src, paths = _messages(spark, d), C.Paths(scratch_path(spark, "store"))
    run_ingest(spark, paths, "text", {}, src, available_now=True).awaitTermination()
    bad = spark.read.parquet(paths.rejects).select("reason")
    return _landed(spark, paths.stream).withColumn("reason", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


def q_stream_once(spark, d):
    """The ingest job over messages of which a part is sent again in later micro-batches: each lands once."""
    src, paths = _messages(spark, d, clean=True), C.Paths(scratch_path(spark, "store"))
    spark.read.text(src).filter(F.xxhash64("value") % 7 == 0).write.mode("append").text(src)
    with state_partitions(spark, 8):
        run_ingest(spark, paths, "text", {"maxFilesPerTrigger": "4"}, src, available_now=True, once="1 day").awaitTermination()
    return _landed(spark, paths.stream)


def q_replay_batch(spark, d):
    """Twelve scheduled runs of as many readings each, in time order, and the landing of what they sent; ``run`` numbers the runs."""
    sensors, src, sink = prepared(spark, d).sensors, scratch_path(spark, "replayed"), scratch_path(spark, "landed")
    per_run = -(-sensors.count() // REPLAY_RUNS)
    while replay_rows(sensors, src, per_run, ["ts", "event_id"]):
        pass
    replay_batch(spark, src, sink, scratch_path(spark, "ckpt"), files_per_batch=4, keep=("run",)).awaitTermination()
    return rounded(spark.read.parquet(sink).select("ts", *C.ANALOGUE_COLS, *C.DIGITAL_COLS, F.col("run").cast("int").alias("run")))


@contextmanager
def state_partitions(spark, n: int):
    """Streams that start inside keep their state in ``n`` parts (a checkpoint keeps that number): few keys need no more."""
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def _arriving(spark, d) -> str:
    """The sensor rows as JSON message files that arrive one after the other, some messages one or five files late."""
    path = scratch_path(spark, "arriving")
    rows = prepared(spark, d).sensors.withColumn("timestamp", F.col("ts").cast("string"))
    n, i = rows.count(), F.col("key").cast("long")
    late = F.when(i % 97 == 5, 5).when(i % 41 == 3, 1).otherwise(0)
    msgs = codec.encode_json(rows.drop("ts", "asset_id"), key="event_id").withColumn(
        "file", F.floor(i * STREAM_FILES / F.lit(n)).cast("int") + late)
    msgs.select("value", "file").repartition("file").write.partitionBy("file").text(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for k in range(STREAM_FILES + 5):                   # the source reads files in the order of their times
        found = jvm.org.apache.hadoop.fs.Path(f"{path}/file={k}/part-*")
        fs = found.getFileSystem(conf)
        for f in fs.globStatus(found) or ():
            fs.setTimes(f.getPath(), 1_700_000_000_000 + 60_000 * k, -1)
    return path


def q_stream_score(spark, d):
    """The stream scorer over messages that arrive in 19 micro-batches, some of them within the allowed delay and some late."""
    _, thr = fixed_scored(spark, d)
    preds = scratch_path(spark, "stream-predictions")
    msgs = stream_source(spark, "text", {"maxFilesPerTrigger": "1"}, _arriving(spark, d))
    with state_partitions(spark, 4):
        stream_score(msgs, preds, scratch_path(spark, "ckpt"), fixed_model().with_threshold(thr), RUN_ID, delay=STREAM_DELAY).awaitTermination()
    return rounded(spark.read.parquet(preds).select("source_timestamp", "anomaly_score", "is_anomaly", "fault_hint",
                                                    "cluster_id", "rolling_mean_TP2", "rolling_mean_motor"))


def q_load_model(spark, d):
    """The fixed model with its threshold, saved and read again; the scores it gives."""
    _, thr = fixed_scored(spark, d)
    path = scratch_path(spark, "model")
    M.save_model(spark, M.Fitted(fixed_model().with_threshold(thr)), path)
    back = M.load_model(spark, path).model
    return rounded(M.score(_test_rows(spark, d), back).select("event_id", "cluster", "anomaly_score", F.lit(back.threshold).alias("threshold")))


def _store(spark, d) -> C.Paths:
    """A store whose raw table came through the CSV load, with the fixed model saved."""
    paths, csv_dir = C.Paths(scratch_path(spark, "store")), scratch_path(spark, "csv")
    rows = prepared(spark, d).sensors.withColumn("timestamp", F.col("ts").cast("string")).drop("ts", "asset_id", "event_id")
    rows.select([F.col(c).cast("string") for c in rows.columns]).write.option("header", True).csv(csv_dir)
    ingest.load_raw(spark, csv_dir, paths.raw, drop=True, loaded_at=ntz(PROCESSED_AT))
    _, thr = fixed_scored(spark, d)
    M.save_model(spark, M.Fitted(fixed_model().with_threshold(thr)), paths.model)
    return paths


def q_run_batch(spark, d):
    """CSV text, load, job: the predictions of the whole chain with a saved model. The run is repeated with its id."""
    paths = _store(spark, d)
    for _ in range(2):
        run_batch(spark, ingest.read_raw(spark, paths.raw), paths, run_id=RUN_ID, processed_at=ntz(PROCESSED_AT))
    return rounded(spark.read.parquet(paths.predictions).select(*C.PREDICTION_COLS))


def q_run_checks(spark, d):
    """Freshness gate, job, alerts over what the job appended."""
    paths = _store(spark, d)
    done = run_checks(spark, paths, ntz(ALERT_AS_OF), job=lambda: run_batch(
        spark, ingest.read_raw(spark, paths.raw), paths, run_id=RUN_ID, processed_at=ntz(PROCESSED_AT)))
    row = (done["landed_rows"], done["job"].records, done["job"].demo_rows, done["alerts"], len(done["shown"]))
    return spark.createDataFrame([row], "landed_rows long, job_rows long, demo_rows long, alerts long, shown long")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
