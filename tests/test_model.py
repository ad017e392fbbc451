"""Scaling, clustering, scoring, thresholds, rules, persistence and report invariants."""

import math
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil import config as C
from vigil.functions import columns as X
from vigil.operators import model as M
from vigil.operators import ordered as O
from vigil.operators import report as R
from vigil.plans.fixture_model import fixed_model
from vigil.sources.fixture import sensor_table


@pytest.fixture(scope="module")
def labeled(spark):
    lab, n = O.prepare(sensor_table(spark, SF_SMALL), block=400)
    return lab.cache()


@pytest.fixture(scope="module")
def fitted(labeled):
    return M.train_model(labeled.filter("data_split = 'train'"))


def test_scaler_matches_train_moments(spark, labeled, fitted):
    train = labeled.filter("data_split = 'train'")
    row = train.agg(*[F.avg(c).alias("m_" + c) for c in C.EXTENDED_COLS],
                    *[F.stddev_samp(c).alias("s_" + c) for c in C.EXTENDED_COLS]).first()
    for i, c in enumerate(C.EXTENDED_COLS):
        assert math.isclose(fitted.model.mean[i], row["m_" + c], rel_tol=1e-9, abs_tol=1e-12)
        assert math.isclose(fitted.model.std[i], row["s_" + c], rel_tol=1e-9, abs_tol=1e-12)


def test_threshold_is_mean_plus_three_sigma(labeled, fitted):
    scored = M.anomaly_scores(labeled.filter("data_split = 'train'"), fitted.model)
    st = M.threshold_stats(scored).first()
    assert math.isclose(fitted.model.threshold, st.score_mean + 3.0 * st.score_std, rel_tol=1e-12)
    assert fitted.model.k == C.KMEANS_K and len(fitted.model.centers[0]) == len(C.EXTENDED_COLS)


def test_score_is_distance_to_nearest_center(labeled, fitted):
    m = fitted.model
    rows = M.score(labeled.filter("data_split = 'test'"), m).limit(50).collect()
    for r in rows:
        z = [0.0 if s == 0 else (r[f] - mu) / s for f, mu, s in zip(m.features, m.mean, m.std)]
        d = [math.sqrt(sum((a - b) ** 2 for a, b in zip(z, c))) for c in m.centers]
        assert r.cluster == d.index(min(d))
        assert math.isclose(r.anomaly_score, min(d), rel_tol=1e-9)
        assert r.is_anomaly == (r.anomaly_score > m.threshold)


def test_mllib_assignment_agrees(labeled, fitted):
    test = labeled.filter("data_split = 'test'")
    ours = M.score(test, fitted.model).select("event_id", "cluster")
    theirs = fitted.kmeans.transform(fitted.pipeline.transform(test)).select("event_id", F.col("cluster").alias("k"))
    diff = ours.join(theirs, "event_id").filter(F.col("cluster") != F.col("k")).count()
    assert diff == 0


def test_rules_first_match_and_edges(spark):
    rows = [(7.9, 30.0, 95.0, 0.1), (8.0, 25.0, 90.0, 0.5), (8.0, 25.1, 95.0, 0.1), (9.0, 1.0, 90.1, 0.1),
            (9.0, 1.0, 1.0, 0.49)]
    df = spark.createDataFrame(rows, "TP2 double, Motor_current double, Oil_temperature double, DV_pressure double")
    got = [r[0] for r in df.select(X.fault_label()).collect()]
    assert got == ["LOW_COMPRESSOR_PRESSURE", "GENERAL_ANOMALY", "HIGH_MOTOR_CURRENT", "OVERHEATING",
                   "VALVE_PRESSURE_DROP"]


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(5.0, 9.0, 1.0, 1.0, 1.0), (5.1, 9.0, 1.0, 1.0, 1.0)],
                               "anomaly_score double, TP2 double, Motor_current double, Oil_temperature double, "
                               "DV_pressure double")
    got = [(r.is_anomaly, r.fault_hint) for r in M.label(df, 5.0).collect()]
    assert got == [(False, "NORMAL"), (True, "GENERAL_ANOMALY")]


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (4.0, 3.0)], "a double, b double")
    pipe = M.fit_scaler(df, ["a", "b"])
    assert pipe.stages[-1].std.toArray()[1] == 0.0
    m = M.AnomalyModel(["a", "b"], list(pipe.stages[-1].mean.toArray()), list(pipe.stages[-1].std.toArray()), [])
    z = M.scale_features(df, m).select(M.SCALED_PREFIX + "b").collect()
    assert all(r[0] == 0.0 for r in z)


def test_save_load_roundtrip(spark, fitted, tmp_dir):
    path = os.path.join(tmp_dir, "model")
    assert M.load_model(spark, path) is None
    M.save_model(spark, fitted, path)
    back = M.load_model(spark, path)
    assert back is not None and back.model == fitted.model
    assert M.load_model(spark, path, features=C.ANALOGUE_COLS) is None     # other feature list: retrain


def test_report_invariants(labeled):
    t = labeled.filter("data_split = 'test'")
    lab = M.label(M.anomaly_scores(t, fixed_model()), 3.0)
    ov = R.dataset_overview(lab, 3.0).first()
    assert ov.normal_records + ov.anomaly_records == ov.total_records == t.count()
    sizes = R.cluster_quality(lab).collect()
    assert sum(r["size"] for r in sizes) == ov.total_records
    fb = R.fault_breakdown(lab).collect()
    assert sum(r["count"] for r in fb) == ov.anomaly_records
    assert math.isclose(sum(r.pct for r in fb), 100.0, rel_tol=1e-9) or not fb
    wcss = R.wcss_proxy(lab).first().wcss_proxy
    total = lab.agg(F.sum("anomaly_score")).first()[0]
    assert math.isclose(wcss, total, rel_tol=1e-9)
    rep = R.evaluation_report(lab, 3.0)
    assert set(r.section for r in rep.select("section").distinct().collect()) >= {
        "overview", "score_distribution", "class_separation", "cluster_quality", "fault_breakdown",
        "sensor_breaches", "quality_checks"}


def test_no_anomalies_gives_null_separation(labeled):
    t = labeled.filter("data_split = 'test'")
    lab = M.label(M.anomaly_scores(t, fixed_model()), 1e9)
    cs = R.class_separation(lab, 1e9).first()
    assert cs.anomaly_mean is None and cs.gap is None and cs.verdict == "NO_ANOMALIES"
    assert R.fault_breakdown(lab).count() == 0


def test_single_row_cluster_std_zero(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (1, 4.0)], "cluster int, anomaly_score double")
    got = {r.cluster: r.std_dist for r in R.cluster_quality(df).collect()}
    assert got[0] == 0.0 and got[1] > 0
