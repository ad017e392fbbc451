"""CSV ingest, coercion, timestamp resolution, load modes, JSON codec, schema validation."""

import csv
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from vigil import config as C
from vigil.sources import codec, ingest, validate


def py_float(v):
    try:
        return float(v)
    except (TypeError, ValueError):
        return None


def py_int(v):
    try:
        return int(float(v))
    except (TypeError, ValueError, OverflowError):     # the original would raise on inf; NULL here
        return None


ROWS = [
    {"timestamp": "2020-02-01 00:00:00", "TP2": "9.5", "TP3": "9.1", "COMP": "1", "LPS": "0"},        # normal
    {"timestamp": "   ", "TP2": "9.5"},                                                               # blank ts
    {"timestamp": "2020-02-01 00:00:10", "TP2": "abc", "H1": "1.0d", "COMP": "1.0"},                 # text, float in digital
    {"timestamp": "2020-02-01 00:00:20", "TP2": "nan", "TP3": "inf", "H1": "1_0", "LPS": "inf"},
    {"timestamp": " 2020-02-01 00:00:30 ", "TP2": " 7.25 ", "DV_pressure": "-1e-3", "MPG": "-0.9"},
    {"timestamp": "2020-02-01 00:00:40", "TP2": "", "Towers": "1_1", "Oil_level": "2.5e0"},
]


def write_csv(path, rows, header_ts="timestamp", extra=True):
    cols = [header_ts] + C.ANALOGUE_COLS + [c for c in C.DIGITAL_COLS if c != "Caudal_impulses"]  # one missing column
    if extra:
        cols.append("extra")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.csv"), "w", newline="") as f:
        w = csv.DictWriter(f, fieldnames=cols)
        w.writeheader()
        for r in rows:
            rr = {k: v for k, v in r.items()}
            if header_ts != "timestamp":
                rr[header_ts] = rr.pop("timestamp")
            rr.setdefault("extra", "x")
            w.writerow({k: rr.get(k, "") for k in cols})
    return cols


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b


@pytest.mark.parametrize("header_ts", ["timestamp", "Timestamp"])
def test_coerce_matches_python_semantics(spark, tmp_dir, header_ts):
    path = os.path.join(tmp_dir, "csv")
    write_csv(path, ROWS, header_ts)
    got = ingest.coerce_sensor_rows(ingest.read_sensor_csv(spark, path)).collect()
    assert len(got) == len(ROWS)
    for row, g in zip(ROWS, got):
        ts = row["timestamp"].strip()
        assert g["timestamp"] == (ts or None)
        for c in C.ANALOGUE_COLS:
            assert same(g[c], py_float(row.get(c, ""))), (c, row.get(c), g[c])
        for c in C.DIGITAL_COLS:
            assert same(g[c], py_int(row.get(c, "") if c != "Caudal_impulses" else None)), (c, row.get(c), g[c])


def test_resolve_and_counts(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    write_csv(path, ROWS)
    coerced = ingest.coerce_sensor_rows(ingest.read_sensor_csv(spark, path))
    counts = ingest.ingest_counts(coerced).first()
    assert (counts.inserted, counts.skipped) == (5, 1)
    kept = ingest.resolve_timestamp(coerced)
    assert kept.count() == 5 and kept.filter(F.col("ts").isNull()).count() == 0


def test_load_modes_skip_and_drop(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    write_csv(path, ROWS)
    target = os.path.join(tmp_dir, "raw")
    first = ingest.load_raw(spark, path, target)
    assert first["loaded"] and first["inserted"] == 5
    again = ingest.load_raw(spark, path, target)                   # non-empty target: skipped
    assert not again["loaded"]
    assert ingest.read_raw(spark, target).count() == 5
    dropped = ingest.load_raw(spark, path, target, drop=True)      # replace
    assert dropped["loaded"]
    raw = ingest.read_raw(spark, target)
    assert raw.count() == 5 and "_loaded_at" in raw.columns and "date" in raw.columns


def test_json_roundtrip_and_bad_records(spark):
    good = {"timestamp": "2020-02-01 00:00:00", "TP2": 9.5, "COMP": 1.0, "LPS": None, "MPG": 1}
    msgs = [json.dumps(good), "{not json", json.dumps({"timestamp": "t", "TP2": "abc"}),
            json.dumps({"timestamp": "t2", "Motor_current": None})]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    out = codec.decode_json(df).collect()
    assert out[0]["TP2"] == 9.5 and out[0]["COMP"] == 1 and out[0]["LPS"] is None and out[0]["MPG"] == 1
    assert out[0][codec.CORRUPT] is None
    assert out[1][codec.CORRUPT] is not None                     # not JSON
    assert out[2][codec.CORRUPT] is None and out[2]["timestamp"] == "t" and out[2]["TP2"] is None    # text in a number
    assert out[3][codec.CORRUPT] is None and out[3]["Motor_current"] is None


def test_encode_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, 2.5)], "event_id long, TP2 double, TP3 double")
    v = json.loads(codec.encode_json(df, key="event_id").first()["value"])
    assert v == {"TP2": None, "TP3": 2.5}


def test_validate_schema_warns_not_rejects(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    write_csv(path, ROWS)
    coerced = ingest.coerce_sensor_rows(ingest.read_sensor_csv(spark, path))
    validated = validate.validate_schema(coerced)
    assert validated.count() == len(ROWS)
    counts = dict(validate.violation_counts(validated).collect())
    assert counts["timestamp:required"] == 1
    assert counts["Caudal_impulses:not_int"] == len(ROWS)             # missing column
    assert counts["TP2:not_double"] == 2                                # "abc" and "" (nan is a double)


def test_publish_writes_json_values(spark, tmp_dir):
    df = spark.createDataFrame([("2020-01-01 00:00:00", 1.5, 1)], "timestamp string, TP2 double, COMP int")
    out = os.path.join(tmp_dir, "topic")
    codec.publish(df, {"path": out}, fmt="parquet")
    back = spark.read.parquet(out).collect()
    assert len(back) == 1 and json.loads(back[0].value) == {"timestamp": "2020-01-01 00:00:00", "TP2": 1.5, "COMP": 1}


def test_prediction_rules(spark):
    df = spark.createDataFrame([(None, 1.0, True), (None, None, None)],
                               "source_timestamp timestamp, anomaly_score double, is_anomaly boolean")
    counts = dict(validate.violation_counts(validate.validate_schema(df, validate.PREDICTION_RULES)).collect())
    assert counts["source_timestamp:required"] == 2 and counts["anomaly_score:required"] == 1
    assert counts["processed_at:required"] == 2


def test_rule_counts_equal_exploded_counts(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    write_csv(path, ROWS)
    coerced = ingest.coerce_sensor_rows(ingest.read_sensor_csv(spark, path))
    a = dict(validate.violation_counts(validate.validate_schema(coerced)).collect())
    b = dict(validate.rule_counts(coerced).collect())
    assert a == b


def test_producer_stamps_time_only_when_column_missing(spark, tmp_dir):
    with_ts = spark.createDataFrame([("2020-01-01 00:00:00", "9.5", "1.0")], "timestamp string, TP2 string, COMP string")
    no_ts = spark.createDataFrame([("9.5", "1")], "TP2 string, COMP string")
    now = F.lit("2030-01-01T00:00:00")
    a = json.loads(codec.producer_messages(with_ts, now).first().value)
    b = json.loads(codec.producer_messages(no_ts, now).first().value)
    assert a["timestamp"] == "2020-01-01 00:00:00" and a["TP2"] == 9.5 and a["COMP"] == 1
    assert b["timestamp"] == "2030-01-01T00:00:00" and b["TP3"] is None
    # the loader, by contrast, skips rows without a timestamp
    assert ingest.ingest_counts(ingest.coerce_sensor_rows(no_ts)).first().skipped == 1
