"""Driver contract: entry runs, every query has an oracle or is a known rows-only query, and a
sample of queries equals its DuckDB oracle on sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from vigil.plans.catalog import QUERIES

SAMPLE = ["engineer_features", "temporal_split", "coerce_sensor_rows", "validate_schema", "anomaly_score",
          "fit_threshold", "evaluation_report", "recent_sensor_slice", "recent_alerts", "dashboard_kpis",
          "table_summary", "decode_json", "encode_json", "stream_ingest", "run_batch", "run_checks", "dashboard", "last_alerts",
          "load_model", "score", "fit_kmeans", "train_model", "sample_record", "cap_rows"]


def norm(row, order):
    out = []
    for i in order:
        v = row[i]
        out.append("nan" if isinstance(v, float) and math.isnan(v) else repr(round(v, 6)) if isinstance(v, float)
                   else str(v))
    return "|".join(out)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"event_id", "cluster", "anomaly_score", "is_anomaly", "fault_hint"} <= set(df.columns)


def test_every_query_is_checked():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)           # every sensor query has its SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{os.path.join(SF_SMALL, 'events.parquet')}')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted(norm(tuple(r), sorted(range(len(cols)), key=lambda i: cols[i])) for r in df.collect())
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = sorted(norm(r, sorted(range(len(ocols)), key=lambda i: ocols[i])) for r in res.fetchall())
    assert sorted(cols) == sorted(ocols)
    assert got == want
