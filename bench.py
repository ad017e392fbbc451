"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is forced with a no-op write (full execution, no collect to the
driver). ``prepare`` is the shared clean + index + rolling-window + split step;
``batch_job`` is the whole job (train, evaluate, score, append) end to end.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from vigil import config as C  # noqa: E402
from vigil.plans import catalog as K  # noqa: E402
from vigil.plans.batch import run_batch  # noqa: E402
from vigil.session import build_session  # noqa: E402
from vigil.sources import codec, ingest  # noqa: E402
from vigil.sources.fixture import raw_text_table, sensor_table  # noqa: E402
from vigil.streaming.ingest import replay_batch  # noqa: E402

HEADLINE = ["engineer_features", "temporal_split", "scale_features", "anomaly_score", "fit_threshold", "score",
            "evaluation_report", "fault_breakdown", "score_distribution", "cluster_quality", "coerce_sensor_rows",
            "validate_schema", "decode_json", "recent_sensor_slice", "latest_n", "dashboard_kpis", "recent_alerts"]


def force(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="vigil-bench-", dir="/tmp")
    spark = build_session(f"local[{cpus}]", app="vigil-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g", "spark.local.dir": scratch})
    times = {}
    t0 = time.time()
    pr = K.prepared(spark, sf_dir)
    force(pr.labeled)
    times["prepare"] = time.time() - t0
    t = time.time()
    K.trained(spark, sf_dir)
    times["train_model"] = time.time() - t
    for name in HEADLINE:
        t = time.time()
        force(K.QUERIES[name](spark, sf_dir))
        times[name] = time.time() - t
    t = time.time()
    paths = C.Paths(os.path.join(scratch, "store"))
    res = run_batch(spark, sensor_table(spark, sf_dir).drop("asset_id"), paths, run_id="bench",
                    processed_at=F.current_timestamp())
    times["batch_job"] = time.time() - t
    # Inputs for the two ingest paths, written before timing: CSV text files and
    # JSON message files derived from the sf table (whole table, 8 files each).
    csv_dir, msg_dir = os.path.join(scratch, "csv"), os.path.join(scratch, "messages")
    raw_text_table(spark, sf_dir).drop("event_id").repartition(8).write.option("header", True).csv(csv_dir)
    msgs = codec.encode_json(sensor_table(spark, sf_dir).withColumn("timestamp", F.col("ts").cast("string"))
                             .drop("ts", "asset_id", "event_id"))
    msgs.repartition(8).write.text(msg_dir)
    t = time.time()
    load = ingest.load_raw(spark, csv_dir, os.path.join(scratch, "raw"), drop=True)
    times["csv_bulk_load"] = time.time() - t
    t = time.time()
    replay_batch(spark, msg_dir, os.path.join(scratch, "landed"), os.path.join(scratch, "ckpt-ingest"),
                 files_per_batch=8).awaitTermination()
    times["stream_ingest"] = time.time() - t
    landed = spark.read.parquet(os.path.join(scratch, "landed")).count()
    total = time.time() - t0
    rows = res.records
    print(json.dumps({"metric": "total_time", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()},
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "rows": rows, "batch_job_rows_per_sec": round(rows / times["batch_job"], 1),
                      "csv_load_rows_per_sec": round(load["inserted"] / times["csv_bulk_load"], 1),
                      "stream_ingest_rows_per_sec": round(landed / times["stream_ingest"], 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
