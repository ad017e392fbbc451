"""Batch job and scheduled checks.

``run_batch``: load, clean, index, featurize, split, train-or-load, evaluate on
the test split, score the demo split, append predictions and a run-log row
(each once per run id: a job that was killed can be run again with its id).
The featurized table is written once to the shared checkpoint folder, so the
model fit, the evaluation and the scoring all read it without recomputing the
window, and a lost executor costs a re-read, not a re-run.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vigil import config as C
from vigil.operators import ghost as G
from vigil.operators import model as M
from vigil.operators import ordered as O
from vigil.operators import output as P
from vigil.operators import report as R
from vigil.operators import serve as S
from vigil.session import drop_path, table_path, write_table
from vigil.sources import ingest, sinks
from vigil.sources.commit import run_folder


@dataclass
class BatchResult:
    run_id: str
    records: int
    train_rows: int
    test_rows: int
    demo_rows: int
    demo_anomalies: int
    threshold: float
    model_loaded_from_cache: bool


def run_batch(spark: SparkSession, sensors: DataFrame, paths: C.Paths, run_id: str | None = None,
              processed_at: Column | None = None, partitions: int | None = None, retrain: bool = False,
              score_split: str = "demo", rolling_method: str = "ghost", order_cols: list[str] | None = None) -> BatchResult:
    """The whole job over a sensor table: as ``load_raw`` or ``run_ingest`` land it, or any with ``ts`` and the sensors.
    Rows are put in order by ``order_cols`` (default: ``operators.ordered.total_order``); ``rolling_method``: ``ghost`` (one
    exchange of the rows), or ``linear`` or ``frame`` of ``engineer_features``."""
    run_id = run_id or str(uuid.uuid4())
    processed_at = processed_at if processed_at is not None else F.current_timestamp()

    clean = O.drop_incomplete(sensors)
    if rolling_method == "ghost":
        featured, indexed = G.engineer_rows(clean, order_cols, partitions)
    else:
        indexed = O.row_index(clean, order_cols, partitions=partitions)
        featured = O.engineer_features(indexed, method=rolling_method)
    featured_path = table_path(spark, "featured")
    try:
        labeled = write_table(O.temporal_split(featured, indexed.n), "featured",
                              ("data_split",), featured_path)
        return _train_evaluate_score(spark, labeled, indexed.n, paths, run_id, processed_at, retrain, score_split)
    finally:
        indexed.release()
        drop_path(spark, featured_path)                  # the job's own intermediate table


def _train_evaluate_score(spark: SparkSession, labeled: DataFrame, n: int, paths: C.Paths, run_id: str,
                          processed_at: Column, retrain: bool, score_split: str) -> BatchResult:
    train_end, test_end = O.split_bounds(n)
    parts = O.split_parts(labeled)

    fitted = None if retrain else M.load_model(spark, paths.model)
    cached = fitted is not None
    if fitted is None:
        fitted = M.train_model(parts["train"])
        M.save_model(spark, fitted, paths.model)
    model = fitted.model

    # Evaluation: one scan of the scored test split (grouping-sets aggregate), nothing cached.
    report = R.evaluation_report(M.score(parts["test"], model), model.threshold)
    sinks.save_report(report.withColumn("spark_run_id", F.lit(run_id)), paths.report)

    # Scoring: the run summary is observed while the predictions are appended (no re-read).
    scored = M.score(parts[score_split], model)
    preds = P.predictions(scored, model.threshold, processed_at, run_id, score_split)
    obs = Observation("run_summary")
    if sinks.append_predictions(preds.observe(obs, F.count(F.lit(1)).alias("records"),
                                              F.count_if(F.col("is_anomaly")).alias("anomalies")), paths.predictions, paths.fmt, run_id):
        summary = obs.get
    else:                                    # an earlier attempt of this run got so far: what it wrote counts
        summary = spark.read.format(paths.fmt).load(run_folder(paths.predictions, run_id)).agg(
            F.count(F.lit(1)).alias("records"), F.count_if(F.col("is_anomaly")).alias("anomalies")).first()
    records, anomalies = int(summary["records"]), int(summary["anomalies"])
    sinks.append_run_log(spark, paths.run_log, run_id, records, anomalies, model.threshold, cached, score_split, fmt=paths.fmt)
    return BatchResult(run_id, n, train_end, test_end - train_end, n - test_end, anomalies, model.threshold, cached)


def run_checks(spark: SparkSession, paths: C.Paths, as_of: Column, job=None) -> dict:
    """Freshness gate, then the job (if given), then alerts over the predictions: order only."""
    landed = ingest.read_raw(spark, paths.stream if ingest.table_exists(spark, paths.stream) else paths.raw, paths.fmt)
    fresh = R.freshness_check(landed)
    result = job() if job is not None else None
    preds = spark.read.format(paths.fmt).load(paths.predictions)
    alerts = S.recent_alerts(preds, as_of).collect()          # at most ALERTS_SHOWN rows
    n_alerts = S.alert_count(preds, as_of).first()["alerts"]
    return {"landed_rows": fresh, "job": result, "alerts": int(n_alerts), "shown": [r.asDict() for r in alerts]}
