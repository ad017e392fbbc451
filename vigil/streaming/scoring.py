"""Scoring a stream of readings with keyed state.

Policy. A reading waits in the state of its key until the watermark (the newest reading time seen, less ``delay``) has
passed it; then it is scored with the 180 readings of its key that stand before it by reading time. So readings may arrive
in any order within the delay and get the features that the batch job gives them. A reading that arrives when the
watermark has passed it is late: it is left out and counted (``late_rows``); the batch job scores it. Readings behind the
last watermark stay in the state for the next run.

The state of a key (its newest 180 scored readings and those that wait) is versioned in the checkpoint folder with the
offsets; a lost one stops the query. Its size is bounded by the frame and by what a key sends within the delay. Keys are
spread over the tasks; one key's readings of a micro-batch go to one task, so the source's batch size bounds that.

Spark hands a key's readings over in parts, and the whole state again with each part, so the parts are large
(``PART_ROWS``) and the rows that wait are packed small.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vigil import config as C
from vigil.functions import columns as X
from vigil.functions.frames import frame_stats
from vigil.operators import model as M
from vigil.operators import ordered as O
from vigil.operators import output as P
from vigil.session import ship
from vigil.streaming.ingest import land, stream_sink

SCORE_COLS = ["ts"] + C.ANALOGUE_COLS + C.DIGITAL_COLS
STATE = "rings array<array<double>>, waiting binary"        # newest values of each rolled column; rows that wait (Arrow stream)
PART_ROWS = 1_000_000               # readings of a key that are handed over with one copy of its state
PART_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def large_parts(spark: SparkSession):
    """Streams that start inside hand their readings over in parts of ``PART_ROWS`` at least (0: not parted at all)."""
    kept = spark.conf.get(PART_CONF)
    spark.conf.set(PART_CONF, str(max(PART_ROWS, int(kept)) if int(kept) > 0 else kept))
    try:
        yield
    finally:
        spark.conf.set(PART_CONF, kept)


def packed_rows(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def in_order(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows by reading time; the other columns tell apart those of one time."""
    at = rows["ts"].to_numpy()
    order = np.argsort(at, kind="stable")
    again = at[order][1:] == at[order][:-1]
    tied = np.append(again, False) | np.append(False, again) if len(rows) else np.zeros(0, bool)
    if tied.any():
        spots = order[tied]
        order[tied] = spots[np.lexsort([rows[c].to_numpy()[spots] for c in reversed(SCORE_COLS)])]
    return rows.iloc[order].reset_index(drop=True)


def rolling_stream(rows: DataFrame, key: str, delay: str, preceding: int = C.ROLLING_PRECEDING) -> DataFrame:
    """Complete readings with the rolling columns, each once the watermark has passed it. ``rows`` is a stream with ``key``, ``ts``
    and the sensor columns."""
    ship(rows.sparkSession)
    rolled = O.ROLLING_OUTPUTS
    names = [n for pair in rolled.values() for n in pair]
    # a watermark needs an instant: the reading time, which has no zone, as if it were UTC, whatever the session's zone is
    instant = F.expr("timestamp_micros(timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts))")
    complete = O.drop_incomplete(rows.select(key, *SCORE_COLS)).filter(F.col("ts").isNotNull()).withColumn("_at", instant).withWatermark("_at", delay)
    kind = complete.schema[key].dataType.simpleString()
    fields = ", ".join([f"`{key}` {kind}", *(f"`{f.name}` {f.dataType.simpleString()}" for f in complete.select(*SCORE_COLS).schema),
                        *(f"`{n}` double" for n in names)])

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rings, waiting = state.get if state.exists else ([[] for _ in rolled], None)
        parts = [] if waiting is None else [pa.ipc.open_stream(waiting).read_all().to_pandas()]
        if not state.hasTimedOut:
            parts += [f[SCORE_COLS] for f in frames]
        rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
        passed = state.getCurrentWatermarkMs()
        micros = rows["ts"].astype("datetime64[us]").astype("int64")
        due = in_order(rows[micros <= passed * 1000])
        rest = rows[micros > passed * 1000]
        out, kept = due.copy(), []
        for (col, (mean, std)), ring in zip(rolled.items(), rings, strict=True):
            values = np.concatenate([np.array(ring, np.float64), due[col].to_numpy(np.float64)])
            if len(due):
                out[mean], out[std] = frame_stats(values, len(due), preceding)
            kept.append(values[-preceding:].tolist())
        state.update((kept, packed_rows(rest) if len(rest) else None))
        if len(rest):
            # the state is called again when the watermark is beyond this, whether the key sends or not
            state.setTimeoutTimestamp(max(passed + 1, int(micros[rest.index].min()) // 1000))
        if len(due):
            out.insert(0, key, group[0])
            yield out

    return complete.groupBy(key).applyInPandasWithState(step, fields, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def score_stream(rows: DataFrame, model: M.AnomalyModel, run_id: str, delay: str, key: str | None = None) -> DataFrame:
    """Predictions of a stream of readings; without a key the table is one asset."""
    keyed = rows if key else rows.withColumn("_asset", F.lit(0))
    rolled = rolling_stream(keyed, key or "_asset", delay).drop("_asset")
    featured = O.fill_zero(rolled.select("*", *X.derived_columns()))
    return P.predictions(M.score(featured, model), model.threshold, F.current_timestamp(), run_id, "stream")


def stream_score(messages: DataFrame, predictions_path: str, checkpoint: str, model: M.AnomalyModel, run_id: str,
                 delay: str = "10 minutes", key: str | None = None, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Messages to the predictions table, exactly once. ``key`` names a column of ``messages`` that tells assets apart (a topic's
    message key), ``delay`` how long a reading may be on its way."""
    preds = score_stream(land(messages, (key,) if key else ()), model, run_id, delay, key)
    dated = preds.withColumns({"processed_date": F.to_date("processed_at"), "date": F.to_date("source_timestamp")})
    with large_parts(messages.sparkSession):
        return stream_sink(dated, predictions_path, checkpoint, available_now, processing_time, ("processed_date", "date"))


def late_rows(query: StreamingQuery) -> int:
    """Readings that the query left out as late, of its recent micro-batches."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
