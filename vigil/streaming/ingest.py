"""Structured Streaming jobs: landing messages (scoring them: ``streaming/scoring.py``).

The original consumer buffers 500 messages in memory and auto-commits
offsets, so a crash can lose the tail. Here the source offsets and the sink
files are tied by the streaming checkpoint (exactly-once file sink), the
batch size is a source option, and a run can drain what is available and stop.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vigil import config as C
from vigil.sources import codec, ingest
from vigil.sources.commit import Folders, commit_once, run_folder
from vigil.sources.ingest import resolve_timestamp


def stream_source(spark: SparkSession, fmt: str, options: dict, path: str | None = None) -> DataFrame:
    """A message stream with a ``value`` column.

    ``kafka``: topic subscription, from the earliest offset unless the options say otherwise; micro-batches are as large
    as the options allow (``maxOffsetsPerTrigger``). ``text``: one JSON message per line in files landing under ``path``.
    """
    reader = spark.readStream.format(fmt).options(**source_options(fmt, options))
    return reader.load() if fmt == "kafka" else reader.load(path)


def source_options(fmt: str, options: dict) -> dict:
    """The reader's options: the caller's own win over the defaults."""
    return {"startingOffsets": "earliest", **options} if fmt == "kafka" else dict(options)


def decoded_messages(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed fields beside the raw text (``raw``) of each message, and the message's columns in ``keep``."""
    raw = messages.withColumn("raw", F.col("value").cast("string"))
    return codec.decode_json(raw, keep=("raw", *keep))


def _good() -> Column:
    return F.col(codec.CORRUPT).isNull() & F.col("timestamp").isNotNull()


def landed_rows(decoded: DataFrame) -> DataFrame:
    """The decoded messages that ``land`` takes."""
    rows = resolve_timestamp(decoded.filter(_good()).drop("raw", codec.CORRUPT))
    return ingest.stamp_ingest(rows, name="ingested_at").withColumn("date", F.to_date("ts"))


def land(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every message that is a JSON object with a timestamp, whatever its other fields: bad ones are NULL."""
    return landed_rows(decoded_messages(messages, keep))


def rejects(messages: DataFrame) -> DataFrame:
    """The messages that ``land`` leaves out: their text and why."""
    return rejected_rows(decoded_messages(messages))


def rejected_rows(decoded: DataFrame) -> DataFrame:
    """The decoded messages that ``land`` leaves out."""
    bad = decoded.filter(~_good())
    reason = F.when(F.col(codec.CORRUPT).isNotNull(), F.lit("not_json")).otherwise(F.lit("no_timestamp"))
    return ingest.stamp_ingest(bad.select("raw", reason.alias("reason")), name="ingested_at")


def message_counts(messages: DataFrame) -> DataFrame:
    """Landed and rejected messages, in one pass."""
    return decoded_messages(messages).agg(F.count_if(_good()).alias("landed"), F.count_if(~_good()).alias("rejected"))


def stream_sink(rows: DataFrame, sink_path: str, checkpoint: str, available_now: bool = False,
                processing_time: str | None = None, partition_by: tuple[str, ...] = ("date",)) -> StreamingQuery:
    """Append micro-batches to a parquet table; offsets and files are tied by the checkpoint (exactly once)."""
    w = (rows.writeStream.format("parquet").outputMode("append")
         .option("path", sink_path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def stream_ingest(messages: DataFrame, sink_path: str, checkpoint: str, available_now: bool = False,
                  processing_time: str | None = None) -> StreamingQuery:
    """Messages to the landed sensor table (decode, stamp, partitioned by date)."""
    return stream_sink(land(messages), sink_path, checkpoint, available_now, processing_time)


def once_within(messages: DataFrame, bound: str, key: str | None = None) -> DataFrame:
    """The messages without those seen before within ``bound`` of their arrival (a producer that sends again, a topic segment
    that is replayed); later ones come through again. ``key`` names a column that identifies a message; where it is null, or without
    one, the whole text does. Time is that of arrival, so no message is too late for the watermark."""
    text = F.coalesce(F.sha2(F.col("value").cast("binary"), 256), F.lit(""))
    told = F.coalesce(F.concat(F.lit("k:"), F.col(key).cast("string")), text) if key else text
    seen = messages.withColumns({"_message": told, "_arrived": F.current_timestamp()}).withWatermark("_arrived", bound)
    return seen.dropDuplicatesWithinWatermark(["_message"]).drop("_message", "_arrived")


COUNTS = "messages"


@dataclass
class IngestRun:
    """The query of an ingest run and its counts."""

    query: StreamingQuery

    def awaitTermination(self) -> None:  # noqa: N802 - the name of Spark's own queries
        self.query.awaitTermination()

    def stop(self) -> None:
        self.query.stop()

    def counts(self) -> list[dict]:
        """Landed and rejected messages of the recent micro-batches that had any."""
        found = [(p.batchId, p.observedMetrics.get(COUNTS)) for p in self.query.recentProgress if p.numInputRows]
        return [{"batch": b, "landed": r["landed"], "rejected": r["rejected"]} for b, r in found if r is not None]


def replay_batch(spark: SparkSession, source_dir: str, sink_path: str, checkpoint: str,
                 files_per_batch: int = 1, keep: tuple[str, ...] = ()) -> StreamingQuery:
    """One scheduled run: drain the landed message files not yet seen, then stop. ``keep`` names columns beside the messages
    (of the folders that hold them)."""
    msgs = stream_source(spark, "text", {"maxFilesPerTrigger": str(files_per_batch)}, source_dir)
    return stream_sink(land(msgs, keep), sink_path, checkpoint, available_now=True)


def run_ingest(spark: SparkSession, paths: C.Paths, source_format: str = "kafka", source_options: dict | None = None,
               source_path: str | None = None, checkpoint: str | None = None, available_now: bool = False,
               processing_time: str | None = None, once: str | None = None) -> IngestRun:
    """The ingest job: topic (or landed message files) to the landed sensor table and the table of rejected messages.

    One query: a message is read and decoded once, its micro-batch is counted while it is decoded, and both tables get
    their part under the micro-batch's number, so a micro-batch that is tried again adds nothing twice. ``once``: see
    ``once_within``.
    """
    ckpt = checkpoint or f"{paths.root}/_checkpoints/ingest"
    name = _query_name(spark, ckpt)
    messages = stream_source(spark, source_format, dict(source_options or {}), source_path)
    decoded = decoded_messages(once_within(messages, once) if once else messages).observe(
        COUNTS, F.count_if(_good()).alias("landed"), F.count_if(~_good()).alias("rejected"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist(StorageLevel.DISK_ONLY)        # decoded once; a lost part is decoded again
        try:
            for path, part, dated in ((paths.stream, landed_rows(rows), True), (paths.rejects, rejected_rows(rows), False)):
                if not part.isEmpty():
                    commit_once(spark, path, f"{name}-{batch_id}", lambda folder, part=part, dated=dated: ingest.write_raw_batches(
                        part, folder, mode="overwrite", partition_by=("date",) if dated else ()))
        finally:
            rows.unpersist()

    w = decoded.writeStream.foreachBatch(handle).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return IngestRun(w.start())


def _query_name(spark: SparkSession, checkpoint: str) -> str:
    """What tells the micro-batches of this checkpoint from those of another one, with the same numbers."""
    folders, path = Folders(spark, checkpoint), f"{checkpoint.rstrip('/')}/_name"
    if not folders.exists(path):
        folders.write(path, uuid.uuid4().hex[:12])
    return folders.read(path)


POSITION = "_position"


def replay_rows(readings: DataFrame, path: str, rows: int, order: list[str]) -> int:
    """One scheduled run: the next ``rows`` readings in the order of ``order`` (which tells all readings apart), as JSON message
    files in the folder ``path``. Returns how many there were; 0 at the end.

    A run's files and its last key become visible together, so a run that is interrupted is done again by the next one.
    Only the order's columns are sorted; the readings themselves are read between two keys.
    """
    spark = readings.sparkSession
    folders = Folders(spark, path)
    done = sorted(int(n.removeprefix("run=")) for n in folders.names(path) if n.startswith("run="))
    key = F.struct(*order)
    left = readings
    if done:
        last = spark.read.parquet(f"{run_folder(path, str(done[-1]))}/{POSITION}").first()
        at = F.struct(*[F.lit(last[c]).cast(readings.schema[c].dataType).alias(c) for c in order])
        left = readings.filter((F.col(order[0]) >= F.lit(last[order[0]]).cast(readings.schema[order[0]].dataType)) & (key > at))
    ends = left.select(*order).orderBy(*order).limit(rows).agg(F.max(key).alias("k"), F.count(F.lit(1)).alias("n")).first()
    if not ends["n"]:
        return 0
    end = F.struct(*[F.lit(ends["k"][c]).cast(readings.schema[c].dataType).alias(c) for c in order])
    part = left.filter((F.col(order[0]) <= F.lit(ends["k"][order[0]]).cast(readings.schema[order[0]].dataType)) & (key <= end))

    def write(folder: str) -> None:
        fields = part.withColumn("timestamp", F.col("ts").cast("string")).select("timestamp", *C.ANALOGUE_COLS, *C.DIGITAL_COLS)
        codec.encode_json(fields).select("value").write.text(folder)
        kinds = T.StructType([readings.schema[c] for c in order])
        spark.createDataFrame([tuple(ends["k"])], kinds).coalesce(1).write.parquet(f"{folder}/{POSITION}")

    commit_once(spark, path, str(done[-1] + 1 if done else 0), write)
    return int(ends["n"])
