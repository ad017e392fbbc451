"""Stream message codec: JSON text <-> typed sensor rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import config as C
from vigil.sources.ingest import coerce_sensor_rows

CORRUPT = "_corrupt_record"


def encode_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as a UTF-8 JSON object in ``value`` (plus an optional ``key``), nulls and microseconds kept."""
    cols = [c for c in df.columns if c != key]
    value = F.to_json(F.struct(*cols), {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                                        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    out = [value.alias("value")]
    if key:
        out.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*out)


def decode_json(messages: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Message text (or bytes) to typed rows, with a ``_corrupt_record`` column for messages that are no JSON object.

    Every field is read as text and coerced as the CSV loader does, so "1.0" survives in a digital field and a bad
    value is NULL in its own field only. Only undecodable messages have ``_corrupt_record`` set (to their text).
    """
    schema = T.StructType(C.MESSAGE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    text = F.col(value_col).cast("string")
    parsed = messages.select(*[F.col(k) for k in keep], text.alias("_text"), F.from_json(
        text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_m"))
    bad = F.when(F.col("_m").isNull(), F.coalesce(F.col("_text"), F.lit(""))).otherwise(F.col(f"_m.{CORRUPT}"))
    flat = parsed.select(*[F.col(k) for k in keep], bad.alias(CORRUPT), *[F.col(f"_m.{f}").alias(f) for f in C.MESSAGE_SCHEMA.names])
    rows = coerce_sensor_rows(flat, keep=(*keep, CORRUPT))
    return rows.select(*keep, "timestamp", *C.ANALOGUE_COLS, *C.DIGITAL_COLS, CORRUPT)


def producer_messages(text_rows: DataFrame, now: Column | None = None) -> DataFrame:
    """CSV text rows as stream messages: typed fields, and the current time when there is no timestamp column."""
    stamp = now if now is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return encode_json(coerce_sensor_rows(text_rows, missing_ts=stamp))


def publish(df: DataFrame, options: dict, fmt: str = "kafka") -> None:
    """Write all rows, encoded, to a topic (or any sink format).

    For Kafka every message waits for all in-sync replicas (``acks=all``)
    unless the options say otherwise.
    """
    if fmt == "kafka":
        options = {"kafka.acks": "all", **options}
    encode_json(df).write.format(fmt).options(**options).save()
