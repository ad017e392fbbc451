"""CSV ingest: typed coercion, timestamp resolution, counts, landing.

The original parses rows one by one in a single process; here a CSV folder is
read by Spark with every field as text (no inference pass), typed in one
``select`` of built-in expressions, and landed with a partitioned write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vigil import config as C
from vigil.functions import columns as X
from vigil.sources.commit import current_version, replace_version
from vigil.sources.zones import refresh_zones


def read_sensor_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every field as text; columns named by the header."""
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("mode", "PERMISSIVE").csv(path))


def timestamp_text(df: DataFrame, missing: Column | None = None) -> Column:
    """The ``timestamp`` column, else ``Timestamp`` (header-level choice), trimmed, blank as NULL.

    ``missing`` is used when the input has neither column (the producer stamps
    the current time there; the loader leaves NULL and skips the rows).
    """
    if "timestamp" in df.columns:
        src = F.col("timestamp")
    elif "Timestamp" in df.columns:
        src = F.col("Timestamp")
    else:
        return missing.cast("string") if missing is not None else F.lit(None).cast("string")
    return F.nullif(X.strip_ws(src), F.lit(""))


def _field(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def coerce_sensor_rows(df: DataFrame, keep: tuple[str, ...] = (), missing_ts: Column | None = None) -> DataFrame:
    """Text rows to the typed sensor schema in one projection.

    Analogue fields as float(); digital fields as int(float()); a bad or
    missing value becomes NULL. Extra columns are dropped unless in ``keep``.
    """
    fields = C.ANALOGUE_COLS + C.DIGITAL_COLS
    # Three narrow projections, so each field is stripped and parsed once
    # (conditional branches get no common-subexpression elimination).
    stripped = df.select(*[F.col(k) for k in keep], timestamp_text(df, missing_ts).alias("timestamp"),
                         *[X.strip_ws(_field(df, c)).alias(c) for c in fields])
    parsed = stripped.select(*keep, "timestamp", *[X.float_of_stripped(F.col(c)).alias(c) for c in fields])
    return parsed.select(*keep, "timestamp", *C.ANALOGUE_COLS,
                         *[X.int_of_double(F.col(c)).alias(c) for c in C.DIGITAL_COLS])


def resolve_timestamp(coerced: DataFrame) -> DataFrame:
    """Drop rows without a timestamp and parse it (``ts``, no time zone); the text is kept for bronze."""
    kept = coerced.filter(F.col("timestamp").isNotNull())
    return kept.withColumn("ts", F.col("timestamp").try_cast("timestamp_ntz"))


def ingest_counts(coerced: DataFrame) -> DataFrame:
    """Inserted and skipped rows of a load, in one pass."""
    return coerced.agg(F.count_if(F.col("timestamp").isNotNull()).alias("inserted"),
                       F.count_if(F.col("timestamp").isNull()).alias("skipped"))


def stamp_ingest(df: DataFrame, at: Column | None = None, name: str = "_loaded_at") -> DataFrame:
    """Add the load / ingest time (a parameter in tests, the current time otherwise)."""
    return df.withColumn(name, at if at is not None else F.current_timestamp())


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def is_nonempty(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    path = current_version(spark, path)
    return table_exists(spark, path) and not spark.read.format(fmt).load(path).isEmpty()


def write_raw_batches(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                      partition_by: tuple[str, ...] = ("date",), max_records_per_file: int | None = None) -> None:
    """Bulk write, partitioned by reading date so that filters on ``date`` prune files. Rows are dealt by date and then
    rebalanced by size: a day (or an hour) with very many rows goes to as many tasks and files as it needs, days with few
    share a task."""
    out = df
    if "date" in partition_by and "date" not in df.columns:
        out = out.withColumn("date", F.to_date("ts" if "ts" in df.columns else "timestamp"))
    if partition_by and df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    elif "date" in partition_by and "ts" in out.columns:        # a stateful micro-batch, which has no adaptive plans
        out = out.repartition("date", F.hour("ts"))
    w = out.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def load_raw(spark: SparkSession, csv_path: str, target: str, drop: bool = False, fmt: str = "parquet",
             loaded_at: Column | None = None) -> dict:
    """Load a CSV folder into the raw table.

    Skips when the target already holds rows (unless ``drop``). The rows are a new version of the table, which takes the
    old one's place when it is whole (``commit.replace_version``): a load that fails leaves what was there. Returns
    inserted / skipped counts.
    """
    if not drop and is_nonempty(spark, target, fmt):
        return {"inserted": 0, "skipped": 0, "loaded": False}
    coerced = coerce_sensor_rows(read_sensor_csv(spark, csv_path))
    # The counts are observed while the write runs: one pass over the input.
    obs = Observation("ingest_counts")
    counted = coerced.observe(obs, F.count_if(F.col("timestamp").isNotNull()).alias("inserted"),
                              F.count_if(F.col("timestamp").isNull()).alias("skipped"))
    rows = stamp_ingest(resolve_timestamp(counted), loaded_at)
    replace_version(spark, target, lambda folder: write_raw_batches(rows, folder, fmt, mode="overwrite"))
    counts = obs.get
    if fmt == "parquet":
        refresh_zones(spark, target, "ts")
    return {"inserted": int(counts["inserted"]), "skipped": int(counts["skipped"]), "loaded": True}


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", columns: list[str] | None = None) -> DataFrame:
    """Whole-table scan of a landed table, in its current version (format is configuration)."""
    df = spark.read.format(fmt).load(current_version(spark, path))
    return df.select(*columns) if columns else df
