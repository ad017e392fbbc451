"""Zone maps: one row for each file of a landed table (rows, first and last time, flagged rows), written with each landing.

Bounds, counts and freshness come from the map; slices and newest-N reads name the files that can hold their rows. The map
may lag behind the table: files that it lacks are scanned for their zones when it is read, and those that are gone are left
out, so answers are always those of a full scan. (Spark never writes a file name twice.) It lies beside the rows, in a folder
that readers skip, and belongs to one version of a table that is replaced as a whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import config as C
from vigil.operators import report, serve
from vigil.sources.commit import Folders, current_version, replace_version

ZONES = "_zones"
NO_HOST = r"^([A-Za-z][A-Za-z0-9+.-]*:)///"     # Spark writes file:/x in one place and file:///x in another


def zone_rows(df: DataFrame, ts_col: str) -> DataFrame:
    """``(file, rows, timed, first_ts, last_ts, flagged)``: reads the time (and the flag, of predictions) only."""
    flagged = F.count_if(F.col("is_anomaly")) if "is_anomaly" in df.columns else F.lit(None).cast("long")
    return df.groupBy(F.regexp_replace(F.col("_metadata.file_path"), NO_HOST, "$1/").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(ts_col).alias("timed"), F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts"),
        flagged.alias("flagged"))


@dataclass
class Zoned:
    """A landed parquet table with the zones of all its files."""

    root: str
    ts_col: str
    table: DataFrame
    zones: DataFrame

    def files(self, which: Column | None = None) -> DataFrame:
        """The table's rows in the files whose zones are ``which``. Their names go through the driver, as they do in any read."""
        if which is None:
            return self.table
        return _read(self.table, self.root, [r.file for r in self.zones.where(which).select("file").collect()])

    def newest(self) -> Column:
        """The newest time, as a literal."""
        return F.lit(self.zones.agg(F.max("last_ts")).first()[0]).cast(self.table.schema[self.ts_col].dataType)


def _read(table: DataFrame, root: str, files: list[str]) -> DataFrame:
    if not files:
        return table.where(F.lit(False))
    return table.sparkSession.read.schema(table.schema).option("basePath", root).parquet(*map(unquote, files))


def zoned(spark: SparkSession, path: str, ts_col: str) -> Zoned:
    """The table at ``path`` in its current version, with the stored zones of its files and, for files that have none yet,
    zones from a scan of these files."""
    root = current_version(spark, path)
    table, kept = spark.read.parquet(root), f"{root.rstrip('/')}/{ZONES}"
    names = spark.createDataFrame([(f,) for f in sorted({re.sub(NO_HOST, r"\1/", f) for f in table.inputFiles()})], "file string")
    if not Folders(spark, kept).exists(kept):
        return Zoned(root, ts_col, table, zone_rows(table, ts_col))
    stored = spark.read.parquet(current_version(spark, kept))
    new = [r.file for r in names.join(stored, "file", "left_anti").collect()]
    zones = stored.join(names, "file", "left_semi")
    return Zoned(root, ts_col, table, zones.unionByName(zone_rows(_read(table, root, new), ts_col)) if new else zones)


def refresh_zones(spark: SparkSession, path: str, ts_col: str) -> None:
    """Store the zones of all files of the table: those of new files are found by a scan of these files. Of two writers at
    once the last one's map stays; what it lacks is found again."""
    found = zoned(spark, path, ts_col)
    replace_version(spark, f"{found.root.rstrip('/')}/{ZONES}", lambda folder: found.zones.write.mode("overwrite").parquet(folder))


def time_bounds(z: Zoned) -> DataFrame:
    return z.zones.agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def table_summary(z: Zoned, name: str, columns: list[str] | None = None) -> DataFrame:
    """Rows, time bounds and (for predictions) anomaly count and share; ``columns``: those to name (default: all)."""
    totals = z.zones.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("records"), F.min("first_ts").alias("first_ts"),
                         F.max("last_ts").alias("last_ts"), F.coalesce(F.sum("flagged"), F.lit(0)).alias("anomalies"))
    return report.summary_row(totals, name, columns or z.table.columns, "is_anomaly" in z.table.columns)


def freshness(z: Zoned) -> DataFrame:
    return z.zones.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("records"))


def recent_slice(z: Zoned, hours: int = C.DEFAULT_RECENT_HOURS) -> DataFrame:
    """``serve.recent_slice`` up to the table's newest time, from the files that reach into it."""
    newest = z.zones.agg(F.max("last_ts")).first()[0]
    if newest is None:
        return z.table.where(F.lit(False))
    start = F.lit(newest - timedelta(hours=hours)).cast(z.table.schema[z.ts_col].dataType)
    return serve.recent_slice(z.files(F.col("last_ts") >= start), z.ts_col, z.newest(), hours)


def latest_n(z: Zoned, n: int = C.RECENT_LIMIT) -> DataFrame:
    """``serve.latest_n`` from the files that can hold such rows. The files whose rows are all from some time on and are
    ``n`` together give a bound; each has a row, so at most ``n`` zones are looked at."""
    held, bound = 0, None
    for zone in z.zones.where("timed > 0").orderBy(F.desc("first_ts")).limit(n).collect():
        held += zone.timed
        if held >= n:
            bound = F.lit(zone.first_ts).cast(z.table.schema[z.ts_col].dataType)
            break
    return serve.latest_n(z.files(None if bound is None else F.col("last_ts") >= bound), z.ts_col, n)
