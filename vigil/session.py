"""Session construction and lineage cutting."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "vigil", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with AQE on, UTC time, no UI. On a cluster pass ``master=None``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def sizing(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Session settings for a given input size: partitions that fit executor memory.

    Shuffle partitions ~ input / 256 MB, rounded up to whole waves of the
    cluster's cores; file splits and AQE's advisory size at the same 256 MB,
    so scans, shuffles and the window blocks all see similar task sizes.
    Example: 100 TB on 1000 executors x 8 cores -> 409,600 partitions.
    """
    waves = max(1, -(-input_bytes // (partition_bytes * total_cores)))
    return {
        "spark.sql.shuffle.partitions": str(waves * total_cores),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; create a scratch one only when unset (local/tests)."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="vigil-ckpt-", dir=os.environ.get("VIGIL_SCRATCH", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers (once a session), as ``--py-files`` would: executors that have no copy of
    this repository get it from the shared checkpoint folder."""
    sc = spark.sparkContext
    if getattr(sc, "_vigil_shipped", False):
        return
    import vigil

    top = os.path.dirname(os.path.abspath(vigil.__file__))
    if os.path.isdir(top):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            for folder, _, names in os.walk(top):
                for name in sorted(n for n in names if n.endswith(".py")):
                    z.write(full := os.path.join(folder, name), os.path.relpath(full, os.path.dirname(top)))
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/vigil_package.zip")
        out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(held.getvalue()))
        out.close()
        sc.addPyFile(path.toString())
    sc._vigil_shipped = True


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` once as parquet under the shared checkpoint folder and reading it back.

    The plan runs once; the result is columnar (pruning, pushdown) and optionally partitioned.
    """
    spark = df.sparkSession
    path = path or table_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    kept = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")            # the table stands for the plan: its shuffle files can go at once
    try:
        w.parquet(path)
    finally:
        if kept is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, kept)
    return spark.read.parquet(path)


def table_path(spark: SparkSession, name: str) -> str:
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a job-owned intermediate folder (Hadoop file system, so shared stores work)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster)."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"
