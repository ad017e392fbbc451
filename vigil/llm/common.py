"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir

#: Fixed by the contracts: a word is a run of characters other than space and the controls 9 to 13.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


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


def words(text: Column) -> Column:
    """The words of a text, in order; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words. The gaps between words are counted, so no per-word lambda runs."""
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{WORD_GAP}|{WORD_GAP}$", "")
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, WORD_GAP))).cast("long")


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column of an Arrow batch."""
    return column.cast(pa.large_binary()).to_pylist()


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns in one struct, so that no name of theirs can clash with a column that an operator adds."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name))


def unpacked(df: DataFrame, columns: list[str], name: str = "row", **changed: Column) -> DataFrame:
    """The columns of the struct again, those of ``changed`` with a new value."""
    return df.select(*(changed.get(c, F.col(f"{name}.`{c}`")).alias(c) for c in columns))


def small_slices(batches: Iterator[pa.RecordBatch], weigh: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that column ``weigh`` holds about ``limit`` bytes in each slice (one row at least)."""
    for batch in batches:
        col = batch.column(weigh)
        start = size = 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
