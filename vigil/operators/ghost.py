"""Rolling features with one exchange of the rows.

The range partitions of the time order are the blocks. In the stage that sorts them, every task runs over its rows once
(Arrow batches, the newest ``preceding`` values carried along), numbers them and writes them with their rolling columns.
Only the first rows of a partition lack the rows before them: the last ``preceding`` rows in front of each partition
(ghost rows, from as many partitions as it takes) are exchanged to it, and its first ``preceding`` rows are computed
again from both. That is 2 x ``preceding`` rows for each partition, whatever its size; all other rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import config as C
from vigil.functions import columns as X
from vigil.functions.frames import frame_stats
from vigil.operators import ordered as O
from vigil.session import drop_path, ship, table_path, write_table

BATCH = 8192                        # rows whose frames are laid out at once (12 MB a column)
PID, POS = "_pid", "_pos"


@dataclass
class Rolled:
    """Rows with ``row_idx`` and rolling columns, in two parts: those that stay where they are, and the first of each
    partition; their number; and the written tables behind them."""

    body: DataFrame
    heads: DataFrame
    n: int
    paths: tuple[str, ...]

    @property
    def df(self) -> DataFrame:
        return self.body.unionByName(self.heads)

    def release(self) -> None:
        """Delete the written tables once a consumer has materialised what it needs."""
        for path in self.paths:
            drop_path(self.body.sparkSession, path)


def sorted_frames(df: DataFrame, order: list[str], partitions: int, features: dict[str, tuple[str, str]], preceding: int) -> DataFrame:
    """The rows range-partitioned and sorted by ``order`` (the one exchange), with partition, position and the statistics of the frames
    as far as they lie in the partition."""
    ship(df.sparkSession)
    names = [n for pair in features.values() for n in pair]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, pos = TaskContext.get().partitionId(), 0
        before = {x: np.empty(0) for x in features}
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                columns, m = list(part.columns), part.num_rows
                for x in features:
                    own = part.column(x).to_numpy(zero_copy_only=False).astype(np.float64)
                    values = np.concatenate([before[x], own])
                    columns += [pa.array(s, pa.float64(), mask=np.isnan(s)) for s in frame_stats(values, m, preceding)]
                    before[x] = values[-preceding:]
                columns += [pa.array(np.full(m, pid, np.int32)), pa.array(np.arange(pos, pos + m))]
                pos += m
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *names, PID, POS])

    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names),
                           T.StructField(PID, T.IntegerType()), T.StructField(POS, T.LongType())])
    return df.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(run, schema)


def rolled_rows(df: DataFrame, order: list[str] | None = None, partitions: int | None = None,
                features: dict[str, tuple[str, str]] = O.ROLLING_OUTPUTS, preceding: int = C.ROLLING_PRECEDING) -> Rolled:
    """Dense row index and ``rowsBetween(-preceding, 0)`` statistics in the global order of ``order``. The features have no nulls."""
    spark = df.sparkSession
    paths = (table_path(spark, "rolled"), table_path(spark, "starts"))
    tagged = write_table(sorted_frames(df, order or O.total_order(df), partitions or int(spark.conf.get("spark.sql.shuffle.partitions")),
                                       features, preceding), "rolled", path=paths[0])
    # P rows: where each partition (that has rows) starts, and which partitions start up to ``preceding`` rows behind its end
    counts = tagged.groupBy(PID).agg(F.count(F.lit(1)).alias("_c"))
    along = Window.orderBy(PID)
    starts = counts.withColumn("_s", F.coalesce(F.sum("_c").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ahead = F.collect_list(F.struct(F.col(PID).alias("to"), F.col("_s").alias("s"))).over(along.rowsBetween(1, preceding + 1))
    starts = write_table(starts.withColumn("_ahead", F.filter(ahead, lambda x: x["s"] < F.col("_s") + F.col("_c") + preceding)), "starts", path=paths[1])
    n = int(starts.agg(F.sum("_c")).first()[0] or 0)
    idx = (F.col("_s") + F.col(POS)).alias(O.IDX)
    rows = tagged.join(starts, PID)             # Spark broadcasts the starts only below its own limit
    in_head = (F.col(POS) < preceding) & (F.col("_s") > 0)
    kept = [c for c in tagged.columns if c not in (PID, POS)]

    tails = rows.filter(F.col(POS) >= F.col("_c") - preceding).select(idx, *features, F.explode(F.filter(
        "_ahead", lambda x: x["s"] <= F.col("_s") + F.col(POS) + preceding)).alias("x")).select(
        F.col("x.to").alias("_to"), O.IDX, *features, F.lit(False).alias("_own"))
    heads = rows.filter(in_head).select(F.col(PID).alias("_to"), idx, *features, F.lit(True).alias("_own"))
    frame = Window.partitionBy("_to").orderBy(O.IDX).rangeBetween(-preceding, 0)        # 3 x preceding rows at most
    stats: dict[str, Column] = {}
    for x, (mean, std) in features.items():
        stats |= {mean: F.avg(x).over(frame), std: F.stddev_samp(x).over(frame)}
    edges = tails.unionByName(heads).select("*", *[c.alias(f"_new_{k}") for k, c in stats.items()]).filter("_own")
    fixed = edges.select(O.IDX, *[f"_new_{k}" for k in stats])
    first = rows.filter(in_head).select(*kept, idx).join(fixed, O.IDX)
    return Rolled(rows.filter(~in_head).select(*kept, idx),
                  first.select(*[F.col(f"_new_{c}").alias(c) if c in stats else F.col(c) for c in [*kept, O.IDX]]), n, paths)


def engineer_rows(df: DataFrame, order: list[str] | None = None, partitions: int | None = None) -> tuple[DataFrame, Rolled]:
    """Derived columns, rolling columns and row index of complete rows, nulls to 0; and what to release when it is written."""
    rolled = rolled_rows(df, order, partitions)
    return O.fill_zero(rolled.df.select("*", *X.derived_columns())), rolled
