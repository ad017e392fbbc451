"""Rolling features with one exchange of the rows, against the global window."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil import config as C
from vigil.operators import ghost as G
from vigil.operators import ordered as O
from vigil.sources.fixture import sensor_table

NAMES = [n for pair in O.ROLLING_OUTPUTS.values() for n in pair]


def rows_of(df, cols):
    return {r.event_id: tuple(r[c] for c in cols) for r in df.collect()}


def compare(df, partitions, preceding=C.ROLLING_PRECEDING, order=("ts", "event_id")):
    w = Window.orderBy(*order).rowsBetween(-preceding, 0)
    want = rows_of(df.withColumn("row_idx", F.row_number().over(Window.orderBy(*order)) - 1).select(
        "*", *[agg.over(w).alias(n) for n, agg in O.rolling_specs()]), ["row_idx", *NAMES])
    rolled = G.rolled_rows(df, list(order), partitions, preceding=preceding)
    got = rows_of(rolled.df, ["row_idx", *NAMES])
    assert rolled.n == len(want) and got.keys() == want.keys()
    for k, v in want.items():
        assert got[k][0] == v[0]
        for a, b in zip(got[k][1:], v[1:], strict=True):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)
    rolled.release()


@pytest.mark.parametrize("partitions, preceding", [(1, 180), (3, 180), (5, 1), (23, 180), (40, 7), (120, 180)])
def test_equal_to_the_global_window(spark, partitions, preceding):
    """Also with partitions of fewer rows than a frame, whose ghost rows come from many partitions."""
    compare(O.drop_incomplete(sensor_table(spark, SF_SMALL)), partitions, preceding)


def test_hot_time_and_small_tables(spark):
    """Half of the rows at one time are spread by the rest of the order; one row; no rows."""
    df = O.drop_incomplete(sensor_table(spark, SF_SMALL))
    hot = df.withColumn("ts", F.when(F.col("event_id") % 2 == 0, F.lit("2024-01-15").cast("timestamp_ntz")).otherwise(F.col("ts")))
    compare(hot, 9)
    compare(df.filter("event_id = 5"), 4)
    compare(df.limit(0), 4)
    one = G.engineer_rows(df.filter("event_id = 5"))[0].first()
    assert one.rolling_std_TP2 == 0.0 and one.rolling_mean_TP2 == one.TP2


def test_one_exchange_of_the_rows(spark):
    """Sorting is the only one; behind it the rows stay where they are, and what moves is 360 rows a partition."""
    df = O.drop_incomplete(sensor_table(spark, SF_SMALL))

    def exchanges(frame):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        return re.findall(r"\bExchange (\w+)", plan)
    assert exchanges(G.sorted_frames(df, ["ts", "event_id"], 8, O.ROLLING_OUTPUTS, 180)) == ["rangepartitioning"]
    rolled = G.rolled_rows(df, partitions=4)
    assert exchanges(rolled.body) == []                 # the starts are broadcast, they are one row a partition
    assert rolled.heads.count() == 3 * 180 and rolled.body.count() == rolled.n - 3 * 180
    rolled.release()
