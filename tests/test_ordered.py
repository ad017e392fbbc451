"""Row index, halo-block rolling window and temporal split."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil import config as C
from vigil.operators import ordered as O
from vigil.sources.fixture import sensor_table


def global_rolling(clean):
    w = Window.orderBy(*O.ORDER_COLS).rowsBetween(-C.ROLLING_PRECEDING, 0)
    return clean.select("event_id", *[agg.over(w).alias("g_" + name) for name, agg in O.rolling_specs()])


def test_row_index_dense_and_ordered(spark):
    clean = O.drop_incomplete(sensor_table(spark, SF_SMALL))
    for p in (1, 3, 8):
        idx = O.row_index(clean, partitions=p)
        got = idx.df.select("row_idx", "ts", "event_id").orderBy("row_idx").collect()
        assert idx.n == clean.count() == len(got)
        assert [r.row_idx for r in got] == list(range(idx.n))
        keys = [(r.ts, r.event_id) for r in got]
        assert keys == sorted(keys)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_halo_window_equals_global_window(spark, seed):
    rnd = random.Random(seed)
    clean = O.drop_incomplete(sensor_table(spark, SF_SMALL))
    expected = {r.event_id: r for r in global_rolling(clean).collect()}
    block = rnd.choice([181, 200, 257, 500, 5000])
    idx = O.row_index(clean, partitions=rnd.choice([1, 2, 5, 9]))
    rolled = O.rolling_window(idx.df, O.rolling_specs(), block=block).collect()
    assert len(rolled) == len(expected)
    for r in rolled:
        e = expected[r.event_id]
        for name, _ in O.rolling_specs():
            a, b = r[name], e["g_" + name]
            assert (a is None and b is None) or a == b, (block, name, a, b)


def test_block_must_hold_frame(spark):
    clean = O.drop_incomplete(sensor_table(spark, SF_SMALL))
    with pytest.raises(ValueError):
        O.rolling_window(O.row_index(clean).df, O.rolling_specs(), block=100)


def test_features_fill_first_row_std_with_zero(spark):
    clean = O.drop_incomplete(sensor_table(spark, SF_SMALL))
    feat = O.engineer_features(O.row_index(clean), block=300)
    first = feat.filter("row_idx = 0").first()
    assert first.rolling_std_TP2 == 0.0 and first.rolling_std_motor == 0.0
    assert first.rolling_mean_TP2 == first.TP2
    assert feat.filter(F.col("LPS").isNull()).count() == 0          # digital nulls filled too


def test_split_bounds_ieee():
    assert O.split_bounds(200_000) == (140_000, 179_999)
    assert O.split_bounds(39_999 * 5) == (int(199_995 * 0.7), int(199_995 * (0.7 + 0.2)))
    assert O.split_bounds(0) == (0, 0)
    assert O.split_bounds(1) == (0, 0)


def test_temporal_split_counts(spark):
    clean = O.drop_incomplete(sensor_table(spark, SF_SMALL))
    labeled, n = O.prepare(sensor_table(spark, SF_SMALL), block=400)
    counts = dict(labeled.groupBy("data_split").count().collect())
    tr, te = O.split_bounds(n)
    assert counts == {"train": tr, "test": te - tr, "demo": n - te}
    assert n == clean.count() == 978
    # train strictly precedes test which precedes demo
    mx = {r[0]: r[1] for r in labeled.groupBy("data_split").agg(F.max("row_idx")).collect()}
    mn = {r[0]: r[1] for r in labeled.groupBy("data_split").agg(F.min("row_idx")).collect()}
    assert mx["train"] < mn["test"] and mx["test"] < mn["demo"]


def test_cap_rows_takes_first_rows_in_time_order(spark):
    clean = O.drop_incomplete(sensor_table(spark, SF_SMALL))
    idx = O.row_index(clean)
    capped = O.cap_rows(idx, 100)
    assert capped.n == 100
    assert capped.df.agg(F.max("row_idx")).first()[0] == 99


def test_rolling_plan_has_no_single_partition_exchange(spark):
    clean = O.drop_incomplete(sensor_table(spark, SF_SMALL))
    feat = O.engineer_features(O.row_index(clean), block=300)
    plan = feat._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert plan.count("rangepartitioning(_blk") == 1          # one exchange, on the block id
    assert "hashpartitioning(_blk" not in plan                 # the window adds no second exchange


def test_index_of_landed_rows_without_a_key(spark):
    """Ties in every order column are interchangeable; the index is dense all the same."""
    clean = O.drop_incomplete(sensor_table(spark, SF_SMALL)).drop("event_id", "asset_id")
    twice = clean.unionByName(clean)
    idx = O.row_index(twice, partitions=5)
    got = [r.row_idx for r in idx.df.select("row_idx").collect()]
    assert sorted(got) == list(range(idx.n)) and idx.n == twice.count()
    idx.release()


def test_cap_takes_the_first_rows(spark):
    idx = O.cap_rows(O.row_index(O.drop_incomplete(sensor_table(spark, SF_SMALL)), partitions=3), 500)
    assert idx.n == 500 and sorted(r.row_idx for r in idx.df.select("row_idx").collect()) == list(range(500))


def test_prepare_is_deterministic_across_partitionings(spark):
    cols = ["event_id", "row_idx", "data_split"] + C.ROLLING_COLS + C.DERIVED_COLS
    a, _ = O.prepare(sensor_table(spark, SF_SMALL), partitions=3, block=O.MIN_BLOCK)
    b, _ = O.prepare(sensor_table(spark, SF_SMALL), partitions=11, block=5000)
    ra = sorted(tuple(r) for r in a.select(*cols).collect())
    rb = sorted(tuple(r) for r in b.select(*cols).collect())
    assert ra == rb


def test_window_plan_has_two_sorts(spark):
    idx = O.row_index(O.drop_incomplete(sensor_table(spark, SF_SMALL)), partitions=3)
    plan = O.engineer_features(idx, block=400)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2 and plan.count("Exchange rangepartitioning(_blk") == 1


@pytest.mark.parametrize("block,parts", [(181, 1), (362, 3), (905, 7), (100_000, 2)])
def test_linear_rolling_equals_frame_rolling(spark, block, parts):
    clean = O.drop_incomplete(sensor_table(spark, SF_SMALL))
    idx = O.row_index(clean, partitions=parts)
    frame = {r.event_id: r for r in O.engineer_features(idx, block=max(block, 181), method="frame").collect()}
    linear = O.engineer_features(idx, block=block, method="linear").collect()
    assert len(linear) == len(frame)
    for r in linear:
        e = frame[r.event_id]
        for c in C.ROLLING_COLS:
            assert abs(r[c] - e[c]) <= 1e-9 * max(1.0, abs(e[c])), (c, r[c], e[c])


def test_linear_rolling_constant_input_gives_zero_std(spark):
    df = spark.range(0, 1000).selectExpr("id as event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as ts",
                                         "9.3e0 as TP2", "9.3e0 as TP3", "9e0 as H1", "1e0 as DV_pressure",
                                         "9e0 as Reservoirs", "70e0 as Oil_temperature", "4.4e0 as Motor_current")
    feat = O.engineer_features(O.row_index(df, partitions=3), block=362, method="linear")
    rows = feat.collect()
    assert len(rows) == 1000
    assert max(max(r.rolling_std_TP2, r.rolling_std_motor) for r in rows) < 1e-12
    assert {round(r.rolling_mean_TP2, 9) for r in rows} == {9.3}
