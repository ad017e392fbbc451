"""Exact quantiles from a sketch and one counting scan."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators.report import exact_quantiles, quantile_sketch

RANKS = [0.0, 0.001, 0.25, 0.50, 0.90, 0.95, 0.99, 1.0]


def want(values, ranks=RANKS):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    return [v[max(1, len(v) - math.floor(len(v) - q * len(v))) - 1] if v else None for q in ranks]


def frame(spark, values):
    return spark.createDataFrame([(x,) for x in values], "v double").repartition(5)


rng = np.random.default_rng(3)
CASES = {
    "smooth": rng.normal(size=30_000).tolist(),
    "ties": [float(x) for x in rng.integers(0, 7, 20_000)],
    "one value": [2.5] * 9_000,
    "long tail": np.exp(rng.normal(size=20_000) * 20).tolist(),
    "odd": [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 1e308, -1e308, 5e-324] * 40 + rng.normal(size=300).tolist(),
    "few": [3.0, 1.0, 2.0], "one": [7.0], "none": [None, float("nan")], "empty": [],
}


@pytest.mark.parametrize("few", [65_536, 20])
@pytest.mark.parametrize("name", list(CASES))
def test_exact_at_every_rank(spark, name, few):
    """With ``few = 20`` the values are selected in Spark from the written counts."""
    assert exact_quantiles(frame(spark, CASES[name]), "v", RANKS, few=few) == want(CASES[name])


@pytest.mark.parametrize("ranks", [[0.5], RANKS])
@pytest.mark.parametrize("few", [65_536, 20])
def test_two_scans_whatever_the_number_of_ranks(spark, ranks, few):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    df = frame(spark, CASES["smooth"]).mapInArrow(counted, "v double")
    assert exact_quantiles(df, "v", ranks, few=few) == want(CASES["smooth"], ranks)
    assert read.value == 2 * 30_000
    sketch = frame(spark, CASES["smooth"]).agg(quantile_sketch(F.col("v")).alias("s")).first()["s"]
    assert exact_quantiles(df, "v", ranks, sketch, few) == want(CASES["smooth"], ranks)
    assert read.value == 3 * 30_000


def test_a_sketch_that_misses_is_found_out(spark):
    """The sketch of other values, of the same number: brackets that don't hold the ranks are widened."""
    sketch = frame(spark, [x + 1 for x in CASES["smooth"]]).agg(quantile_sketch(F.col("v")).alias("s")).first()["s"]
    assert exact_quantiles(frame(spark, CASES["smooth"]), "v", RANKS, sketch) == want(CASES["smooth"])
