"""Row frames: as large as a block whatever a micro-batch holds, and readings in the order of all their columns."""

import tracemalloc

import numpy as np
import pandas as pd

from vigil.functions.frames import frame_stats
from vigil.streaming import scoring


def test_frames_are_laid_out_in_blocks():
    values = np.random.default_rng(3).normal(size=60_000)
    values[1500:1510] = np.nan
    tracemalloc.start()
    mean, std = frame_stats(values, 60_000, 180)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6, peak            # all frames at once: 87 MB for each temporary array
    frames = pd.Series(values).rolling(181, min_periods=1)
    np.testing.assert_allclose(mean, frames.mean(), rtol=0, atol=1e-9)
    np.testing.assert_allclose(std, frames.std(), rtol=0, atol=1e-9)
    some = frame_stats(values[-1300:], 1100, 180)
    np.testing.assert_array_equal(mean[-1100:], some[0])
    assert all(len(x) == 0 for x in frame_stats(values[:10], 0, 180))


def test_readings_of_one_time_are_told_apart_by_their_values():
    draw = np.random.default_rng(4)
    rows = pd.DataFrame({c: draw.integers(0, 2, 500).astype("float64") for c in scoring.SCORE_COLS})
    rows["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(draw.integers(0, 90, 500), unit="s")
    rows["n"] = np.arange(500)
    want = rows.sort_values(scoring.SCORE_COLS, kind="stable").reset_index(drop=True)
    pd.testing.assert_frame_equal(scoring.in_order(rows), want)
    pd.testing.assert_frame_equal(scoring.in_order(rows[:0]), rows[:0].reset_index(drop=True))
