"""Row frames in numpy, for the steps that run in Python workers."""

from __future__ import annotations

import numpy as np


BLOCK_ROWS = 1024           # rows whose frames are laid out at once: they fit the processor's cache


def frame_stats(values: np.ndarray, new: int, preceding: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation (NaN for a single value) of the last ``new`` values, each with up to ``preceding`` before it."""
    padded = np.concatenate([np.full(max(0, preceding + new - len(values)), np.nan), values[-(preceding + new):]])
    means, stds = np.empty(new), np.empty(new)
    for start in range(0, new, BLOCK_ROWS):
        end = min(start + BLOCK_ROWS, new)
        means[start:end], stds[start:end] = _block_stats(padded[start:end + preceding], preceding)
    return means, stds


def _block_stats(padded: np.ndarray, preceding: int) -> tuple[np.ndarray, np.ndarray]:
    frames = np.lib.stride_tricks.sliding_window_view(padded, preceding + 1)
    if not np.isnan(padded).any():
        mean = frames.cumsum(axis=1)[:, -1] / (preceding + 1)           # summed in row order, as a sliding frame does
        return mean, np.sqrt(((frames - mean[:, None]) ** 2).sum(axis=1) / preceding)
    held = ~np.isnan(frames)
    n = held.sum(axis=1)
    mean = np.where(held, frames, 0.0).cumsum(axis=1)[:, -1] / np.where(n > 0, n, np.nan)
    squares = np.where(held, frames - mean[:, None], 0.0) ** 2
    return mean, np.sqrt(squares.sum(axis=1) / np.where(n > 1, n - 1, np.nan))
