"""A fixed model for the SQL-checked queries.

Our own parameters, obtained once from a KMeans fit (k=8, seed 42) on the
sf0.01 train split and rounded; the two clusters that captured the injected
spikes were left out, so spikes score as anomalies. With a fixed model every
scoring step is plain arithmetic that the DuckDB oracle reproduces exactly.
"""

from vigil import config as C
from vigil.operators.model import AnomalyModel

FIXED_MEAN = [8.9539, 8.834, 9.1445, 0.648, 8.9494, 72.9755, 14.5181,
              0.12, 8.4966, 0.2039, 8.9497, 1.7298, 14.5721, 12.1014]
FIXED_STD = [1.7314, 0.4897, 0.6571, 0.3771, 0.2597, 16.6342, 12.0431,
             1.7985, 0.7578, 0.1762, 0.1489, 0.0624, 0.9235, 1.8173]
FIXED_CENTERS = [
    [0.942, -0.576, 0.788, 0.075, 0.097, 0.173, -0.174, 1.064, 0.646, -0.213, 0.161, 0.06, -0.048, -0.057],
    [-1.21, -0.12, -0.586, 0.567, -0.041, -0.144, -0.075, -1.132, -0.79, -0.052, -0.053, 0.042, -0.054, -0.068],
    [-0.58, 0.358, 0.928, -0.579, 0.031, -0.12, 0.077, -0.655, 1.093, 0.093, -0.049, -0.01, -0.044, -0.074],
    [0.46, 0.218, -0.739, -0.922, -0.098, -0.022, -0.132, 0.383, -0.183, -0.111, -0.033, -0.041, -0.136, -0.065],
    [0.671, 0.253, -0.826, 0.949, -0.011, -0.129, 0.017, 0.577, -1.188, 0.035, 0.127, 0.037, -0.021, -0.058],
]


def fixed_model() -> AnomalyModel:
    """Scaler and centers fixed; the threshold is fitted per query on the train split."""
    return AnomalyModel(list(C.EXTENDED_COLS), list(FIXED_MEAN), list(FIXED_STD), [list(c) for c in FIXED_CENTERS])
