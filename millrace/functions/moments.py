"""Bias-corrected skewness and kurtosis from Spark's population moments."""

from __future__ import annotations

import math


def sample_skewness(n: int, variance: float | None, g1: float | None) -> float | None:
    """Adjusted Fisher-Pearson skewness; null below 3 values, 0 for a constant."""
    if n < 3:
        return None
    return g1 * math.sqrt(n * (n - 1)) / (n - 2) if variance else 0.0


def sample_kurtosis(n: int, variance: float | None, g2: float | None) -> float | None:
    """Unbiased excess kurtosis; null below 4 values, 0 for a constant."""
    if n < 4:
        return None
    return ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)) if variance else 0.0
