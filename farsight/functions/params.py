"""Scalar parameters of the item operators (computed once on the driver and
pasted into plans as literals)."""

from __future__ import annotations

import math


def check_items_params(phi: float, epsilon: float | None = None,
                       delta: float | None = None) -> None:
    if not 0 < phi < 1:
        raise ValueError(f"phi must be in (0, 1), got {phi!r}")
    if epsilon is not None and not 0 < epsilon < phi:
        raise ValueError(f"epsilon must be in (0, phi), got {epsilon!r}")
    if delta is not None and not 0 < delta < 1:
        raise ValueError(f"delta must be in (0, 1), got {delta!r}")


def reservoir_size(phi: float) -> int:
    """m = ceil(1/phi) (1/phi rounded to 9 places first so 1/0.05 is 20)."""
    check_items_params(phi)
    return int(math.ceil(round(1.0 / phi, 9)))


def sticky_r(phi: float, epsilon: float, delta: float) -> float:
    """r = ln(1/(delta*phi)) / epsilon: expected number of successful draws."""
    check_items_params(phi, epsilon, delta)
    return math.log(1 / (delta * phi)) / epsilon


def sticky_rate(n: int, phi: float, epsilon: float, delta: float) -> float:
    """Sampling probability r/n, clamped to 1 (then counts are exact)."""
    if n <= 0:
        raise ValueError(f"n must be > 0, got {n!r}")
    return min(1.0, sticky_r(phi, epsilon, delta) / n)
