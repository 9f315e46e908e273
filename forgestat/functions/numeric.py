"""Numeric helpers with the reference engine's semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_scaled(x: str | Column, digits: int) -> Column:
    """``round(x, digits)`` as the reference's engine computes it on DOUBLE:
    scale by 10^digits, round half away from zero, scale back. Spark's own
    ``round`` rounds the shortest decimal form instead, which differs on
    binary ties: 51/40 = 1.27499999... -> 1.27 here, 1.28 with ``F.round``."""
    c = F.col(x) if isinstance(x, str) else x
    m = float(10 ** digits)
    return F.round(c.cast("double") * F.lit(m), 0) / F.lit(m)
