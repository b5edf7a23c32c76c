"""Numeric expressions: finite tests, clamps, schedules."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(x: Column, lo, hi) -> Column:
    return F.least(F.greatest(x, F.lit(lo)), F.lit(hi))


def finite(c) -> Column:
    """F5 strict form: not NULL, not NaN, not +/-inf."""
    x = _col(c)
    return x.isNotNull() & ~F.isnan(x) & (x != float("inf")) & (x != float("-inf"))


def finite_recorder(c) -> Column:
    """F5 recorder form: drops NULL, NaN and +inf but keeps -inf."""
    x = _col(c)
    return x.isNotNull() & ~F.isnan(x) & (x != float("inf"))


def phase_fraction(into: Column, left: Column) -> Column:
    """Into / (into + left), clamped to [0, 1]; 0 when the span is 0."""
    span = into + left
    return F.when(span == 0, F.lit(0.0)).otherwise(clamp(F.try_divide(into, span), 0.0, 1.0))


def one_cycle(frac: Column, peak: Column, warmup: Column, min_frac: Column, in_train: Column) -> Column:
    """Warm-up ramp then cosine to the floor; the floor outside Train.

    ``lr = peak * (frac / warmup)`` while ``frac < warmup``; after that
    ``peak * (min_frac + (1 - min_frac) * c)`` with ``c = (1 + cos(pi * q)) / 2``
    and ``q = min(1, (frac - warmup) / max(1e-6, 1 - warmup))``; outside Train
    ``peak * min_frac``; never below 1e-6.
    """
    floor = peak * min_frac
    q = F.least(F.lit(1.0), (frac - warmup) / F.greatest(F.lit(1e-6), F.lit(1.0) - warmup))
    c = F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * q))
    cosine = peak * (min_frac + (F.lit(1.0) - min_frac) * c)
    ramp = peak * (frac / warmup)
    v = F.when(~in_train, floor).when((warmup > 0) & (frac < warmup), ramp).otherwise(cosine)
    return F.greatest(F.lit(1e-6), v)


def age_units(seconds: Column) -> tuple[Column, Column, Column]:
    """An age in seconds as (minutes, hours, 12-second blocks)."""
    return seconds / 60.0, seconds / 3600.0, F.floor(seconds / 12.0).cast("long")
