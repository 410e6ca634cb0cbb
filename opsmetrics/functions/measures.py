"""Rates and exact time sums.

Working time is carried as exact microseconds (sums in DECIMAL(38,0) so
no worker can overflow a 64-bit sum) and turned into double seconds only
for output; rates divide with ``try_divide`` so a zero denominator gives
NULL instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,0)"


def exact_sum(c: Column) -> Column:
    """SUM of an integer expression that cannot overflow."""
    return F.sum(c.cast(EXACT))


def micros_to_seconds(c: Column) -> Column:
    return c.cast("double") / F.lit(1_000_000.0)


def micros_to_interval(c: Column) -> Column:
    """Exact microseconds -> INTERVAL DAY TO SECOND."""
    return F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (c.cast("decimal(38,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    )


def per_hour(qty: Column, seconds: Column, scale: int | None = 2, factors: tuple[float, ...] = (60.0, 60.0)) -> Column:
    """Quantity per clocked hour: qty / seconds, times each of ``factors``.

    The reports scale by 60 twice, the hourly tables by 3600 once (the
    order of float operations is kept so results are bit-identical).
    With ``scale`` the value is rounded half away from zero on a decimal,
    as a NUMERIC round does; ``None`` keeps the raw double.
    """
    rate = F.try_divide(qty.cast("double"), seconds.cast("double"))
    for f in factors:
        rate = rate * F.lit(float(f))
    if scale is None:
        return rate
    return F.round(rate.cast("decimal(38,10)"), scale).cast("double")


def interval_seconds(iv: Column) -> Column:
    """Seconds in a DAY TO SECOND interval, from its day/hour/minute/second parts (fraction kept)."""
    parts = (
        F.extract(F.lit("DAY"), iv).cast("decimal(38,6)") * F.lit(86400)
        + F.extract(F.lit("HOUR"), iv).cast("decimal(38,6)") * F.lit(3600)
        + F.extract(F.lit("MINUTE"), iv).cast("decimal(38,6)") * F.lit(60)
        + F.extract(F.lit("SECOND"), iv).cast("decimal(38,6)")
    )
    return parts.cast("double")
