"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rounding goes through a fixed-point decimal so that the result does not
# depend on the last ulp of the double (summation order differs between
# engines and between partitionings) nor on the sign of zero.
ROUND_VIA = "decimal(28,10)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, scale: int = 4) -> Column:
    """``ROUND(x, scale)``, half away from zero, returned as double."""
    return F.round(_col(c).cast(ROUND_VIA), scale).cast("double")


def safe_ratio(num, den) -> Column:
    """``num / NULLIF(den, 0)`` (ANSI mode raises on division by zero)."""
    return _col(num).cast("double") / F.nullif(_col(den), F.lit(0))
