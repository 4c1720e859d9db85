"""Floating-point helpers that follow IEEE 754 instead of ANSI SQL.

With ANSI mode on, Spark raises on ``1.0 / 0.0`` and gives NULL for ``ln(0)``.
Raster algebra wants Infinity and NaN there, so that a calm-wind pixel does not
end a job over billions of others. NULL (no data) stays NULL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Number = int | float


def as_column(value: Column | Number) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def divide(numerator: Column | Number, denominator: Column | Number) -> Column:
    """``numerator / denominator`` with x/0 = +-Infinity and 0/0 = NaN."""
    top = as_column(numerator)
    if not isinstance(denominator, Column) and denominator != 0:
        return top / F.lit(float(denominator))
    bottom = as_column(denominator)
    # A zero of either sign counts as +0, so x/0 is x * Infinity.
    return F.when(bottom == 0, top * F.lit(math.inf)).otherwise(top / bottom)


def ln(value: Column | Number) -> Column:
    """Natural logarithm with ln(0) = -Infinity and ln(x<0) = NaN."""
    arg = as_column(value)
    return (
        F.when(arg == 0, F.lit(-math.inf)).when(arg < 0, F.lit(math.nan)).otherwise(F.ln(arg))
    )


def narrow(value: Column, precision: str = "double") -> Column:
    """Round to the width in which intermediate rasters are kept."""
    if precision not in ("double", "float"):
        raise ValueError(f"precision must be 'double' or 'float', not {precision!r}")
    return value.cast(precision)
