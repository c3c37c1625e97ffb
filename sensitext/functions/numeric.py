"""Rounding and safe division."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round4(x: Column | str) -> Column:
    """Four digits, ties to even, computed the way NumPy rounds."""
    return F.rint(_col(x) * F.lit(10000.0)) / F.lit(10000.0)


def ratio_or_zero(num: Column, den: Column) -> Column:
    """``num / den``, and 0.0 where the denominator is zero."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
