"""Compression of vector columns and the distance between two scorers.

Both roundings stay in the JVM: half precision needs no Python, since scaling by a
power of two is exact and ``rint`` rounds ties to even as IEEE 754 asks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from sensitext.functions.binding import bind

# Fixed values of the int8 and half-precision formats.
INT8_MAX = 127
FP16_OVERFLOW = 65520.0
FP16_MIN_EXPONENT = -14
FP16_FRACTION_BITS = 10


def quantize_int8(vector: Column | str) -> Column:
    """Symmetric int8 with one scale per row: ``struct(scale, q)``."""
    top = F.lit(float(INT8_MAX))

    def scale_of(v: Column) -> Column:
        return F.array_max(F.transform(v, lambda x: F.abs(x))) / top

    def step(x: Column, scale: Column) -> Column:
        rounded = F.least(F.greatest(F.rint(F.try_divide(x, scale)), -top), top)
        return F.when(scale == 0.0, F.lit(0.0)).otherwise(rounded).cast("tinyint")

    return bind(
        _col(vector).cast("array<double>"),
        lambda v: bind(
            scale_of(v),
            lambda scale: F.struct(
                scale.alias("scale"), F.transform(v, lambda x: step(x, scale)).alias("q")
            ),
        ),
    )


def dequantize_int8(quantized: Column | str) -> Column:
    return bind(
        _col(quantized),
        lambda z: F.transform(z["q"], lambda x: x.cast("double") * z["scale"]),
    )


def integer_dots(q: Column | str, heads: Sequence[Sequence[int]]) -> Column:
    """One dot product of whole numbers per class head over a quantised vector."""
    rows = ("array(" + ", ".join(f"{int(w)}L" for w in head) + ")" for head in heads)
    heads_lit = F.expr("array(" + ", ".join(rows) + ")")

    def dot(v: Column, h: Column) -> Column:
        products = F.zip_with(v, h, lambda x, w: x * w)
        return F.aggregate(products, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    return bind(
        _col(q).cast("array<bigint>"), lambda v: F.transform(heads_lit, lambda h: dot(v, h))
    )


def to_fp16(vector: Column | str) -> Column:
    """Each value as it reads after a trip through half precision."""
    return F.transform(_col(vector).cast("array<double>"), _half)


def _half(x: Column) -> Column:
    magnitude = F.abs(x)
    exponent = F.greatest(F.floor(F.log2(magnitude)), F.lit(FP16_MIN_EXPONENT))
    step = F.pow(F.lit(2.0), exponent - F.lit(FP16_FRACTION_BITS))
    infinite = F.signum(x) * F.lit(float("inf"))
    return (
        F.when(F.isnan(x) | (x == 0.0), x)
        .when(magnitude >= F.lit(FP16_OVERFLOW), infinite)
        .otherwise(F.rint(x / step) * step)
    )


def logit_diff(a: Column | str, b: Column | str) -> Column:
    """Largest absolute difference between two logit arrays."""
    return F.array_max(F.zip_with(_col(a), _col(b), lambda x, y: F.abs(x - y)))


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
