"""Give a value inside an expression a name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used inside a lambda is computed again for every element, which makes work
    over long arrays quadratic; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
