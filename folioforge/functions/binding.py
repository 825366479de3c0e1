"""Binding a value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    A lambda that mentions an outer expression computes it again for every
    element; bound by a one-element transform it is a variable instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
