"""Binding of intermediate values inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Work ``value`` out once and use it in ``body`` any number of times.

    Keeps deep formulas from growing exponentially, and keeps a long formula
    out of the surrounding generated method, which the JVM stops compiling
    beyond 8000 bytes of code.
    """
    return F.transform(F.array(value), body)[0]
