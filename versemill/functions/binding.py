"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer may merge a helper column into the lambda that uses it, which would
    compute it again for every array element. A lambda argument cannot be merged.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
