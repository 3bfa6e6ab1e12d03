"""Array expression helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once per row.

    An expression used inside a lambda is otherwise evaluated for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
