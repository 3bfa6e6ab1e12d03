"""Wanted rows as a few ranges, so that a scan can skip files and row groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.operators.ordering import div
from tokenloom.session import settle

# Ranges of one lookup over all groups; beyond it neighbours are merged, and a group always has one.
RANGES = 128


def wanted_ranges(wanted: DataFrame, group: list[str], low: str, high: str, limit: int = RANGES) -> list[tuple]:
    """(group values, low, high) that together cover every row's [``low``, ``high``], inclusive.

    The span of a group's rows is cut into equal cells, and the rows of a cell are one range:
    what comes to the driver is bounded by ``limit`` and the groups, whatever is wanted.
    """
    ends = settle(wanted.groupBy(*group).agg(F.min(low).alias("from__"), F.max(high).alias("to__")), "spans")
    cells = max(1, limit // max(1, ends.count()))
    width = div(F.col("to__") - F.col("from__"), cells) + 1
    cell = div(F.col(low) - F.col("from__"), width).alias("cell__")
    found = wanted.join(ends, group).groupBy(*group, cell).agg(F.min(low).alias("low__"), F.max(high).alias("high__"))
    merged: list[tuple] = []
    for row in sorted(found.select(*group, "low__", "high__").collect(), key=tuple):
        *names, lo, hi = row
        if merged and list(merged[-1][:-2]) == names and lo <= merged[-1][-1] + 1:
            merged[-1] = (*names, merged[-1][-2], max(hi, merged[-1][-1]))
        else:
            merged.append((*names, lo, hi))
    return merged


def in_ranges(ranges: list[tuple], group: list[str], place: str) -> Column:
    """Whether a row's ``place`` lies in one of its group's ranges; comparisons with constants, which reach the scan."""
    each = [
        reduce(lambda a, b: a & b, [F.col(g) == v for g, v in zip(group, names)], F.col(place).between(lo, hi))
        for *names, lo, hi in ranges
    ]
    return reduce(lambda a, b: a | b, each) if each else F.lit(False)
