"""Names for helper columns beside a table's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores behind it a name that no column of ``df`` has in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
