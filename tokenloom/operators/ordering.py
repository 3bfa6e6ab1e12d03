"""Running totals over an ordered table, without sending the table through one task.

Spark has no order between rows, and ``Window.orderBy`` without partitions is a single
task. Here every row belongs to a *chunk*: one or more columns that agree with the order
key (earlier chunk, earlier rows) and bound how many rows share a chunk. Chunk totals are
summed in chunk order, which is a far smaller table, and rows only need a window inside
their own chunk. Several chunk columns, coarse to fine, repeat the step level by level, so
no window ever spans more than one chunk's children.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tokenloom.session import settle

CHUNK_HI = "chunk_hi"
CHUNK = "chunk"
CHUNKS = [CHUNK_HI, CHUNK]

# Small chunks spread hot datasets evenly over the shuffle partitions; two levels of this size
# keep every window bounded: 10**11 rows make 4 * 10**8 chunks under 4 * 10**5 coarse ones.
CHUNK_KEYS = 1 << 8
COARSE_FANOUT = 1 << 10


def div(value: Column, by: Column | int) -> Column:
    """Integer division, exact for the whole bigint range."""
    return F.call_function("div", value, F.lit(by) if isinstance(by, int) else by)


def chunk_by_key(df: DataFrame, key: str, keys_per_chunk: int = CHUNK_KEYS, fanout: int = COARSE_FANOUT) -> DataFrame:
    """Add the chunk columns for a dense integer key, ``keys_per_chunk`` key values to a chunk.

    Arithmetic on the key alone, so nothing is read for it. A key with wide gaps makes
    chunks of few rows, and as many of them as rows: order such a key by :func:`chunk_by_order`.
    """
    fine = div(F.col(key).cast("bigint"), keys_per_chunk)
    return df.withColumns({CHUNK_HI: div(fine, fanout), CHUNK: fine})


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with a NULL in any of the columns failing the job, where a join would lose the row."""
    return df.withColumns({k: F.coalesce(F.col(k), F.raise_error(F.lit(f"NULL in {k}"))) for k in keys})


# monotonically_increasing_id: the partition above these bits, the row inside it below.
_ROW_BITS = 33


def chunk_by_order(
    df: DataFrame,
    order: list[str],
    group: list[str] = ["dataset"],
    rows_per_chunk: int = CHUNK_KEYS,
    fanout: int = COARSE_FANOUT,
) -> DataFrame:
    """Add the chunk columns for any orderable key: sparse, hashed, clustered or text.

    The keys alone are range-partitioned and sorted, which numbers them inside their range;
    the ranges' counts, summed in order, make that the key's exact rank. A chunk is
    ``rows_per_chunk`` consecutive ranks and a coarse chunk ``fanout`` chunks, so whatever
    the keys look like, windows over chunks hold at most that many rows, and the top one a
    row per ``rows_per_chunk * fanout`` keys. Rows of equal keys share a chunk. A NULL in a
    group or order column fails the job.
    """
    names = [*group, *order]
    rows = require_keys(df, names)
    keys = rows.select(*names).repartitionByRange(*names).distinct().sortWithinPartitions(*names)
    # settled, because another run of the exchange may cut the ranges elsewhere
    numbered = settle(keys.withColumn("row__", F.monotonically_increasing_id()), "order")
    numbered = numbered.withColumn("range__", F.shiftright("row__", _ROW_BITS))
    ranges = numbered.groupBy("range__").agg(F.count("*").alias("rows__"))
    starts = running_totals(ranges, group=[], chunk=[], order=["range__"], totals={"before__": F.col("rows__")})
    rank = F.col("before__") + F.col("row__").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    chunk = div(rank, rows_per_chunk)
    placed = numbered.join(settle(starts, "ranges").drop("rows__"), "range__")
    return rows.join(placed.select(*names, div(chunk, fanout).alias(CHUNK_HI), chunk.alias(CHUNK)), names)


def _chunk_offsets(df: DataFrame, group: list[str], chunk: list[str], totals: dict[str, Column]) -> DataFrame:
    """Per chunk and name: ``<name>__before``, the total of all earlier chunks of the group,
    and ``<name>__past``, the same with the chunk's own total added."""
    # Joins are planned with this condition anyway; saying it here keeps the totals the same
    # plan at every level, and Spark then computes them once.
    known = reduce(lambda rows, name: rows.where(F.col(name).isNotNull()), [*group, *chunk], df)
    sums = known.groupBy(*group, *chunk).agg(*[F.sum(c).cast("bigint").alias(f"{n}__own") for n, c in totals.items()])
    before = {f"{n}__before": F.col(f"{n}__own") for n in totals}
    placed = _running_totals(sums, group, chunk[:-1], [chunk[-1]], before, None)
    return placed.select(
        *group,
        *chunk,
        *[F.col(f"{n}__before") for n in totals],
        *[(F.col(f"{n}__before") + F.col(f"{n}__own")).alias(f"{n}__past") for n in totals],
    )


def running_totals(
    df: DataFrame,
    *,
    group: list[str],
    chunk: list[str],
    order: list[str],
    totals: dict[str, Column],
    bounds_of: str | None = None,
) -> DataFrame:
    """Add, for each name, the sum of its column over all earlier rows of the group.

    A NULL in a group or chunk column fails the job.

    ``lit(1)`` as a column gives a dense 0-based position. The order key must be unique
    within a group. Rows are exchanged once, on (group, chunk), and keep that partitioning;
    the far smaller chunk totals are joined to them there. ``bounds_of`` names a total whose
    value at the start and past the end of the row's chunk is kept as ``chunk_first`` and
    ``chunk_past``.
    """
    return _running_totals(require_keys(df, [*group, *chunk]), group, chunk, order, totals, bounds_of)


def _running_totals(df, group, chunk, order, totals, bounds_of):
    inside = Window.partitionBy(*group, *chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = {n: F.coalesce(F.sum(c).over(inside), F.lit(0)).cast("bigint") for n, c in totals.items()}
    if not chunk:
        return df.withColumns(within)
    before = _chunk_offsets(df, group, chunk, totals)
    rows = df.withColumns({f"{n}__in": c for n, c in within.items()})
    columns = {n: F.col(f"{n}__before") + F.col(f"{n}__in") for n in totals}
    if bounds_of:
        columns["chunk_first"] = F.col(f"{bounds_of}__before")
        columns["chunk_past"] = F.col(f"{bounds_of}__past")
    return (
        rows.join(before, [*group, *chunk])
        .withColumns(columns)
        .drop(*[f"{n}__{part}" for n in totals for part in ("in", "before", "past")])
    )


def first_rows(df: DataFrame, *, group: list[str], chunk: list[str], order: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group by the order key.

    Chunks that start past the limit are dropped before any row moves, as long as the list
    of those that do not is small enough to broadcast; only the kept rows are exchanged and
    numbered, chunk by chunk.
    """
    df = require_keys(df, [*group, *chunk])
    offsets = _chunk_offsets(df, group, chunk, {"rows": F.lit(1)}).drop("rows__past")
    started = settle(offsets.where(F.col("rows__before") < limit), "chunks")
    numbered = Window.partitionBy(*group, *chunk).orderBy(*order)
    return (
        df.join(started, [*group, *chunk])
        .withColumn("row__in", F.row_number().over(numbered))
        .where(F.col("rows__before") + F.col("row__in") <= limit)
        .drop("rows__before", "row__in")
    )
