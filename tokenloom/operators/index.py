"""The sequence index: dense ids, token offsets, lookups by id and by offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tokenloom.operators.lookup import in_ranges, wanted_ranges
from tokenloom.operators.ordering import CHUNKS, COARSE_FANOUT, div, running_totals
from tokenloom.session import settle


def drop_empty(df: DataFrame, size: str = "num_tokens") -> DataFrame:
    """Without zero-length sequences."""
    return df.where(F.col(size) > 0)


def count_empty(df: DataFrame, group: list[str], size: str = "num_tokens") -> DataFrame:
    """Kept and dropped sequences per group."""
    return df.groupBy(*group).agg(
        F.count_if(F.col(size) > 0).alias("num_kept"),
        F.count_if(F.col(size) <= 0).alias("num_empty"),
    )


def index_sequences(
    df: DataFrame,
    *,
    order: list[str],
    width: Column | int = 4,
    group: list[str] = ["dataset"],
    chunk: list[str] = CHUNKS,
) -> DataFrame:
    """Number the non-empty sequences and lay them end to end.

    Adds ``seq_id`` (dense, 0-based), ``token_start`` and ``token_end`` (exclusive and
    inclusive running token count), ``byte_pointer``, and the token range of the row's chunk
    (``chunk_first``, ``chunk_past``). Needs ``num_tokens``; the text or ids may ride along
    and are exchanged once. Empty sequences count nothing and go last, so that their size
    is computed once per row.
    """
    width = F.lit(width) if isinstance(width, int) else width
    placed = running_totals(
        df,
        group=group,
        chunk=chunk,
        order=order,
        totals={"seq_id": (F.col("num_tokens") > 0).cast("bigint"), "token_start": F.col("num_tokens")},
        bounds_of="token_start",
    )
    return drop_empty(placed).withColumns(
        {
            "token_end": F.col("token_start") + F.col("num_tokens"),
            "byte_pointer": F.col("token_start") * width,
        }
    )


def document_index(index: DataFrame, document: list[str]) -> DataFrame:
    """Per document, the id of its last sequence."""
    return index.groupBy(*document).agg(F.max("seq_id").alias("last_seq_id"))


def get_sequences(tokens: DataFrame, wanted: DataFrame, group: list[str] = ["dataset"]) -> DataFrame:
    """The sequences named by ``wanted`` (group columns and ``seq_id``).

    Ids are dense, so an id outside ``[0, sequences)`` does not exist and fails the job. The
    ids reach the scan of a stored table as ranges: what holds none of them is not read.
    """
    counts = tokens.groupBy(*group).agg(F.count("*").alias("num_sequences"))
    name = F.concat_ws("/", *[F.col(k).cast("string") for k in (*group, "seq_id")])
    outside = (F.col("seq_id") < 0) | (F.col("seq_id") >= F.coalesce("num_sequences", F.lit(0)))
    error = F.raise_error(F.concat(F.lit("sequence out of range: "), name)).cast("bigint")
    checked = wanted.join(settle(counts, "counts"), group, "left").withColumn(
        "seq_id", F.when(outside, error).otherwise(F.col("seq_id"))
    )
    settled = settle(checked.drop("num_sequences"), "wanted")
    near = in_ranges(wanted_ranges(settled, group, "seq_id", "seq_id"), group, "seq_id")
    return settled.join(tokens.where(near), [*group, "seq_id"])


def locate_tokens(index: DataFrame, offsets: DataFrame, group: list[str] = ["dataset"], span: int = 4096) -> DataFrame:
    """Which sequence holds each token offset, and where inside it. An offset outside the stream fails the job.

    Sequence starts and offsets are laid in one order, and each offset takes the last start
    before it. The order is cut into chunks of ``span`` tokens; a chunk hands its last start
    on to the next ones, level by level, so that nothing is joined but a row per chunk.
    """
    starts = settle(
        index.select(*group, F.struct("token_start", "seq_id", (F.col("token_start") + F.col("num_tokens")).alias("token_end")).alias("start__")),
        "starts",
    )
    name = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in (*group, "offset")])
    error = F.raise_error(F.concat(F.lit("token offset out of range: "), name)).cast("bigint")
    asked = F.when((F.col("offset") >= 0) & F.col("offset").isNotNull(), F.col("offset")).otherwise(error)
    none = F.lit(None).cast(starts.schema["start__"].dataType)
    events = starts.select(*group, F.col("start__.token_start").alias("offset"), "start__", F.lit(False).alias("asked__"))
    events = events.union(offsets.select(*group, asked.alias("offset"), none.alias("start__"), F.lit(True).alias("asked__")))
    fine = div(F.col("offset"), span)
    events = events.withColumns({"coarse__": div(fine, COARSE_FANOUT), "chunk__": fine})

    before = (Window.unboundedPreceding, -1)
    chunks = events.groupBy(*group, "coarse__", "chunk__").agg(F.max("start__").alias("last__"))
    coarse = chunks.groupBy(*group, "coarse__").agg(F.max("last__").alias("last__"))
    far = F.max("last__").over(Window.partitionBy(*group).orderBy("coarse__").rowsBetween(*before))
    near = F.max("last__").over(Window.partitionBy(*group, "coarse__").orderBy("chunk__").rowsBetween(*before))
    carried = chunks.withColumn("near__", near).join(coarse.select(*group, "coarse__", far.alias("far__")), [*group, "coarse__"])
    carried = carried.select(*group, "coarse__", "chunk__", F.coalesce("near__", "far__").alias("carried__"))

    inside = Window.partitionBy(*group, "coarse__", "chunk__").orderBy("offset", "asked__")
    met = events.withColumn("met__", F.last("start__", True).over(inside)).where("asked__")
    found = met.join(carried, [*group, "coarse__", "chunk__"], "left").withColumn("found__", F.coalesce("met__", "carried__"))
    past = F.col("found__").isNull() | (F.col("offset") >= F.col("found__.token_end"))
    return found.select(
        *group,
        F.when(past, error).otherwise(F.col("offset")).alias("offset"),
        F.col("found__.seq_id").alias("seq_id"),
        (F.col("offset") - F.col("found__.token_start")).alias("offset_in_seq"),
    )
