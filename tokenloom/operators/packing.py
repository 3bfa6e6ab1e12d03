"""Fixed-length blocks over the concatenated token stream of a dataset.

Every sequence knows where it starts in the stream, so it can cut itself into the pieces
that fall into each block; a block is its pieces put in order. Nothing walks the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.functions.hashing import seeded_digest
from tokenloom.operators.lookup import in_ranges, wanted_ranges
from tokenloom.operators.ordering import div, running_totals
from tokenloom.session import settle


def _check_len(block_len: int) -> None:
    if block_len <= 0:
        raise ValueError(f"block length must be positive, got {block_len}")


def block_counts(index: DataFrame, block_len: int, group: list[str] = ["dataset"]) -> DataFrame:
    """Tokens, sequences and whole blocks per dataset."""
    _check_len(block_len)
    return index.groupBy(*group).agg(
        F.count("*").alias("num_sequences"),
        F.sum("num_tokens").cast("bigint").alias("total_tokens"),
        div(F.sum("num_tokens").cast("bigint"), block_len).alias("num_blocks"),
    )


def _span(block_len: int, start: str = "token_start") -> tuple[Column, Column]:
    """First block a sequence touches, and the one past its last."""
    begin = F.col(start)
    return div(begin, block_len), div(begin + F.col("num_tokens") - 1, block_len) + 1


def _piece(block_len: int, start: str = "token_start"):
    """Function from a block number to the part of the row's tokens that falls into it."""
    begin = F.col(start)

    def cut(block: Column) -> Column:
        lo = F.greatest(block * block_len, begin)
        hi = F.least((block + 1) * block_len, begin + F.col("num_tokens"))
        return F.struct(
            block.alias("block_id"),
            lo.alias("lo"),
            F.slice("tokens", (lo - begin + 1).cast("int"), (hi - lo).cast("int")).alias("piece"),
        )

    return cut


def cut_pieces(
    df: DataFrame,
    block_len: int,
    *,
    keep: list[str],
    start: str = "token_start",
    blocks_from: Column | None = None,
    blocks_before: Column | None = None,
) -> DataFrame:
    """One row per (sequence, block) overlap: ``block_id``, stream offset ``lo``, the ``piece``.

    The slicing happens inside the array expression, so a long sequence is copied once and
    not once per block it spans. Only blocks from ``blocks_from`` up to, not including,
    ``blocks_before`` are cut.
    """
    first, past = _span(block_len, start)
    if blocks_from is not None:
        first = F.greatest(first, blocks_from)
    if blocks_before is not None:
        past = F.least(past, blocks_before)
    return df.where((F.col("num_tokens") > 0) & (first < past)).select(
        *keep, F.inline(F.transform(F.sequence(first, past - 1), _piece(block_len, start)))
    )


def assemble(pieces: DataFrame, keys: list[str], same: list[str] = []) -> DataFrame:
    """Pieces of equal ``keys`` laid together in stream order: ``tokens`` and their ``length``.

    A group is never more than one block. Columns of ``same`` are equal within it and kept,
    without becoming keys that later joins would have to repeat.
    """
    return (
        pieces.groupBy(*keys)
        .agg(
            F.sort_array(F.collect_list(F.struct("lo", "piece"))).alias("parts"),
            F.sum(F.size("piece")).alias("length"),
            *[F.first(c).alias(c) for c in same],
        )
        .select(*keys, *same, "length", F.flatten(F.col("parts.piece")).alias("tokens"))
    )


def join_pieces(pieces: DataFrame, keys: list[str], block_len: int, same: list[str] = []) -> DataFrame:
    """The whole blocks among the assembled pieces."""
    return assemble(pieces, keys, same).where(F.col("length") == block_len).drop("length")


def pack_blocks(
    df: DataFrame,
    block_len: int,
    *,
    group: list[str] = ["dataset"],
    local: list[str] | None = None,
) -> DataFrame:
    """Contiguous, non-overlapping blocks of ``block_len`` tokens; the incomplete tail is dropped.

    Needs ``token_start``, ``num_tokens`` and ``tokens``. When the rows are already
    exchanged on (group, ``local``) and know their chunk's token range - as
    :func:`index_sequences` leaves them - blocks that lie inside a chunk are joined where
    they are, and only the pieces of blocks that straddle chunks are exchanged.
    """
    _check_len(block_len)
    keys = [*group, "block_id"]
    if not local:
        return join_pieces(cut_pieces(df, block_len, keep=group), keys, block_len)

    inner_first = div(F.col("chunk_first") + (block_len - 1), block_len)
    inner_past = div(F.col("chunk_past"), block_len)
    inner = cut_pieces(
        df, block_len, keep=[*group, *local], blocks_from=inner_first, blocks_before=inner_past
    )
    whole = join_pieces(inner, [*group, *local, "block_id"], block_len).select(*keys, "tokens")

    first, past = _span(block_len)
    touching = df.where((first < inner_first) | (past > inner_past))
    straddling = cut_pieces(touching, block_len, keep=[*group, "chunk_first", "chunk_past"]).where(
        (F.col("block_id") < inner_first) | (F.col("block_id") >= inner_past)
    )
    return whole.unionByName(join_pieces(straddling, keys, block_len))


def get_blocks(df: DataFrame, wanted: DataFrame, block_len: int, group: list[str] = ["dataset"]) -> DataFrame:
    """The blocks named by ``wanted`` (group columns and ``block_id``), each once.

    A block outside its dataset fails the job. The tokens wanted reach the scan of a stored
    table as ranges of ``token_start``; which of the rows near them the blocks need is found
    from ids and offsets alone, and only those sequences are cut, at those blocks.
    """
    _check_len(block_len)
    keys = [*group, "block_id"]
    counts = df.groupBy(*group).agg(
        div(F.sum("num_tokens").cast("bigint"), block_len).alias("num_blocks"), F.max("num_tokens").alias("longest")
    )
    name = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    outside = (F.col("block_id") < 0) | (F.col("block_id") >= F.coalesce("num_blocks", F.lit(0)))
    error = F.raise_error(F.concat(F.lit("block out of range: "), name)).cast("bigint")
    checked = (
        wanted.select(*keys)
        .distinct()
        .join(settle(counts, "counts"), group, "left")
        .select(*group, F.when(outside, error).otherwise(F.col("block_id")).alias("block_id"), "longest")
    )
    # a sequence that reaches into a block starts no earlier than the longest one would
    checked = settle(
        checked.withColumns(
            {"low": F.col("block_id") * block_len - F.col("longest") + 1, "high": (F.col("block_id") + 1) * block_len - 1}
        ).drop("longest"),
        "wanted",
    )
    near = df.where(in_ranges(wanted_ranges(checked, group, "low", "high"), group, "token_start"))
    first, past = _span(block_len)
    touched = near.select(*group, "seq_id", F.explode(F.sequence(first, past - 1)).alias("block_id"))
    hits = (
        touched.join(checked, keys, "left_semi")
        .groupBy(*group, "seq_id")
        .agg(F.collect_list("block_id").alias("blocks__"))
    )
    needed = near.join(settle(hits, "hits"), [*group, "seq_id"])
    pieces = needed.select(*group, F.inline(F.transform("blocks__", _piece(block_len))))
    return join_pieces(pieces, keys, block_len)


def block_numbering(counts: DataFrame, position: str = "ds_idx") -> DataFrame:
    """Add ``first_block``: where each mix entry's blocks start in the common numbering.

    ``counts`` has one row per mix entry. Weights play no part in this mode.
    """
    return running_totals(
        counts, group=[], chunk=[], order=[position], totals={"first_block": F.col("num_blocks")}
    )


def resolve_global_blocks(numbering: DataFrame, ids: DataFrame, global_id: str = "global_id") -> DataFrame:
    """Map a common block number to its mix entry and local ``block_id``; out of range fails.

    The numbering has one row per mix entry, so it travels as one array value.
    """
    entries = numbering.agg(
        F.sort_array(F.collect_list(F.struct("first_block", "ds_idx", "dataset", "num_blocks")))
    ).scalar()
    wanted = F.col(global_id)
    hit = F.get(
        F.filter(
            F.col("entries__"),
            lambda e: (e["first_block"] <= wanted) & (wanted < e["first_block"] + e["num_blocks"]),
        ),
        F.lit(0),
    )
    return (
        ids.withColumn("entries__", entries)
        .withColumn("hit__", hit)
        .withColumn(
            "block_id",
            F.when(
                F.col("hit__").isNull(),
                F.raise_error(F.concat(F.lit("block out of range: "), wanted.cast("string"))).cast("bigint"),
            ).otherwise(wanted - F.col("hit__.first_block")),
        )
        .withColumns({"ds_idx": F.col("hit__.ds_idx"), "dataset": F.col("hit__.dataset")})
        .drop("entries__", "hit__")
    )


def to_samples(blocks: DataFrame, block_len: int) -> DataFrame:
    """Model inputs and the labels one token ahead, both ``block_len - 1`` long."""
    return blocks.withColumns(
        {
            "input_ids": F.slice("tokens", 1, block_len - 1).cast("array<bigint>"),
            "labels": F.slice("tokens", 2, block_len - 1).cast("array<bigint>"),
        }
    ).drop("tokens")


def pack_cyclic(
    df: DataFrame,
    block_len: int,
    num_blocks: Column | int,
    start_seq: int = 0,
    group: list[str] = ["dataset"],
) -> DataFrame:
    """The first ``num_blocks`` blocks of the endless stream that begins at ``start_seq`` and wraps.

    Going round a cycle only shifts offsets, so a sequence's place in lap ``e`` is its own
    offset, rotated, plus ``e`` times the dataset's tokens. ``num_blocks`` may refer to the
    columns of :func:`block_counts`; a whole lap too many is never made.
    """
    _check_len(block_len)
    num_blocks = F.lit(num_blocks) if isinstance(num_blocks, int) else num_blocks
    counts = block_counts(df.select(*group, "num_tokens"), block_len, group)
    begin = counts.withColumns(
        {"limit__": num_blocks.cast("bigint"), "seq_id": F.pmod(F.lit(start_seq), F.col("num_sequences"))}
    ).join(
        df.select(*group, "seq_id", F.col("token_start").alias("begin__")), [*group, "seq_id"]
    )
    laps = div(F.col("limit__") * block_len + F.col("total_tokens") - 1, F.col("total_tokens"))
    turns = settle(begin.select(*group, "begin__", "total_tokens", "limit__", laps.alias("laps__")), "laps")
    shifted = (
        df.join(turns, group)
        .where(F.col("laps__") > 0)
        .withColumn("lap__", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("laps__") - 1)))
        .withColumn(
            "start__",
            F.pmod(F.col("token_start") - F.col("begin__"), F.col("total_tokens"))
            + F.col("lap__") * F.col("total_tokens"),
        )
    )
    pieces = cut_pieces(shifted, block_len, keep=group, start="start__", blocks_before=F.col("limit__"))
    return join_pieces(pieces, [*group, "block_id"], block_len)


def epoch_order(
    index: DataFrame,
    *,
    seed: int,
    epochs: Column | int,
    start_epoch: int = 0,
    group: list[str] = ["dataset"],
    digits: int = 4,
) -> DataFrame:
    """A new seeded order of the sequences for every epoch: adds ``epoch`` and ``rank``.

    ``index`` should be narrow (ids and sizes, no tokens). ``epochs`` may be a column.
    Chunks are the first ``digits`` hex digits of the shuffle key.
    """
    epochs = F.lit(epochs) if isinstance(epochs, int) else epochs
    shuffled = (
        index.withColumn(
            "epoch", F.explode(F.sequence(F.lit(start_epoch).cast("bigint"), epochs.cast("bigint") + (start_epoch - 1)))
        )
        .withColumn("shuffle_key", seeded_digest(F.lit(seed) + F.col("epoch"), F.col("seq_id")))
        .withColumn("shuffle_chunk", F.substring("shuffle_key", 1, digits))
    )
    return running_totals(
        shuffled,
        group=[*group, "epoch"],
        chunk=["shuffle_chunk"],
        order=["shuffle_key", "seq_id"],
        totals={"rank": F.lit(1)},
    )


def stride_shards(ranked: DataFrame, counts: DataFrame, workers: int, group: list[str] = ["dataset"]) -> DataFrame:
    """Add ``shard``: every ``stride``-th sequence of the epoch's order.

    ``counts`` has ``num_sequences`` per dataset, best as a settled table. ``stride`` is the worker count, or the sequence count when there are more workers.
    """
    stride = F.least(F.lit(workers).cast("bigint"), F.col("num_sequences"))
    return (
        ranked.join(counts.select(*group, "num_sequences"), group)
        .withColumns({"stride": stride, "shard": F.col("rank") % stride})
        .drop("num_sequences")
    )


def shard_workers(df: DataFrame, workers: int) -> DataFrame:
    """One row per worker reading the shard: surplus workers repeat ``worker % stride``."""
    return df.withColumn(
        "worker", F.explode(F.sequence(F.col("shard"), F.lit(workers - 1).cast("bigint"), F.col("stride")))
    )


def worker_positions(
    index: DataFrame,
    *,
    seed: int,
    workers: int,
    epochs: Column | int,
    start_epoch: int = 0,
    group: list[str] = ["dataset"],
    counts: DataFrame | None = None,
) -> DataFrame:
    """Where each sequence starts in its shard's stream, epoch after epoch.

    A narrow table (no tokens): group, ``epoch``, ``rank``, ``seq_id``, ``num_tokens``,
    ``shard``, ``stride``, ``stream_start``. The remainder of one epoch runs on into the next.
    """
    if counts is None:
        counts = settle(index.groupBy(*group).agg(F.count("*").alias("num_sequences")), "counts")
    ranked = epoch_order(index, seed=seed, epochs=epochs, start_epoch=start_epoch, group=group)
    sharded = stride_shards(ranked, counts, workers, group)
    return running_totals(
        sharded,
        group=[*group, "shard"],
        chunk=["epoch", "shuffle_chunk"],
        order=["rank"],
        totals={"stream_start": F.col("num_tokens")},
    ).drop("shuffle_key", "shuffle_chunk")


def pack_positions(
    tokens: DataFrame,
    positions: DataFrame,
    block_len: int,
    *,
    group: list[str] = ["dataset"],
    blocks_from: Column | None = None,
    blocks_before: Column | None = None,
) -> DataFrame:
    """Blocks of every shard's stream: group, ``shard``, ``stride``, ``block_id``, ``tokens``."""
    _check_len(block_len)
    positions = positions.drop("num_tokens")
    placed = tokens.select(*group, "seq_id", "num_tokens", "tokens").join(positions, [*group, "seq_id"])
    keys = [*group, "shard"]
    pieces = cut_pieces(
        placed, block_len, keep=[*keys, "stride"], start="stream_start", blocks_from=blocks_from, blocks_before=blocks_before
    )
    return join_pieces(pieces, [*keys, "block_id"], block_len, same=["stride"])


def pack_worker_streams(
    tokens: DataFrame,
    block_len: int,
    *,
    seed: int,
    workers: int,
    epochs: int,
    start_epoch: int = 0,
    start_block: int = 0,
    group: list[str] = ["dataset"],
) -> DataFrame:
    """Each worker's blocks over ``epochs`` reshuffled passes through its shard.

    Resuming passes the epoch to start from and the blocks of that stream to leave out.
    """
    index = tokens.select(*group, "seq_id", "num_tokens")
    positions = worker_positions(
        index, seed=seed, workers=workers, epochs=epochs, start_epoch=start_epoch, group=group
    )
    blocks = pack_positions(tokens, positions, block_len, group=group)
    return shard_workers(blocks.where(F.col("block_id") >= start_block), workers).drop("stride", "shard")
