"""Best-fit packing of documents into sequences, under conflicts.

A sequence (bin) holds at most one document of a source and at most one of a duplicate
cluster. Bins are kept in the order of their free room and carry bitmaps of the sources and
clusters in them. A piece looks up the smallest room that takes it and goes on to the next
larger ones until a bin has no conflict: the tightest compatible bin, or a new one.

Placing is one choice after another, so pieces are dealt into many groups of bounded size by
a hash; each group fills bins of its own. Groups do not grow with the corpus, only their number does.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.functions.tokens import HashTokenizer
from tokenloom.session import settle

#: Pieces of a group, on average.
GROUP = 2048
_SCHEMA = "id long, piece long, start long, n_tokens long, bin_id long, position int, offset long"


def best_fit(pieces: list[tuple[int, object, object]], capacity: int) -> list[tuple[int, int, int]]:
    """(bin, position, offset) of each (size, source, cluster), placed in the given order.

    NULL sources and clusters conflict with nothing; no size is above ``capacity``.
    """
    bits = [{}, {}]
    room: list[tuple[int, int]] = []  # (free tokens, bin), in order
    held: list[list[int]] = []  # bitmap of sources, bitmap of clusters, pieces
    out = []
    for size, *keys in pieces:
        marks = [0 if k is None else 1 << known.setdefault(k, len(known)) for known, k in zip(bits, keys)]
        at = bisect_left(room, (size, -1))
        while at < len(room) and (held[room[at][1]][0] & marks[0] or held[room[at][1]][1] & marks[1]):
            at += 1
        if at < len(room):
            free, number = room.pop(at)
        else:
            free, number = capacity, len(held)
            held.append([0, 0, 0])
        own = held[number]
        out.append((number, own[2], capacity - free))
        held[number] = [own[0] | marks[0], own[1] | marks[1], own[2] + 1]
        if free > size:
            insort(room, (free - size, number))
    return out


def same_text(text: Column) -> Column:
    """A cluster key that texts share when they differ at most in case and blanks; NULL without words."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
    return F.when(plain != "", F.xxhash64(plain))


def pack_best_fit(
    docs: DataFrame, capacity: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    cluster: Column | None = None, tokenizer: HashTokenizer = HashTokenizer(), group: int = GROUP,
) -> DataFrame:
    """One row per piece: id, piece, start, n_tokens, bin_id, position, offset.

    A document above ``capacity`` tokens is cut into full pieces and a rest; every token of
    every document is placed once. ``start`` is the piece's first token in the document,
    ``position`` and ``offset`` say where in its bin it lies. ``cluster`` is a column of
    ``docs`` naming duplicates (default: equal up to case and blanks). Within a group pieces
    are placed largest first, ties by id and piece. NULL texts are empty and take the
    tokenizer's end mark; repeated rows are documents of their own; NULL sources and
    clusters conflict with nothing. Tokens are counted inside Spark.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(source_col).cast("string").alias("source"),
        (same_text(text) if cluster is None else cluster).cast("string").alias("cluster"),
        tokenizer.count(text).alias("n"),
    )
    pieces = rows.select(
        "id", "source", "cluster", "n", F.explode(F.sequence(F.lit(0), F.floor((F.greatest("n", F.lit(1)) - 1) / capacity))).alias("piece")
    )
    start = F.col("piece") * capacity
    pieces = settle(
        pieces.select("id", "source", "cluster", F.col("piece").cast("long"), start.cast("long").alias("start"), F.least(F.lit(capacity), F.col("n") - start).cast("long").alias("n_tokens")),
        "pieces",
    )
    groups = max(1, -(-pieces.count() // group))
    number = F.pmod(F.xxhash64("id", "piece", "cluster", "source"), F.lit(groups)).alias("number")

    def place(key, table):
        table = table.sort_by([("n_tokens", "descending"), ("id", "ascending"), ("piece", "ascending"), ("cluster", "ascending")])
        names = ("n_tokens", "source", "cluster")
        found = best_fit(list(zip(*(table.column(c).to_pylist() for c in names))), capacity)
        first = key[0].as_py() << 24
        return pa.table(
            [
                *(table.column(c) for c in ("id", "piece", "start", "n_tokens")),
                pa.array([first + b for b, _, _ in found], pa.int64()),
                pa.array([p for _, p, _ in found], pa.int32()),
                pa.array([o for _, _, o in found], pa.int64()),
            ],
            names=["id", "piece", "start", "n_tokens", "bin_id", "position", "offset"],
        )

    return pieces.groupBy(number).applyInArrow(place, _SCHEMA).withColumnRenamed("id", id_col)


def fill_bins(docs: DataFrame, placed: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: HashTokenizer = HashTokenizer()) -> DataFrame:
    """The sequences themselves: bin_id and its tokens end to end. ``docs`` must have distinct ids."""
    tokens = tokenizer.ids(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    parts = placed.join(docs.select(id_col, F.col(text_col)), id_col)
    part = F.struct("position", F.slice(tokens, (F.col("start") + 1).cast("int"), F.col("n_tokens").cast("int")).alias("tokens"))
    bins = parts.select("bin_id", part.alias("part")).groupBy("bin_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return bins.select("bin_id", F.flatten(F.transform("parts", lambda p: p["tokens"])).alias("tokens"))
