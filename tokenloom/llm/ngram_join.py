"""Exact Jaccard join of word n-gram sets that skips by the relations between sets.

Every text is a set of hashed n-grams, ordered rarest first. Two sets that reach the threshold
share one of their first few items, so only these are indexed. On top of that prefix index:

* **Index lists are skipped in blocks.** A list is ordered by set size and cut into blocks of
  sizes that can still match; inside a block, the positions of the shared item bound the
  overlap, and entries below the bound are skipped without a look at the sets.
* **Answers are derived from similar sets.** Equal sets are one class from the start. Then
  each set is compared with the pivot it shares most items with; a set linked to its pivot
  takes over the pivot's component. What is left to compute for it are only the entries
  that belong to another component, so a group of near copies costs its size, not its square.

The second step looks at every pair of entries of different components, so the components
are exactly those of all linked pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tokenloom.llm import words
from tokenloom.llm.components import components
from tokenloom.llm.counting import bucket_counts
from tokenloom.llm.names import free_name
from tokenloom.session import settle

def needed_overlap(a, b, percent: int):
    """Smallest intersection of sets of ``a`` and ``b`` items with Jaccard >= percent / 100."""
    return -(-(percent * (a + b)) // (100 + percent))


def shingle_sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes) for every row of a batch whose last column is the text."""
    for chunk in words.split(batch.column(batch.num_columns - 1), words.BLANK_WORDS):
        for row, hashes in zip(chunk.rows, words.windows_of(chunk, size)):
            yield row, words.distinct(hashes)


def _digest(hashes: np.ndarray) -> int:
    """One 64-bit number for a set; equal sets agree."""
    return int(words.signed(words.mix(np.array([words.mix(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))])))[0])


def describe_sets(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """(id, cls, n, prefix): each text's set digest, set size and its rarest items in order."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = bucket_counts(texts.select("text"), lambda batch: (s for _, s in shingle_sets(batch, size)))
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, np.iinfo(np.int32).max).astype(np.int32))
    shift = np.uint64(64 - int(len(counts)).bit_length() + 1)

    def rows(batches):
        for batch in batches:
            counts = shared.value
            cls, sizes, prefixes = [], [], []
            for _, hashes in shingle_sets(batch, size):
                n = len(hashes)
                cls.append(_digest(hashes) if n else None)
                sizes.append(n)
                keep = n - -(-percent * n // 100) + 1 if n else 0
                rarity = counts[(hashes >> shift).astype(np.int64)]
                if keep < n:
                    # ties at the border are settled by the hash, as everywhere
                    near = np.flatnonzero(rarity <= np.partition(rarity, keep - 1)[keep - 1])
                    hashes, rarity = hashes[near], rarity[near]
                prefixes.append(words.signed(hashes[np.lexsort((hashes, rarity))[:keep]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cls, pa.int64()), pa.array(sizes, pa.int32()), pa.array(prefixes, pa.list_(pa.int64()))],
                ["id", "cls", "n", "prefix"],
            )

    return texts.mapInArrow(rows, "id long, cls long, n int, prefix array<long>")


def _shared_entries(batches):
    """The entries of lists that several sets share; reads entries in the order of tokens, one list after the other."""
    held, before = None, None  # the newest entry, and the token ahead of it
    names = ("token", "block", "n", "cls", "place")
    for batch in batches:
        part = [batch.column(c).to_numpy() for c in names]
        if not len(part[0]):
            continue
        if held is not None:
            part = [np.concatenate((h, p)) for h, p in zip(held, part)]
        token = part[0]
        same = np.r_[before is not None and before == token[0], token[1:] == token[:-1]]
        keep = same | np.r_[same[1:], False]
        keep[-1] = False  # shows with the next entry
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in part], list(names))
        if len(token) > 1:
            before = token[-2]
        held = [x[-1:] for x in part]
    if held is not None and before is not None and before == held[0][0]:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], list(names))


def _pivot_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b): each set with one pivot to be compared with.

    The pivot of a list's block is the set with most shared entries: of a text and its altered
    copies that is the text, as every change takes entries away. A set's pivot is the one it
    meets in most lists where sizes and positions allow a match.
    """
    weight = entries.groupBy("cls").agg(F.count("*").alias("weight"))
    weighed = entries.join(weight, "cls")
    top = F.max_by(F.struct(F.col("cls").alias("pivot"), F.col("n").alias("pn"), F.col("place").alias("pp")), F.struct("weight", "cls"))
    pivots = weighed.groupBy("token", "block").agg(top.alias("top"), F.count("*").alias("size")).where("size > 1")
    met = entries.join(pivots.select("token", "block", "top.*"), ["token", "block"]).where("cls <> pivot")
    reach = F.least("place", "pp") + F.least(F.col("n") - F.col("place"), F.col("pn") - F.col("pp"))
    met = met.where(reach * (100 + percent) >= (F.col("n") + F.col("pn")) * percent)
    pairs = met.groupBy("cls", "pivot").count()
    return pairs.groupBy(F.col("cls").alias("a")).agg(F.max_by("pivot", F.struct("count", "pivot")).alias("b"))


def _foreign_pairs(told: DataFrame, percent: int) -> DataFrame:
    """(a, b): candidates of different components.

    ``told`` are entries with a ``comp``. Sets of nx and ny items that overlap in ``need`` items
    share one among the first nx - need + 1 of one and the first ny - need + 1 of the other, in
    the common order; entries at later positions are skipped. Within a list, the entries of the
    component with most entries are compared with the others only, and blocks of sizes that
    cannot match are not met.
    """
    per = told.groupBy("token", "comp").count()
    lists = per.groupBy("token").agg(F.max_by("comp", F.struct("count", "comp")).alias("major"), F.count("*").alias("comps"))
    told = settle(told.join(lists.where("comps > 1").select("token", "major"), "token"), "ngram-told")
    x = told.where("comp <> major").select(
        "token", F.col("cls").alias("x"), F.col("n").alias("xn"), F.col("place").alias("xp"), F.col("comp").alias("xc"),
        F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"),
    )
    y = told.select(
        "token", "block", F.col("cls").alias("y"), F.col("n").alias("yn"), F.col("place").alias("yp"),
        F.col("comp").alias("yc"), (F.col("comp") == F.col("major")).alias("in_major"),
    )
    total = (F.col("xn") + F.col("yn")) * percent
    need = F.floor((total + (99 + percent)) / (100 + percent))
    ok = (F.col("xc") != F.col("yc")) & (F.col("in_major") | (F.col("x") < F.col("y")))
    ok &= (F.col("xp") <= F.col("xn") - need) & (F.col("yp") <= F.col("yn") - need)
    pairs = x.join(y, ["token", "block"]).where(ok)
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _promising(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose indexed items leave room for the threshold.

    Beyond the items that both index, two sets can only share what one of them does not index.
    """
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    ends = sets.join(ends, "cls", "left_semi").groupBy("cls").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    ends = settle(ends, "ngram-prefixes")
    side = lambda s: ends.select(F.col("cls").alias(s), F.col("n").alias(f"n_{s}"), F.col("prefix").alias(f"prefix_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    rest = F.greatest(F.col("n_a") - F.size("prefix_a"), F.col("n_b") - F.size("prefix_b"))
    most = F.size(F.array_intersect("prefix_a", "prefix_b")) + rest
    return both.where(most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets reach the threshold."""
    left = sets.select(F.col("cls").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("items").alias("items_b"))

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("items_a"), batch.column("items_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "items_a", "items_b").mapInArrow(check, "a long, b long")


def _sets_of(docs: DataFrame, wanted: DataFrame, text_col: str, size: int) -> DataFrame:
    """(cls, items) of the classes in ``wanted`` (cls), and of a few others, read from the texts again.

    A table of hash buckets, of fixed size, keeps most other sets back; the join with
    ``wanted`` is left to the caller.
    """
    hashed = lambda numbers: words.mix(numbers.view(np.uint64))
    counts = bucket_counts(wanted.select("cls"), lambda batch: iter([hashed(batch.column(0).to_numpy())]))
    shared = docs.sparkSession.sparkContext.broadcast(counts > 0)
    shift = np.uint64(64 - int(len(counts)).bit_length() + 1)

    def rows(batches):
        for batch in batches:
            found = [(_digest(s), s.tobytes()) for _, s in shingle_sets(batch, size) if len(s)]
            cls = np.array([d for d, _ in found], np.int64)
            known = np.flatnonzero(shared.value[(hashed(cls) >> shift).astype(np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls[known]), pa.array([found[i][1] for i in known.tolist()], pa.binary())], ["cls", "items"]
            )

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(rows, "cls long, items binary").dropDuplicates(["cls"])


def ngram_jaccard_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85
) -> DataFrame:
    """One row per text: its id, ``n_shingles``, ``component_id`` and ``class_id``.

    Texts link when the Jaccard similarity of their sets of ``size``-word shingles is at least
    ``percent`` / 100; ``component_id`` is the smallest id that links reach, the text's own
    included, and ``class_id`` the smallest id with the very same set. A text of fewer words
    is one shingle; one without words (NULL included) has none and links with nothing, its
    component is its own id. A NULL id is never a component unless nothing else is in it. A
    repeated id counts as texts of their own. Other columns are ignored. Sets are compared by 64-bit hashes.
    """
    sets = settle(describe_sets(docs, id_col, text_col, size, percent), "ngram-sets")
    # prefixes are written once, with the sets
    classes = sets.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    block = F.floor(F.log("n") / math.log(100 / percent) + 1e-9).cast("int").alias("block")
    entries = classes.select("cls", "n", block, F.posexplode("prefix").alias("place", "token"))
    entries = entries.repartition("token").sortWithinPartitions("token")
    entries = settle(entries.mapInArrow(_shared_entries, "token long, block int, n int, cls long, place int"), "ngram-lists")
    members = settle(sets.where("n > 0").groupBy("cls").agg(F.min("id").alias("id")), "ngram-classes")

    # 1: each set with the pivot it shares most items with
    pairs = settle(_pivot_pairs(entries, percent), "ngram-pivots")
    first = _links(docs, pairs, text_col, size, percent)

    # 2: entries of lists that still hold several components
    labels = settle(components(first), "ngram-labels").withColumnRenamed("id", "cls")
    told = entries.join(labels, "cls", "left").withColumn("comp", F.coalesce("component", "cls")).drop("component")
    found = settle(_promising(settle(_foreign_pairs(told, percent), "ngram-foreign"), sets, percent), "ngram-pairs")
    second = _links(docs, found, text_col, size, percent)
    links = settle(first.union(second), "ngram-links")
    labels = components(links)

    known = members.join(labels.withColumnRenamed("id", "cls"), "cls", "left")
    known = known.withColumn("component", F.coalesce("component", "cls"))
    lowest = known.groupBy("component").agg(F.min("id").alias("component_id"))
    known = known.join(lowest, "component").select("cls", F.col("id").alias("class_id"), "component_id")
    out = sets.select("id", "cls", "n").join(known, "cls", "left")
    own = F.col("n") > 0
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(own, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.when(own, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group: the one whose id names the component.

    Documents without words are groups of their own. Rows that repeat the id and the text of a
    kept document are one with it; a repeated id stays with all its texts when one of them
    stays. Rows with a NULL id stay when their group has no id; equal ones among them are one.
    """
    classes = ngram_jaccard_classes(docs, id_col, text_col, size, percent)
    name = free_name(docs, "__kept")
    kept = classes.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias(name)).distinct()
    rows = docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(name)), "left_semi")
    return rows.dropDuplicates([id_col, text_col])


def _links(docs, pairs, text_col, size, percent) -> DataFrame:
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    return settle(_verified(pairs, _sets_of(docs, ends, text_col, size), percent), "ngram-links")
