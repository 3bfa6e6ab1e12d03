"""Benchmark decontamination by suffix arrays over shards of the training texts.

Every task cuts its documents into shards of whole texts and builds a suffix array of each:
the places in the shard, ordered by the words that follow. The suffixes of the test items are
looked up in it by binary search. What comes back are the longest verbatim matches and where
they are; windows of 13 words decide which documents go.

Nothing is shuffled. The tests are broadcast in blocks of at most ``BLOCK_WORDS`` words; with
more than one block, the documents are read once for each.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tokenloom.llm import words
from tokenloom.llm.names import free_name
from tokenloom.session import settle

#: Words of test items that a task holds at a time.
BLOCK_WORDS = 4_000_000
#: Words of a shard, at least one text.
SHARD_WORDS = 1_000_000
WINDOW = 13

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),  # [first word, word after] of hit passages
        T.StructField("items", T.ArrayType(T.LongType())),
        T.StructField("longest", T.LongType()),  # words of the longest verbatim match
    ]
)
_FOUND_ARROW = pa.struct(
    [("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.int64())), ("longest", pa.int64())]
)


class Tests(NamedTuple):
    """Windows of the test items: distinct keys, and where the items have them."""

    keys: np.ndarray  # distinct windows as bytes, padded with zeros
    sizes: np.ndarray  # words of each distinct window
    lead: int  # words that are looked at to leave a suffix out
    heads: np.ndarray  # sorted hashes of the first words of all windows
    window: np.ndarray  # distinct window of each test suffix
    item: np.ndarray  # its item
    place: np.ndarray  # its place in all test words, with a gap between items


def _keys(matrix: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(matrix.astype(">u8")).view(f"S{8 * matrix.shape[1]}").ravel()


def _prepare(items: list[tuple[int, np.ndarray]], window: int) -> Tests:
    rows, sizes, owner, place, at = [], [], [], [], 0
    for item, hashes in items:
        width = min(window, len(hashes))
        for start in range(len(hashes) - width + 1 if width else 0):
            row = np.zeros(window, np.uint64)
            row[:width] = hashes[start : start + width]
            rows.append(row)
            sizes.append(width)
            owner.append(item)
            place.append(at + start)
        at += len(hashes) + 1
    matrix = np.array(rows, np.uint64).reshape(-1, window)
    sizes = np.array(sizes, np.int64)
    keys, first, inverse = np.unique(_keys(matrix), return_index=True, return_inverse=True)
    lead = int(min(3, sizes.min())) if len(sizes) else 1
    heads = np.unique([words.windows(row[:lead], lead)[0] for row in matrix[first]]) if len(first) else np.zeros(0, np.uint64)
    return Tests(keys, sizes[first], lead, heads, inverse.astype(np.int64), np.array(owner, np.int64), np.array(place, np.int64))


def _suffix_array(hashes: np.ndarray, until: np.ndarray, places: np.ndarray, window: int):
    """``places`` in the order of the words that follow, and these words as sorted keys.

    ``until`` is the end of the text around each word; words beyond it read as zero.
    """
    ahead = places[:, None] + np.arange(window)
    matrix = hashes[np.minimum(ahead, len(hashes) - 1)]
    matrix[ahead >= until[places][:, None]] = 0
    keys = _keys(matrix)
    order = np.argsort(keys, kind="stable")
    return places[order], keys[order]


def _search(hashes: np.ndarray, first: np.ndarray, tests: Tests, window: int):
    """(place in the shard, distinct window) of all occurrences of test windows."""
    none = np.zeros(0, np.int64)
    if len(hashes) < tests.lead or not len(tests.keys):
        return none, none
    until = np.repeat(first[1:], np.diff(first))
    # suffixes whose first words no test window starts with cannot match: they stay out of the array
    heads = words.windows(hashes, tests.lead)
    table = np.zeros(1 << 16, bool)
    table[tests.heads >> np.uint64(48)] = True
    places = np.flatnonzero(table[heads >> np.uint64(48)])
    places = places[np.isin(heads[places], tests.heads)]
    places = places[places + tests.lead <= until[places]]
    if not len(places):
        return none, none
    places, keys = _suffix_array(hashes, until, places, window)
    low = np.searchsorted(keys, tests.keys, "left")
    # the first suffix beyond all that begin with the window
    tail = np.frombuffer(tests.keys.tobytes(), np.uint8).reshape(len(tests.keys), -1).copy()
    tail[np.arange(8 * window) >= 8 * tests.sizes[:, None]] = 255
    high = np.searchsorted(keys, tail.view(f"S{8 * window}").ravel(), "right")
    count = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(count)), count)
    begin = np.cumsum(count) - count
    return places[np.arange(len(which)) - begin[which] + low[which]], which


def _longest(place: np.ndarray, which: np.ndarray, doc: np.ndarray, tests: Tests, by_window) -> dict[int, int]:
    """Words of the longest verbatim match in each document that has one."""
    order, first = by_window
    count = first[which + 1] - first[which]
    hit = np.repeat(np.arange(len(which)), count)
    begin = np.cumsum(count) - count
    suffix = order[np.arange(len(hit)) - begin[hit] + first[which][hit]]
    diagonal, at = place[hit] - tests.place[suffix], place[hit]
    row = np.lexsort((at, diagonal, doc[hit]))
    hit, suffix, diagonal, at = hit[row], suffix[row], diagonal[row], at[row]
    fresh = np.r_[True, (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1) | (doc[hit][1:] != doc[hit][:-1])]
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.r_[starts, len(at)]) - 1 + tests.sizes[tests.window[suffix[starts]]]
    out: dict[int, int] = {}
    for d, size in zip(doc[hit][starts].tolist(), sizes.tolist()):
        out[d] = max(out.get(d, 0), size)
    return out


def _merged(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _shards(column: pa.Array):
    """(rows, word hashes, first word of each row) of whole texts, about SHARD_WORDS at a time."""
    rows, parts, first = [], [], [0]
    for chunk in words.split(column, words.PLAIN_WORDS):
        rows.extend(chunk.rows)
        first.extend((first[-1] + chunk.first[1:]).tolist())
        parts.append(chunk.hashes)
        if first[-1] >= SHARD_WORDS:
            yield rows, np.concatenate(parts), np.array(first)
            rows, parts, first = [], [], [0]
    if rows:
        yield rows, np.concatenate(parts), np.array(first)


def _find(shared, window: int, text_at: int, found: str):
    """Appends the struct FOUND to every row; a struct that is there already is added to."""

    def run(batches):
        tests = shared.value
        order = np.argsort(tests.window, kind="stable")
        first_of = np.searchsorted(tests.window[order], np.arange(len(tests.keys) + 1))
        for batch in batches:
            out = [None] * batch.num_rows
            for rows, hashes, first in _shards(batch.column(text_at)):
                place, which = _search(hashes, first, tests, window)
                doc = np.searchsorted(first, place, "right") - 1
                edges = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(edges, place, 1)
                np.add.at(edges, place + tests.sizes[which], -1)
                inside = np.r_[0, (np.cumsum(edges[:-1]) > 0).astype(np.int8), 0]
                longest = _longest(place, which, doc, tests, (order, first_of)) if len(place) else {}
                by_doc = np.argsort(doc, kind="stable")
                parts = np.split(by_doc, np.flatnonzero(np.diff(doc[by_doc])) + 1) if len(doc) else []
                hit = {int(doc[part[0]]): np.unique(which[part]) for part in parts}
                for i, row in enumerate(rows):
                    lo, hi = int(first[i]), int(first[i + 1])
                    spans, items = [], []
                    if i in hit:
                        bits = np.r_[0, inside[lo + 1 : hi + 1], 0]
                        turns = np.flatnonzero(np.diff(bits))
                        spans = turns.reshape(-1, 2).tolist()
                        own = np.concatenate([order[first_of[w] : first_of[w + 1]] for w in hit[i]])
                        items = np.unique(tests.item[own])
                        items = items[items != NO_ITEM].tolist()
                    out[row] = {"n_words": hi - lo, "spans": spans, "items": items, "longest": longest.get(i, 0)}
            names = batch.schema.names
            if names[-1] == found:
                for new, old in zip(out, batch.column(batch.num_columns - 1).to_pylist()):
                    new["spans"] = _merged(new["spans"] + old["spans"])
                    new["items"] = sorted({*new["items"], *old["items"]})
                    new["longest"] = max(new["longest"], old["longest"])
                batch = batch.select(names[:-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, _FOUND_ARROW)], [*batch.schema.names, found])

    return run


#: Stands for a NULL item id: its windows hit words, but it is not listed.
NO_ITEM = np.iinfo(np.int64).min


def find_matches(
    docs: DataFrame, tests: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS, found: str = "__found",
) -> DataFrame:
    """``docs`` with a struct ``found``, a name that they do not have: n_words, spans, items, longest.

    ``spans`` are the hit passages as [first word, word after], in order and merged; ``items``
    the distinct ids of the test items with a window in the text; ``longest`` the words of the
    longest verbatim match of any item (0 without a window). A test item shorter than the
    window is one window; an item without words has none. NULL texts have no words.
    """

    def item_words(batches):
        for batch in batches:
            hashes = [c.hashes[c.of(i)].tobytes() for c in words.split(batch.column(1), words.PLAIN_WORDS) for i in range(len(c.rows))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hashes, pa.binary()), pa.array([len(h) // 8 for h in hashes], pa.int64())],
                ["item", "words", "n"],
            )

    texts = tests.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    items = settle(texts.mapInArrow(item_words, "item long, words binary, n long"), "test-items")
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_words))
    out = docs
    schema = T.StructType([*docs.schema.fields, T.StructField(found, FOUND)])
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block)
        held = [(NO_ITEM if r["item"] is None else r["item"], np.frombuffer(r["words"], np.uint64)) for r in part.collect()]
        shared = docs.sparkSession.sparkContext.broadcast(_prepare(held, window))
        out = out.mapInArrow(_find(shared, window, docs.columns.index(text_col), found), schema)
        if block + 1 < blocks:
            out = settle(out, "matches")
    return out


def n_hit(found: str = "__found"):
    """Words of the document inside any occurrence of a window."""
    return F.aggregate(f"{found}.spans", F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])


def is_contaminated(found: str = "__found", share: int = 20):
    """Some word is hit, and at least one of ``share`` words is."""
    return (n_hit(found) > 0) & (n_hit(found) * share >= F.col(f"{found}.n_words"))


def contamination(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated, longest, spans."""
    ids = F.array_join(F.array_sort(F.col("__found.items").cast("array<string>")), ",")
    found = find_matches(docs.select(id_col, F.col(text_col).cast("string").alias("text")), tests)
    return found.select(
        id_col,
        F.col("__found.n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size("__found.items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
        F.col("__found.longest").alias("longest"),
        F.col("__found.spans").alias("spans"),
    )


def decontaminate(docs: DataFrame, tests: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns only."""
    found = free_name(docs, "__found")
    return find_matches(docs, tests, text_col, found=found).where(~is_contaminated(found)).select(*docs.columns)
