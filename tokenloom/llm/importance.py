"""Importance resampling: draw the documents that look most like a target collection.

Features are runs of one to three words, hashed into buckets. How much likelier a bucket is in
the target than in the documents is its gain; a document weighs the sum of its features'
gains, and one random number per document turns the highest weights into a draw without
replacement.

Texts are not looked at one by one: those of a chunk are joined with a separator that no word
holds, one pass of a regular expression finds all words, a binary search in the texts' offsets
tells whose they are, and runs that reach into the next text are masked before the buckets are
counted. A run's CRC is put together from those of its words, as a CRC is linear.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.operators.ordering import CHUNKS, chunk_by_order, running_totals
from tokenloom.session import settle

#: Words after A-Z is lower-cased: letters, digits and everything beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Stands between texts.
SENTINEL = b"\n"
CHUNK_BYTES = 1 << 20
#: Longest run of words.
RUN = 3
BUCKETS = 10_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

# Fixed value: the reversed polynomial of CRC-32.
_POLYNOMIAL = 0xEDB88320


def _byte_table() -> np.ndarray:
    """What each byte adds to a CRC."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(_POLYNOMIAL), value >> 1).astype(np.uint32)
    return value


_BYTE = _byte_table()
#: Shifts up to this many bytes have a table of their own; longer ones are put together.
_NEAR = 64


def _shift(crc: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The CRC's four bytes looked up in tables (..., 4, 256) and added."""
    out = tables[0][crc & 255]
    for part in (1, 2, 3):
        out = out ^ tables[part][(crc >> np.uint32(8 * part)) & np.uint32(255)]
    return out


def _shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables for 0 to 63 bytes behind a text, and for 64, 128, 256 ... bytes."""
    table = np.arange(256, dtype=np.uint32) << np.array([[0], [8], [16], [24]], np.uint32)
    near = []
    for _ in range(_NEAR):
        near.append(table)
        table = _BYTE[table & 255] ^ (table >> np.uint32(8))
    far = []
    for _ in range(26):
        far.append(table)
        table = _shift(table, table)
    return np.stack(near), far


_NEAR_SHIFTS, _FAR_SHIFTS = _shift_tables()


def _behind(crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What CRCs of texts add to that of the text with ``sizes`` more bytes."""
    near = sizes & (_NEAR - 1)
    out = np.zeros(len(crc), np.uint32)
    for part in range(4):
        out ^= _NEAR_SHIFTS[near, part, (crc >> np.uint32(8 * part)) & np.uint32(255)]
    for bit, tables in enumerate(_FAR_SHIFTS):
        long = np.flatnonzero(sizes >> (6 + bit) & 1)
        if len(long):
            out[long] = _shift(out[long], tables)
    return out


def _word_crcs(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC of each word: byte by byte for all words together, the rare long ones alone."""
    letters = np.frombuffer(data, np.uint8)
    sizes = ends - starts
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    left = np.flatnonzero(sizes <= _NEAR)
    for place in range(_NEAR):
        left = left[sizes[left] > place]
        if not len(left):
            break
        now = crc[left]
        crc[left] = _BYTE[(now ^ letters[starts[left] + place]) & 255] ^ (now >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes > _NEAR):
        crc[i] = zlib.crc32(data[starts[i] : ends[i]])
    return crc


def chunk_features(texts: list[bytes], run: int = RUN, buckets: int = BUCKETS) -> tuple[np.ndarray, list[np.ndarray]]:
    """(first word of each text and the number of words; for each size of run, the bucket of
    the run that starts at each word, -1 where the text ends before the run does)."""
    data = SENTINEL.join(texts).translate(_LOWER)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    spans = np.array([m.span() for m in WORD.finditer(data)], np.int64).reshape(-1, 2)
    starts, ends = spans[:, 0], spans[:, 1]
    first = np.searchsorted(starts, offsets)
    owner = np.searchsorted(offsets, starts, "right")
    words = _word_crcs(data, starts, ends)
    sizes = ends - starts
    after_blank = _behind(np.full(len(words), zlib.crc32(b" "), np.uint32), sizes) ^ words
    crc, found = words, []
    for more in range(min(run, len(words) or 1)):
        if more:
            crc = _behind(crc[:-1], sizes[more:] + 1) ^ after_blank[more:]
        bucket = np.full(len(words), -1, np.int64)
        whole = owner[: len(words) - more] == owner[more:]
        bucket[: len(whole)][whole] = crc[whole] % buckets
        found.append(bucket)
    return first, found


def _chunks(column: pa.Array) -> Iterator[list[bytes]]:
    """Texts of a bounded number of bytes, or one text; NULL is empty."""
    held, size = [], 0
    for text in column.cast(pa.large_binary()):
        text = text.as_py() or b""
        if held and size + len(text) > CHUNK_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def bucket_counts(texts: DataFrame, text_col: str = "text", run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts. A task hands on one row per bucket, the driver gets as many."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for chunk in _chunks(batch.column(0)):
                for bucket in chunk_features(chunk, run, buckets)[1]:
                    total += np.bincount(bucket[bucket >= 0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "features"])

    counted = texts.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket int, features long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("features").alias("features")).collect():
        out[row["bucket"]] = row["features"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the log of how much likelier it is in the target, floored; counts plus one."""
    all_documents, all_target = (float(int(c.sum()) + len(c)) for c in (documents, target))
    ratio = ((t + 1.0) * all_documents / ((s + 1.0) * all_target) for s, t in zip(documents.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _noise(id_: Column, seed: int) -> Column:
    """A thousand times a Gumbel number made from the id, floored; a NULL id is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def importance(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    seed: int = 42, run: int = RUN, buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_features``, ``weight``, ``score``.

    NULL texts have no words. Repeated rows are documents of their own; other columns are
    ignored. All documents and all target texts are counted, and read once more to be weighed.
    """
    worth = gains(bucket_counts(docs, text_col, run, buckets), bucket_counts(target, target_text_col, run, buckets))

    def weigh(batches):
        for batch in batches:
            words, features, weights = [], [], []
            for chunk in _chunks(batch.column(1)):
                first, found = chunk_features(chunk, run, buckets)
                count, total = np.zeros(first[-1] + 1, np.int64), np.zeros(first[-1] + 1, np.int64)
                for bucket in found:
                    count[1:] += np.cumsum(bucket >= 0)
                    total[1:] += np.cumsum(np.where(bucket >= 0, worth[bucket], 0))
                words.append(np.diff(first))
                features.append(np.diff(count[first]))
                weights.append(np.diff(total[first]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.concatenate([np.zeros(0, np.int64), *c])) for c in (words, features, weights))],
                ["id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    weighed = rows.mapInArrow(weigh, "id long, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + _noise(F.col("id"), seed)).withColumnRenamed("id", id_col)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, id_col: str = "doc_id", **options
) -> DataFrame:
    """:func:`importance` with ``rank``: 1, 2, 3 ... for the documents drawn, NULL for the others.

    Drawn are ``percent`` of the documents with at least ``min_words`` words, those of the
    highest scores; ties go to the smaller id, a NULL id last, then to fewer features. Ranks
    are exact over any number of documents: they are counted chunk by chunk in score order.
    """
    rows = settle(importance(docs, target, id_col=id_col, **options), "importance")
    long_enough = F.col("n_words") >= min_words
    draws = percent * rows.where(long_enough).count() // 100
    order = {"down__": -F.col("score"), "none__": F.col(id_col).isNull(), "id__": F.coalesce(id_col, F.lit(0)), "size__": F.col("n_features")}
    ordered = chunk_by_order(rows.where(long_enough).withColumns(order), [*order], group=[])
    ranked = running_totals(ordered, group=[], chunk=CHUNKS, order=[*order], totals={"rank": F.lit(1)})
    drawn = ranked.withColumn("rank", F.when(F.col("rank") < draws, F.col("rank") + 1)).drop(*order, *CHUNKS)
    return drawn.unionByName(rows.where(~long_enough).withColumn("rank", F.lit(None).cast("long")))


def drawn_documents(docs: DataFrame, ranked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that :func:`resample` drew; ids must be distinct to tell rows apart."""
    return docs.join(ranked.where("rank is not null").select(id_col), id_col, "left_semi")


def resampling_report(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Every document's n_features, weight, score and rank."""
    return resample(docs, target, id_col=id_col, **options).select(id_col, "n_features", "weight", "score", "rank")
