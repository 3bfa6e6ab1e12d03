"""Rough counts of hashed items in a table of fixed size, for rarest-first orders.

The filters of a similarity join are right under any order that all rows share; a good order
only makes them sharper. So the counts may be kept by hash bucket: the table never grows with
the corpus, common items stand out at any size, and all rows are counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PART = 1 << 16
#: Groups a part is added up in, level by level.
LEVELS = (1024, 32, 1)


def bucket_counts(df: DataFrame, items: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int = 21) -> np.ndarray:
    """Counts of all hashes that ``items`` yields for the rows of ``df``, by the hash's top ``bits``.

    Every task counts into one table; the tables are added up part by part and level by level,
    so that a group holds few of them. The result has 2**bits numbers, whatever the input.
    """
    size, shift = 1 << bits, np.uint64(64 - bits)
    part = min(PART, size)

    def count(batches):
        total, held, waiting = np.zeros(size, np.int64), [], 0
        for hashes in (h for batch in batches for h in items(batch)):
            held.append(hashes)
            waiting += len(hashes)
            if waiting >= size:
                total += np.bincount((np.concatenate(held) >> shift).astype(np.int64), minlength=size)
                held, waiting = [], 0
        if waiting:
            total += np.bincount((np.concatenate(held) >> shift).astype(np.int64), minlength=size)
        if total.any():
            blocks = total.reshape(-1, part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array([_packed(b) for b in blocks], pa.binary())],
                ["part", "counts"],
            )

    def add(key, table):
        total = sum(_unpacked(block.as_py(), part) for block in table.column("counts"))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "salt": pa.array([key[1].as_py()], pa.int32()), "counts": pa.array([_packed(total)], pa.binary())})

    level = df.mapInArrow(count, "part int, counts binary").withColumn("salt", F.spark_partition_id())
    for salts in LEVELS:
        level = level.withColumn("salt", F.col("salt") % salts).groupBy("part", "salt").applyInArrow(add, "part int, salt int, counts binary")
    out = np.zeros(size, np.int64)
    for row in level.collect():
        out[row["part"] * part : (row["part"] + 1) * part] = _unpacked(row["counts"], part)
    return out


def _packed(counts: np.ndarray) -> bytes:
    return pa.compress(counts.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 8 * size, "zstd"), np.int64)
