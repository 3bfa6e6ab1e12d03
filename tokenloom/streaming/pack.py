"""Packing a live stream: every micro-batch continues each dataset's token stream.

A dataset's place in its stream is Spark's keyed state: its token count and the tokens of
its unfinished block, less than one block, however many micro-batches went by. State and
output share the query's checkpoint, so a restart goes on from the last committed batch and
a replayed batch starts from the state that it started from before.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = T.StructType(
    [
        T.StructField("total_tokens", T.LongType()),
        T.StructField("tail", T.ArrayType(T.IntegerType())),
    ]
)

PACKED = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("lane", T.IntegerType()),
        T.StructField("block_id", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.IntegerType())),
    ]
)

# Blocks handed back to Spark at a time.
_BLOCKS = 256

# Rows of an Arrow batch between Spark and Python. Spark gathers that many blocks before it
# hands them over, as Python numbers, so its usual ten thousand would be a gigabyte in every task.
_BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", 512)


def pack_stream(
    stream: DataFrame,
    block_len: int,
    *,
    target: str,
    checkpoint: str,
    key: str,
    tokens: Column | None = None,
    lanes: int = 1,
) -> StreamingQuery:
    """Pack ``dataset``, ``key``, ``tokens`` rows into whole blocks under ``target``.

    The order of a dataset's stream is micro-batch by micro-batch, by ``key`` within one; rows
    may carry text instead, with ``tokens`` the expression that makes the one from the other.
    A dataset's part of a micro-batch is laid out by one task, so bound the micro-batches at
    the source (``read_stream``'s ``max_files`` and ``max_bytes``), and deal a dataset that is
    too much for one task into ``lanes`` by its keys' hash: every lane is a stream of its own.
    """
    if block_len <= 0 or lanes <= 0:
        raise ValueError(f"block length and lanes must be positive, got {block_len} and {lanes}")
    rows = stream.select(
        "dataset",
        F.pmod(F.xxhash64(key), F.lit(lanes)).cast("int").alias("lane"),
        F.col(key).alias("key"),
        (F.col("tokens") if tokens is None else tokens).cast("array<int>").alias("tokens"),
    )
    blocks = rows.groupBy("dataset", "lane").applyInPandasWithState(
        _continue_stream(block_len), PACKED, STATE, "append", GroupStateTimeout.NoTimeout
    )
    writer = blocks.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    # a query runs on a copy of the session's settings, taken as it starts
    name, rows_per_batch = _BATCH_ROWS
    spark = stream.sparkSession
    usual = spark.conf.get(name)
    spark.conf.set(name, min(int(usual), rows_per_batch) if int(usual) > 0 else rows_per_batch)
    try:
        return writer.trigger(availableNow=True).start(target)
    finally:
        spark.conf.set(name, usual)


def _continue_stream(block_len: int):
    """The blocks of one stream's part of a micro-batch.

    The tokens wait in a temporary file until all keys are known and are read back in key
    order, so a task holds its keys, one Arrow batch and the blocks it hands back.
    """

    def cut(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.concatenate(held)
        whole = len(ids) // block_len * block_len
        return ids[:whole].reshape(-1, block_len), ids[whole:].copy()

    def packed(group: tuple, first: int, blocks: np.ndarray) -> pd.DataFrame:
        numbers = np.arange(first, first + len(blocks))
        return pd.DataFrame({"dataset": group[0], "lane": np.int32(group[1]), "block_id": numbers, "tokens": list(blocks)})

    def run(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total, tail = state.get if state.exists else (0, [])
        first = (total - len(tail)) // block_len
        with tempfile.TemporaryFile() as waiting:
            keys, lengths = [], []
            for batch in batches:
                ids = [np.asarray(t, np.int32) for t in batch["tokens"]]
                waiting.writelines(ids)
                keys.append(batch["key"].copy())  # a view would hold the whole Arrow batch
                lengths.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            order = pd.concat(keys, ignore_index=True).sort_values(kind="stable").index
            lengths = np.concatenate(lengths)
            starts = lengths.cumsum() - lengths
            held, size = [np.asarray(tail, np.int32)], len(tail)
            for row in order:
                waiting.seek(int(starts[row]) * 4)
                held.append(np.frombuffer(waiting.read(int(lengths[row]) * 4), np.int32))
                size += len(held[-1])
                if size >= _BLOCKS * block_len:
                    blocks, rest = cut(held)
                    yield packed(group, first, blocks)
                    first, held, size = first + len(blocks), [rest], len(rest)
            blocks, rest = cut(held)
            if len(blocks):
                yield packed(group, first, blocks)
        state.update((total + int(lengths.sum()), rest.tolist()))

    return run


def read_packed(spark: SparkSession, target: str) -> DataFrame:
    """All blocks of committed micro-batches."""
    return spark.read.schema(PACKED).parquet(target)
