"""Queries over packed blocks: contiguous, random access, cyclic, per worker, streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.operators import packing
from tokenloom.operators.index import index_sequences
from tokenloom.operators.ordering import CHUNKS, chunk_by_key, div
from tokenloom.plans import mix as mixes
from tokenloom.plans.mix import map_samples
from tokenloom.session import scratch_path, settle
from tokenloom.streaming import ingest, pack
from workload.base import (
    BLOCK_LEN,
    BLOCKS_SQL,
    INDEX_SQL,
    SEED,
    SIZES_SQL,
    TOKENIZER,
    WORKERS,
    corpus,
    describe_sql,
    described,
    indexed,
    sizes,
    stored,
    stored_in_buckets,
    stored_in_ranges,
    table,
)

EPOCHS = 2
MANY_WORKERS = 128


def block_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.block_counts(sizes(spark, sf_dir), BLOCK_LEN)


def pack_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored token table cut into blocks, as a training run does it."""
    return described(packing.pack_blocks(stored_in_ranges(spark, sf_dir), BLOCK_LEN), "dataset", "block_id")


def get_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks asked for by the labelled documents: their id, wrapped into their language's range."""
    tokens = stored_in_ranges(spark, sf_dir)
    counts = packing.block_counts(tokens, BLOCK_LEN).where("num_blocks > 0").select("dataset", "num_blocks")
    languages = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("dataset"))
    labelled = table(spark, sf_dir, "labels").join(languages, "doc_id").join(settle(counts, "counts"), "dataset")
    wanted = labelled.select("dataset", (F.col("doc_id") % F.col("num_blocks")).alias("block_id"))
    return described(packing.get_blocks(tokens, wanted, BLOCK_LEN), "dataset", "block_id")


def _mix(counts: DataFrame) -> DataFrame:
    """A mix entry per dataset, in name order; the table is as long as the mix."""
    listed = counts.agg(F.sort_array(F.collect_list("dataset")).alias("names"))
    return listed.select(F.posexplode("names").alias("ds_idx", "dataset"))


def global_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = packing.block_counts(sizes(spark, sf_dir), BLOCK_LEN)
    samples = map_samples(_mix(counts), indexed(spark, sf_dir), BLOCK_LEN, local=CHUNKS)
    return described(samples, "global_id", "ds_idx", "dataset", "block_id", tokens="input_ids")


def resolve_global_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Common block numbers, asked for by the events, back to dataset and local block."""
    counts = packing.block_counts(sizes(spark, sf_dir), BLOCK_LEN)
    numbering = packing.block_numbering(_mix(counts).join(counts, "dataset"))
    total = counts.agg(F.sum("num_blocks")).scalar()
    ids = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % total).alias("global_id"))
    return packing.resolve_global_blocks(numbering, ids)


def samples_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples by common number, asked for by the labelled documents' ids; some numbers come twice."""
    tokens = stored_in_ranges(spark, sf_dir)
    counts = packing.block_counts(tokens, BLOCK_LEN)
    total = counts.agg(F.sum("num_blocks")).scalar()
    wanted = table(spark, sf_dir, "labels").select("doc_id", (F.col("doc_id") * 13 % total).alias("global_id"))
    samples = mixes.samples_at(_mix(counts), tokens, BLOCK_LEN, wanted)
    return described(samples, "doc_id", "global_id", "ds_idx", "dataset", "block_id", tokens="labels")


def to_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = packing.pack_blocks(indexed(spark, sf_dir), BLOCK_LEN, local=CHUNKS)
    samples = packing.to_samples(blocks, BLOCK_LEN)
    inputs = described(samples, "dataset", "block_id", "labels", tokens="input_ids")
    renamed = inputs.select(
        "dataset", "block_id", F.col("tokens_md5").alias("inputs_md5"), F.col("last_id").alias("last_input"), "labels"
    )
    return described(renamed, "dataset", "block_id", "inputs_md5", "last_input", tokens="labels")


def pack_cyclic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Once round and half again, from the eighth sequence."""
    count = F.col("num_blocks") + div(F.col("num_blocks"), 2) + 1
    return described(packing.pack_cyclic(stored(spark, sf_dir), BLOCK_LEN, count, start_seq=7), "dataset", "block_id")


def _index(spark, sf_dir):
    rows = chunk_by_key(sizes(spark, sf_dir), "doc_id")
    return index_sequences(rows, order=["doc_id"]).select("dataset", "seq_id", "num_tokens")


def epoch_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = packing.epoch_order(_index(spark, sf_dir), seed=SEED, epochs=EPOCHS)
    return ranked.select("dataset", "epoch", "seq_id", "rank")


def stride_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More workers than the smallest dataset has sequences: the surplus repeats shards."""
    index = _index(spark, sf_dir)
    counts = settle(index.groupBy("dataset").agg(F.count("*").alias("num_sequences")), "counts")
    ranked = packing.epoch_order(index, seed=SEED, epochs=1)
    shards = packing.stride_shards(ranked, counts, MANY_WORKERS)
    return packing.shard_workers(shards, MANY_WORKERS).select("dataset", "epoch", "worker", "shard", "rank", "seq_id")


def worker_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = packing.pack_worker_streams(
        stored_in_buckets(spark, sf_dir), BLOCK_LEN, seed=SEED, workers=WORKERS, epochs=EPOCHS
    )
    return described(blocks, "dataset", "worker", "block_id")


def resumed_worker_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = packing.pack_worker_streams(
        stored_in_buckets(spark, sf_dir), BLOCK_LEN, seed=SEED, workers=WORKERS, epochs=EPOCHS, start_epoch=1, start_block=2
    )
    return described(blocks, "dataset", "worker", "block_id")


def pack_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arriving in three deliveries; the stream stops and resumes between them."""
    docs = corpus(spark, sf_dir)
    last = docs.agg(F.max("doc_id") + 1).scalar()
    paths = {name: scratch_path(spark, name) for name in ("arrivals", "packed", "pack-checkpoint")}
    for delivery in range(3):
        docs.where(div(F.col("doc_id") * 3, last) == delivery).write.mode("append").parquet(paths["arrivals"])
        arrivals = ingest.read_stream(spark, paths["arrivals"], docs.schema)
        pack.pack_stream(
            arrivals,
            BLOCK_LEN,
            target=paths["packed"],
            checkpoint=paths["pack-checkpoint"],
            key="doc_id",
            tokens=TOKENIZER.ids(F.col("text")),
        ).awaitTermination()
    return described(pack.read_packed(spark, paths["packed"]), "dataset", "block_id")


QUERIES = {
    f.__name__: f
    for f in (
        block_counts,
        pack_blocks,
        get_blocks,
        global_blocks,
        resolve_global_blocks,
        samples_at,
        to_samples,
        pack_cyclic,
        epoch_permutation,
        stride_shards,
        worker_streams,
        resumed_worker_streams,
        pack_stream,
    )
}

COUNTS_SQL = f"""
counts AS (
  SELECT dataset, count(*) AS num_sequences, sum(num_tokens)::BIGINT AS total_tokens,
         (sum(num_tokens)::BIGINT // {BLOCK_LEN})::BIGINT AS num_blocks
  FROM sized GROUP BY dataset)"""

NUMBERING_SQL = f"""{COUNTS_SQL},
numbering AS (
  SELECT (row_number() OVER (ORDER BY dataset) - 1)::INTEGER AS ds_idx, dataset, num_blocks,
         (sum(num_blocks) OVER (ORDER BY dataset ROWS UNBOUNDED PRECEDING) - num_blocks)::BIGINT AS first_block
  FROM counts)"""


def ranked_sql(epochs: int | str, start: int = 0, workers: int = WORKERS) -> str:
    """Sequences in every epoch's order with their shard. ``epochs`` may be an expression."""
    return f"""
ranked AS (
  SELECT *, rank % stride AS shard FROM (
    SELECT dataset, seq_id, num_tokens, tokens, epoch,
           row_number() OVER (PARTITION BY dataset, epoch
                              ORDER BY md5(({SEED} + epoch)::VARCHAR || ':' || seq_id::VARCHAR), seq_id) - 1 AS rank,
           least({workers}, count(*) OVER (PARTITION BY dataset, epoch)) AS stride
    FROM idx, (SELECT unnest(range({start}, {start} + {epochs})) AS epoch)))"""


PLACED_SQL = """
placed AS (
  SELECT *, (sum(num_tokens) OVER (PARTITION BY dataset, shard ORDER BY epoch, rank ROWS UNBOUNDED PRECEDING)
             - num_tokens)::BIGINT AS stream_start
  FROM ranked)"""

STREAMS_SQL = f"""{PLACED_SQL},
stream_flat AS (
  SELECT dataset, shard, stride, stream_start + pos - 1 AS off, tok
  FROM (SELECT dataset, shard, stride, stream_start, unnest(tokens) AS tok, generate_subscripts(tokens, 1) AS pos
        FROM placed)),
stream_blocks AS (
  SELECT dataset, shard, stride, off // {BLOCK_LEN} AS block_id, list(tok ORDER BY off) AS tokens
  FROM stream_flat GROUP BY ALL HAVING count(*) = {BLOCK_LEN})"""


def workers_sql(workers: int = WORKERS) -> str:
    return f"workers AS (SELECT unnest(range({workers})) AS worker)"


ORACLES = {
    "block_counts": f"WITH {SIZES_SQL}, {COUNTS_SQL} SELECT * FROM counts",
    "pack_blocks": f"WITH {BLOCKS_SQL} SELECT dataset, block_id, {describe_sql()} FROM blocks",
    "get_blocks": f"""
        WITH {BLOCKS_SQL}, {COUNTS_SQL},
        wanted AS (SELECT DISTINCT lang AS dataset, doc_id % num_blocks AS block_id
                   FROM labels JOIN documents USING (doc_id) JOIN counts ON lang = dataset WHERE num_blocks > 0)
        SELECT dataset, block_id, {describe_sql()} FROM blocks JOIN wanted USING (dataset, block_id)""",
    "global_blocks": f"""
        WITH {BLOCKS_SQL}, {NUMBERING_SQL},
        s AS (SELECT first_block + block_id AS global_id, ds_idx, dataset, block_id, tokens[1:{BLOCK_LEN - 1}] AS tokens
              FROM blocks JOIN numbering USING (dataset))
        SELECT global_id, ds_idx, dataset, block_id, {describe_sql()} FROM s""",
    "resolve_global_blocks": f"""
        WITH {SIZES_SQL}, {NUMBERING_SQL},
        ids AS (SELECT event_id, event_id % (SELECT sum(num_blocks)::BIGINT FROM counts) AS global_id FROM events)
        SELECT event_id, global_id, ds_idx, dataset, global_id - first_block AS block_id
        FROM ids JOIN numbering ON global_id >= first_block AND global_id < first_block + num_blocks""",
    "samples_at": f"""
        WITH {BLOCKS_SQL}, {NUMBERING_SQL},
        asked AS (SELECT doc_id, doc_id * 13 % (SELECT sum(num_blocks)::BIGINT FROM counts) AS global_id FROM labels),
        s AS (SELECT doc_id, global_id, ds_idx, dataset, block_id, tokens[2:{BLOCK_LEN}] AS tokens
              FROM asked JOIN numbering ON global_id >= first_block AND global_id < first_block + num_blocks
              JOIN blocks USING (dataset) WHERE block_id = global_id - first_block)
        SELECT doc_id, global_id, ds_idx, dataset, block_id, {describe_sql()} FROM s""",
    "to_samples": f"""
        WITH {BLOCKS_SQL},
        s AS (SELECT dataset, block_id, tokens[1:{BLOCK_LEN - 1}] AS inputs, tokens[2:{BLOCK_LEN}] AS labels FROM blocks)
        SELECT dataset, block_id, md5(array_to_string(inputs, ',')) AS inputs_md5, inputs[-1]::BIGINT AS last_input,
               {describe_sql('labels')}
        FROM s""",
    "pack_cyclic": f"""
        WITH {INDEX_SQL}, {COUNTS_SQL},
        laps AS (
          SELECT idx.dataset, tokens, num_blocks, num_tokens, lap, seq_id, num_sequences
          FROM idx JOIN counts USING (dataset), (SELECT unnest(range(3)) AS lap)),
        walked AS (
          SELECT *, (sum(num_tokens) OVER (PARTITION BY dataset ORDER BY lap, seq_id ROWS UNBOUNDED PRECEDING)
                     - num_tokens)::BIGINT AS start
          FROM (SELECT *, 7 % num_sequences AS first_seq FROM laps)
          WHERE lap > 0 OR seq_id >= first_seq),
        cyc AS (SELECT dataset, num_blocks, start + pos - 1 AS off, tok
                FROM (SELECT dataset, num_blocks, start, unnest(tokens) AS tok, generate_subscripts(tokens, 1) AS pos
                      FROM walked)),
        b AS (SELECT dataset, off // {BLOCK_LEN} AS block_id, list(tok ORDER BY off) AS tokens
              FROM cyc WHERE off // {BLOCK_LEN} < num_blocks + num_blocks // 2 + 1
              GROUP BY ALL HAVING count(*) = {BLOCK_LEN})
        SELECT dataset, block_id, {describe_sql()} FROM b""",
    "epoch_permutation": f"WITH {INDEX_SQL}, {ranked_sql(EPOCHS)} SELECT dataset, epoch, seq_id, rank FROM ranked",
    "stride_shards": f"""
        WITH {INDEX_SQL}, {ranked_sql(1, workers=MANY_WORKERS)}, {workers_sql(MANY_WORKERS)}
        SELECT dataset, epoch, worker, shard, rank, seq_id FROM ranked JOIN workers ON worker % stride = shard""",
    "worker_streams": f"""
        WITH {INDEX_SQL}, {ranked_sql(EPOCHS)}, {STREAMS_SQL}, {workers_sql()}
        SELECT dataset, worker, block_id, {describe_sql()}
        FROM stream_blocks JOIN workers ON worker % stride = shard""",
    "resumed_worker_streams": f"""
        WITH {INDEX_SQL}, {ranked_sql(EPOCHS, start=1)}, {STREAMS_SQL}, {workers_sql()}
        SELECT dataset, worker, block_id, {describe_sql()}
        FROM stream_blocks JOIN workers ON worker % stride = shard WHERE block_id >= 2""",
    "pack_stream": f"WITH {BLOCKS_SQL} SELECT dataset, block_id, {describe_sql()} FROM blocks",
}
