"""Queries over data mixes: weights, schedules, draws, batches, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.operators import mixing, packing
from tokenloom.plans.mix import training_feed, validate_mix
from workload.base import (
    BLOCK_LEN,
    INDEX_SQL,
    SEED,
    SIZES_SQL,
    WORKERS,
    describe_sql,
    described,
    rounded,
    sizes,
    stored_in_buckets,
    table,
)
from workload.packing import COUNTS_SQL, STREAMS_SQL, PLACED_SQL, ranked_sql

BATCH = 8
ACCUMULATION = 2
SKIP = 8


def mix_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages weighted by their mean document length, and English once more without a weight."""
    by_lang = table(spark, sf_dir, "documents").groupBy("lang").agg((F.avg("n_chars") / 1000).alias("weight"))
    listed = by_lang.agg(F.sort_array(F.collect_list(F.struct("lang", "weight"))).alias("entries"))
    again = F.array(F.struct(F.lit("en").alias("lang"), F.lit(None).cast("double").alias("weight")))
    rows = listed.select(F.posexplode(F.concat("entries", again)).alias("ds_idx", "e"))
    return rows.select("ds_idx", F.col("e.lang").alias("dataset"), F.col("e.weight").alias("weight"))


def _mix(spark, sf_dir):
    return mixing.normalize_weights(mix_entries(spark, sf_dir))


def draws_per_worker(spark: SparkSession, sf_dir: str) -> int:
    """Half as many draws per worker as the corpus has blocks: one aggregate row."""
    tokens = stored_in_buckets(spark, sf_dir).agg(F.sum("num_tokens")).first()[0]
    return tokens // (2 * BLOCK_LEN)


def _schedule(spark, sf_dir, draws=None):
    draws = draws if draws is not None else draws_per_worker(spark, sf_dir)
    return mixing.mix_schedule(spark, _mix(spark, sf_dir), draws=draws, workers=WORKERS, seed=SEED)


def normalize_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_mix(spark, sf_dir))


def mix_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many draws per worker as there are documents."""
    return _schedule(spark, sf_dir, table(spark, sf_dir, "documents").count())


def mix_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws of every entry beside its share."""
    draws = table(spark, sf_dir, "documents").count()
    drawn = _schedule(spark, sf_dir, draws).groupBy("ds_idx").agg(F.count("*").alias("draws"))
    compared = _mix(spark, sf_dir).join(drawn, "ds_idx", "left").select(
        "ds_idx", "dataset", "share", "draws", (F.col("draws") / (draws * WORKERS)).alias("drawn_share")
    )
    return rounded(compared)


def number_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.number_draws(_schedule(spark, sf_dir, table(spark, sf_dir, "documents").count()))


def draws_to_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every draw with its block; small datasets go round several epochs."""
    numbered = mixing.number_draws(_schedule(spark, sf_dir))
    feed = mixing.draws_to_blocks(numbered, stored_in_buckets(spark, sf_dir), BLOCK_LEN, workers=WORKERS, seed=SEED)
    return described(feed, "worker", "step", "ds_idx", "dataset", "block_no")


def resumed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of a run that resumes after its first draws."""
    feed = training_feed(
        _mix(spark, sf_dir),
        stored_in_buckets(spark, sf_dir),
        BLOCK_LEN,
        draws=draws_per_worker(spark, sf_dir),
        workers=WORKERS,
        seed=SEED,
        skip=SKIP,
    )
    return described(feed, "worker", "step", "ds_idx", "dataset", "block_no", tokens="labels")


def make_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    skipped = mixing.skip_samples(_schedule(spark, sf_dir), SKIP)
    return mixing.make_batches(skipped, BATCH).select("worker", "step", "ds_idx", "batch", "slot")


def token_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = table(spark, sf_dir, "documents").count()
    batches = mixing.make_batches(_schedule(spark, sf_dir, draws), BATCH)
    return mixing.token_ledger(batches, accumulation=ACCUMULATION, tokens=F.lit(BLOCK_LEN - 1))


def mix_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validate_mix(_mix(spark, sf_dir), sizes(spark, sf_dir), BLOCK_LEN))


QUERIES = {
    f.__name__: f
    for f in (
        normalize_weights,
        mix_schedule,
        mix_shares,
        number_draws,
        draws_to_blocks,
        resumed_feed,
        make_batches,
        token_ledger,
        mix_report,
    )
}

MIX_SQL = """
mix AS (
  SELECT ds_idx, dataset, coalesce(weight, 1.0) AS weight,
         coalesce(weight, 1.0) / sum(coalesce(weight, 1.0)) OVER () AS share
  FROM (SELECT (row_number() OVER (ORDER BY lang) - 1)::INTEGER AS ds_idx, lang AS dataset, avg(n_chars) / 1000 AS weight
        FROM documents GROUP BY lang
        UNION ALL
        SELECT count(DISTINCT lang)::INTEGER, 'en', NULL FROM documents)),
bounds AS (
  SELECT ds_idx, dataset, sum(share) OVER (ORDER BY ds_idx ROWS UNBOUNDED PRECEDING) AS upto FROM mix)"""

DOC_DRAWS_SQL = "(SELECT count(*) FROM documents)"
BLOCK_DRAWS_SQL = f"(SELECT sum(num_tokens)::BIGINT // {2 * BLOCK_LEN} FROM sized)"


def schedule_sql(draws: str) -> str:
    return f"""{MIX_SQL},
ids AS (SELECT unnest(range({draws} * {WORKERS})) AS id),
uniform AS (
  SELECT id % {WORKERS} AS worker, id // {WORKERS} AS step,
         ('0x' || substr(md5(({SEED} + id % {WORKERS})::VARCHAR || ':' || (id // {WORKERS})::VARCHAR), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS u
  FROM ids),
schedule AS (
  SELECT worker, step, ds_idx, dataset
  FROM uniform JOIN (SELECT ds_idx, dataset, upto, coalesce(lag(upto) OVER (ORDER BY ds_idx), 0) AS lo FROM bounds) b
    ON u >= lo AND u < upto),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY worker, ds_idx ORDER BY step) - 1 AS block_no FROM schedule)"""


# Twice the epochs that shards of average size need for the last block drawn, and two: a shard
# that is still too short would lose draws, and the rows would differ.
FEED_SQL = f"""{INDEX_SQL}, {schedule_sql(BLOCK_DRAWS_SQL)},
reach AS (
  SELECT max(2 + 2 * blocks * {BLOCK_LEN * WORKERS} // tokens)::BIGINT AS epochs
  FROM (SELECT dataset, max(block_no) + 1 AS blocks FROM numbered GROUP BY dataset)
  JOIN (SELECT dataset, sum(num_tokens) AS tokens FROM idx GROUP BY dataset) USING (dataset)),
{ranked_sql('(SELECT epochs FROM reach)')}, {STREAMS_SQL},
feed AS (
  SELECT worker, step, ds_idx, numbered.dataset, block_no, tokens
  FROM numbered JOIN stream_blocks
    ON stream_blocks.dataset = numbered.dataset AND shard = worker % stride AND block_id = block_no)"""

ORACLES = {
    "normalize_weights": f"WITH {MIX_SQL} SELECT ds_idx, dataset, round(weight, 6) AS weight, round(share, 6) AS share FROM mix",
    "mix_schedule": f"WITH {schedule_sql(DOC_DRAWS_SQL)} SELECT * FROM schedule",
    "mix_shares": f"""
        WITH {schedule_sql(DOC_DRAWS_SQL)}
        SELECT ds_idx, dataset, round(share, 6) AS share, draws,
               round(draws / ({DOC_DRAWS_SQL} * {WORKERS}), 6) AS drawn_share
        FROM mix LEFT JOIN (SELECT ds_idx, count(*) AS draws FROM schedule GROUP BY ds_idx) USING (ds_idx)""",
    "number_draws": f"WITH {schedule_sql(DOC_DRAWS_SQL)} SELECT * FROM numbered",
    "draws_to_blocks": f"""
        WITH {FEED_SQL} SELECT worker, step, ds_idx, dataset, block_no, {describe_sql()} FROM feed""",
    "resumed_feed": f"""
        WITH {FEED_SQL}, s AS (SELECT * REPLACE (tokens[2:{BLOCK_LEN}] AS tokens) FROM feed WHERE step >= {SKIP})
        SELECT worker, step, ds_idx, dataset, block_no, {describe_sql()} FROM s""",
    "make_batches": f"""
        WITH {SIZES_SQL}, {schedule_sql(BLOCK_DRAWS_SQL)},
        s AS (SELECT worker, step, ds_idx, (step - {SKIP}) // {BATCH} AS batch, (step - {SKIP}) % {BATCH} AS slot
              FROM schedule WHERE step >= {SKIP})
        SELECT * FROM s QUALIFY count(*) OVER (PARTITION BY worker, batch) = {BATCH}""",
    "token_ledger": f"""
        WITH {schedule_sql(DOC_DRAWS_SQL)},
        s AS (SELECT worker, step // {BATCH} AS batch FROM schedule
              QUALIFY count(*) OVER (PARTITION BY worker, step // {BATCH}) = {BATCH}),
        t AS (SELECT batch // {ACCUMULATION} AS train_step, count(*) AS effective_batch,
                     count(*) * {BLOCK_LEN - 1} AS step_tokens FROM s GROUP BY ALL)
        SELECT *, (sum(step_tokens) OVER (ORDER BY train_step ROWS UNBOUNDED PRECEDING))::BIGINT AS tokens_seen FROM t""",
    "mix_report": f"""
        WITH {SIZES_SQL}, {COUNTS_SQL}, {MIX_SQL}
        SELECT ds_idx, CASE WHEN ds_idx IS NULL THEN 'TOTAL' ELSE dataset END AS dataset,
               sum(num_sequences)::BIGINT AS num_sequences, sum(total_tokens)::BIGINT AS num_tokens,
               sum(num_blocks)::BIGINT AS num_blocks, round(sum(weight), 6) AS weight, round(sum(share), 6) AS share
        FROM mix JOIN counts USING (dataset) GROUP BY GROUPING SETS ((ds_idx, dataset), ())""",
}
