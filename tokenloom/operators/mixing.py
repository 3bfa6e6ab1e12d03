"""Weighted mixing of packed datasets into reproducible, resumable training schedules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tokenloom.functions.arrays import let
from tokenloom.functions.hashing import seeded_uniform
from tokenloom.operators.ordering import chunk_by_key, div, running_totals
from tokenloom.operators.packing import pack_positions, worker_positions
from tokenloom.session import settle

# Steps of one worker that are ordered together when draws are counted.
STEPS_PER_CHUNK = 1 << 14


def normalize_weights(mix: DataFrame) -> DataFrame:
    """Add ``share``: weights over their sum. A missing weight is 1; zero or less fails the job.

    Entries are told apart by ``ds_idx``; a dataset may be listed more than once.
    """
    weight = F.coalesce(F.col("weight"), F.lit(1.0))
    checked = F.when(
        weight <= 0,
        F.raise_error(F.concat(F.lit("non-positive weight in mix entry "), F.col("ds_idx").cast("string"))).cast(
            "double"
        ),
    ).otherwise(weight)
    valid = mix.withColumn("weight", checked)
    total = valid.agg(F.sum("weight")).scalar()
    return valid.withColumn("share", F.col("weight") / total)


def mix_schedule(
    spark: SparkSession, mix: DataFrame, *, draws: int, workers: int, seed: int
) -> DataFrame:
    """One weighted dataset draw per worker and step: ``worker``, ``step``, ``ds_idx``, ``dataset``.

    ``mix`` carries ``share`` and has one row per entry of a mix, so its cumulative shares
    travel as one array value; the draws themselves are spread over all tasks.
    """
    running = Window.orderBy("ds_idx").rowsBetween(Window.unboundedPreceding, 0)
    bounds = (
        mix.select("ds_idx", "dataset", F.sum("share").over(running).alias("upto"))
        .agg(F.sort_array(F.collect_list(F.struct("ds_idx", "upto", "dataset"))))
        .scalar()
    )
    worker, step = F.col("id") % workers, div(F.col("id"), workers)
    drawn = (
        spark.range(draws * workers)
        .select(worker.alias("worker"), step.alias("step"), bounds.alias("bounds__"))
    )

    def entry(u: Column) -> Column:
        # Rounding may leave the last bound a hair under 1, so the last entry takes what is left.
        under = F.get(F.filter("bounds__", lambda b: u < b["upto"]), F.lit(0))
        return F.coalesce(under, F.element_at("bounds__", -1))

    hit = let(seeded_uniform(F.lit(seed) + F.col("worker"), F.col("step")), entry)
    return drawn.withColumn("hit__", hit).select("worker", "step", "hit__.ds_idx", "hit__.dataset")


def number_draws(schedule: DataFrame, steps_per_chunk: int = STEPS_PER_CHUNK) -> DataFrame:
    """Add ``block_no``: a worker's k-th draw of an entry takes that stream's k-th block."""
    chunked = chunk_by_key(schedule, "step", steps_per_chunk)
    return running_totals(
        chunked,
        group=["worker", "ds_idx"],
        chunk=["chunk_hi", "chunk"],
        order=["step"],
        totals={"block_no": F.lit(1)},
    ).drop("chunk_hi", "chunk")


def estimate_epochs(demand: DataFrame, counts: DataFrame, workers: int, block_len: int) -> DataFrame:
    """Per dataset, the epochs that cover the demanded blocks when every shard is of average size.

    ``demand`` has ``dataset`` and ``blocks``; ``counts`` sequences and tokens per dataset.
    """
    stride = F.least(F.lit(workers).cast("bigint"), F.col("num_sequences"))
    wanted = F.col("blocks") * block_len * stride
    return (
        demand.groupBy("dataset")
        .agg(F.max("blocks").alias("blocks"))
        .join(counts, "dataset")
        .select("dataset", (div(wanted, F.col("num_tokens")) + 1).alias("epochs"))
    )


def cover_demand(
    index: DataFrame, demand: DataFrame, counts: DataFrame, block_len: int, *, workers: int, seed: int
) -> DataFrame:
    """The sequences, with their places in the streams, that the demanded blocks are cut from.

    Shards differ in size, so the epochs estimated may leave some shard short. What was laid
    out is written and checked against the demand; only datasets that fell short get twice
    the epochs in the next round. One round is the rule, and each round adds tokens to every
    shard, so the rounds end.
    """
    epochs = settle(estimate_epochs(demand, counts, workers, block_len), "epochs")
    covered: list[DataFrame] = []
    while True:
        positions = worker_positions(
            index.join(epochs, "dataset"), seed=seed, workers=workers, epochs=F.col("epochs"), counts=counts
        ).drop("epochs")
        needed = settle(
            positions.join(demand, ["dataset", "shard"])
            .where(F.col("stream_start") < F.col("blocks") * block_len)
            .where(F.col("stream_start") + F.col("num_tokens") > F.col("first_block") * block_len),
            "positions",
        )
        reached = needed.groupBy("dataset", "shard").agg(
            F.max(F.col("stream_start") + F.col("num_tokens")).alias("reached")
        )
        open_datasets = demand.join(epochs, "dataset", "left_semi").join(reached, ["dataset", "shard"], "left")
        # at most the names of the mix's datasets
        short = [
            r["dataset"]
            for r in open_datasets.where(F.coalesce("reached", F.lit(0)) < F.col("blocks") * block_len)
            .select("dataset")
            .distinct()
            .collect()
        ]
        if not short:
            return reduce(lambda a, b: a.unionByName(b), [*covered, needed])
        again = F.col("dataset").isin(short)
        covered.append(needed.where(~again))
        epochs = settle(epochs.where(again).withColumn("epochs", F.col("epochs") * 2), "epochs")


def draws_to_blocks(
    numbered: DataFrame, tokens: DataFrame, block_len: int, *, workers: int, seed: int
) -> DataFrame:
    """Add to every draw the ``tokens`` of its block.

    Streams are endless; only as many epochs are laid out as the draws can reach, and of
    those only sequences between the first and the last wanted token are cut into blocks.
    A dataset without tokens fails the job, as its stream would end at once.
    """
    index = tokens.select("dataset", "seq_id", "num_tokens")
    sizes = index.groupBy("dataset").agg(
        F.count("*").alias("num_sequences"), F.sum("num_tokens").cast("bigint").alias("num_tokens")
    )
    counts = settle(sizes, "counts")
    missing = F.raise_error(F.concat(F.lit("no tokens in mix dataset "), F.col("dataset"))).cast("bigint")
    stride = F.least(F.lit(workers).cast("bigint"), F.coalesce("num_sequences", missing))
    draws = settle(
        numbered.join(counts.drop("num_tokens"), "dataset", "left")
        .withColumn("shard", F.col("worker") % stride)
        .drop("num_sequences"),
        "draws",
    )
    demand = draws.groupBy("dataset", "shard").agg(
        F.min("block_no").alias("first_block"), (F.max("block_no") + 1).alias("blocks")
    )
    needed = cover_demand(index, settle(demand, "demand"), counts, block_len, workers=workers, seed=seed)
    blocks = pack_positions(
        tokens, needed, block_len, blocks_from=F.col("first_block"), blocks_before=F.col("blocks")
    )
    found = draws.join(
        blocks.select("dataset", "shard", F.col("block_id").alias("block_no"), "tokens"),
        ["dataset", "shard", "block_no"],
        "left",
    )
    unfound = F.raise_error(F.lit("draw without a block")).cast("array<int>")
    return found.select(*numbered.columns, F.coalesce("tokens", unfound).alias("tokens"))


def skip_samples(draws: DataFrame, already_seen: int | Column) -> DataFrame:
    """Resume: the draws from ``already_seen`` on, numbered as in the full schedule."""
    return draws.where(F.col("step") >= already_seen)


def worker_share(samples: int, batch_size: int, worker: Column, num_workers: int) -> Column:
    """How many of a rank's first ``samples`` samples one of its feed workers supplied.

    Whole batches go round the workers in turn.
    """
    rounds = div(F.lit(samples // batch_size).cast("bigint") - worker + (num_workers - 1), num_workers)
    return F.greatest(rounds, F.lit(0)) * batch_size


def make_batches(draws: DataFrame, batch_size: int) -> DataFrame:
    """Add ``batch`` and ``slot`` per worker; a last partial batch is dropped."""
    extent = settle(
        draws.groupBy("worker").agg(F.min("step").alias("first__"), F.count("*").alias("draws__")), "extent"
    )
    since = F.col("step") - F.col("first__")
    return (
        draws.join(extent, "worker")
        .withColumns({"batch": div(since, batch_size), "slot": since % batch_size})
        .where(F.col("batch") < div(F.col("draws__"), batch_size))
        .drop("first__", "draws__")
    )


def token_ledger(batches: DataFrame, *, accumulation: int, tokens: Column) -> DataFrame:
    """Tokens seen after each training step: ``train_step``, samples, tokens and the running total.

    A step takes ``accumulation`` batches from every worker.
    """
    per_step = (
        batches.withColumn("train_step", div(F.col("batch"), accumulation))
        .groupBy("train_step")
        .agg(F.count("*").alias("effective_batch"), F.sum(tokens).cast("bigint").alias("step_tokens"))
    )
    chunked = chunk_by_key(per_step, "train_step")
    return (
        running_totals(
            chunked,
            group=[],
            chunk=["chunk_hi", "chunk"],
            order=["train_step"],
            totals={"before__": F.col("step_tokens")},
        )
        .withColumn("tokens_seen", F.col("before__") + F.col("step_tokens"))
        .select("train_step", "effective_batch", "step_tokens", "tokens_seen")
    )


def mix_report(mix: DataFrame, counts: DataFrame) -> DataFrame:
    """Per mix entry its sequences, tokens, blocks and share, and a ``TOTAL`` row.

    ``mix`` carries ``share``; ``counts`` comes from :func:`packing.block_counts`. An entry
    whose dataset has no tokens fails the job.
    """
    missing = F.raise_error(F.concat(F.lit("no tokens in mix dataset "), F.col("dataset"))).cast("bigint")
    entries = mix.join(counts, "dataset", "left").withColumn(
        "num_sequences", F.when(F.col("num_sequences").isNull(), missing).otherwise(F.col("num_sequences"))
    )
    return (
        entries.groupingSets(
            [[F.col("ds_idx"), F.col("dataset")], []], F.col("ds_idx"), F.col("dataset")
        )
        .agg(
            F.sum("num_sequences").cast("bigint").alias("num_sequences"),
            F.sum("total_tokens").cast("bigint").alias("num_tokens"),
            F.sum("num_blocks").cast("bigint").alias("num_blocks"),
            F.sum("weight").alias("weight"),
            F.sum("share").alias("share"),
        )
        .withColumn("dataset", F.when(F.col("ds_idx").isNull(), F.lit("TOTAL")).otherwise(F.col("dataset")))
    )
