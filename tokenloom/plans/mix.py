"""Data mixes: settings, validation report, and the training feed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.operators.mixing import (
    draws_to_blocks,
    make_batches,
    mix_report,
    mix_schedule,
    normalize_weights,
    number_draws,
    skip_samples,
    worker_share,
)
from tokenloom.operators.packing import (
    block_counts,
    block_numbering,
    get_blocks,
    pack_blocks,
    resolve_global_blocks,
    to_samples,
)
from tokenloom.plans.jobs import listed_rows, load_settings
from tokenloom.schemas import MIX
from tokenloom.session import settle

# Mix settings when the file does not say.
SEQ_LEN = 2048
SEED = 42


@dataclass(frozen=True)
class Mix:
    """Weighted datasets and the length of a sample. A block is one token longer."""

    entries: tuple[tuple[str, float, str | None], ...]
    seq_len: int = SEQ_LEN
    seed: int = SEED

    @classmethod
    def from_settings(cls, settings: dict) -> Mix:
        rows = listed_rows(settings, ("path", "weight", "name"))
        bad = [row for row in rows if not row[0] or (row[1] is not None and not row[1] > 0)]
        if bad:
            raise ValueError(f"mix entries without a path or with a weight that is not positive: {bad}")
        entries = tuple((path, 1.0 if weight is None else float(weight), name) for path, weight, name in rows)
        return cls(entries, settings.get("seq_len", SEQ_LEN), settings.get("seed", SEED))

    @classmethod
    def from_yaml(cls, path: str) -> Mix:
        return cls.from_settings(load_settings(path))

    @property
    def block_len(self) -> int:
        return self.seq_len + 1

    @property
    def datasets(self) -> list[str]:
        """The dataset of every entry: the last part of its path, which two paths must not share."""
        named = {path.rstrip("/"): path.rstrip("/").split("/")[-1] for path, _, _ in self.entries}
        if len(set(named.values())) < len(named):
            raise ValueError(f"different paths end in the same dataset: {sorted(named)}")
        return [named[path.rstrip("/")] for path, _, _ in self.entries]

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per entry, with its ``share``."""
        rows = [(i, d, w, n) for i, (d, (_, w, n)) in enumerate(zip(self.datasets, self.entries))]
        return normalize_weights(spark.createDataFrame(rows, MIX))


def validate_mix(mix: DataFrame, tokens: DataFrame, block_len: int) -> DataFrame:
    """The report of a mix over a token table; only ids and sizes are read."""
    return mix_report(mix, block_counts(tokens.select("dataset", "num_tokens"), block_len))


def map_samples(mix: DataFrame, tokens: DataFrame, block_len: int, local: list[str] | None = None) -> DataFrame:
    """Every block of the mix once, under its common number; weights play no part.

    ``local`` is for tokens still partitioned as the index left them.
    """
    counts = block_counts(tokens.select("dataset", "num_tokens"), block_len)
    numbering = settle(block_numbering(mix.join(counts, "dataset")), "numbering")
    blocks = pack_blocks(tokens, block_len, local=local)
    numbered = blocks.join(numbering.select("ds_idx", "dataset", "first_block"), "dataset")
    return to_samples(
        numbered.withColumn("global_id", numbered.first_block + numbered.block_id).drop("first_block"), block_len
    )


def samples_at(mix: DataFrame, tokens: DataFrame, block_len: int, wanted: DataFrame, global_id: str = "global_id") -> DataFrame:
    """The samples of the common numbers asked for, a row for each row of ``wanted``; out of range fails.

    Only the blocks wanted are cut, from the stretches of the token table that hold them.
    """
    counts = settle(block_counts(tokens.select("dataset", "num_tokens"), block_len), "counts")
    numbering = block_numbering(mix.join(counts, "dataset"))
    found = settle(resolve_global_blocks(numbering, wanted, global_id), "found")
    blocks = get_blocks(tokens, found.select("dataset", "block_id"), block_len)
    return to_samples(found.join(blocks, ["dataset", "block_id"]), block_len)


def training_feed(
    mix: DataFrame,
    tokens: DataFrame,
    block_len: int,
    *,
    draws: int,
    workers: int,
    seed: int = SEED,
    skip: int = 0,
    batch_size: int | None = None,
    samples_done: int | None = None,
    num_workers: int | None = None,
) -> DataFrame:
    """The samples of every worker in step order, from ``skip`` on, in batches if asked.

    ``workers`` counts the workers of all ranks; a rank has ``num_workers`` of them (default:
    all, one rank), numbered one after the other. A run that resumes gives ``samples_done``,
    the samples that each rank's workers have supplied together in whole batches of
    ``batch_size``; each worker then skips its share of its rank's.

    Skipped draws and partial batches are gone before any block is cut.
    """
    numbered = number_draws(mix_schedule(tokens.sparkSession, mix, draws=draws, workers=workers, seed=seed))
    if samples_done is not None:
        if not batch_size:
            raise ValueError("samples_done needs the batch_size that workers took turns with")
        num_workers = workers if num_workers is None else num_workers
        if num_workers < 1 or workers % num_workers:
            raise ValueError(f"{workers} workers are no whole number of ranks of {num_workers}")
        skip = worker_share(samples_done, batch_size, F.col("worker") % num_workers, num_workers)
    wanted = skip_samples(numbered, skip)
    if batch_size:
        wanted = make_batches(wanted, batch_size)
    return to_samples(draws_to_blocks(wanted, tokens, block_len, workers=workers, seed=seed), block_len)
