"""Run folders: the latest checkpoints and which of them still need evaluating."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: names of checkpoint folders and where their number is.
CHECKPOINT_NAME = r"^(?:step_|checkpoint-)(\d+)$"


def checkpoint_step(name: Column) -> Column:
    """The step number in a checkpoint folder's name; NULL for any other name."""
    return F.regexp_extract(name, CHECKPOINT_NAME, 1).try_cast("bigint")


def list_checkpoints(listing: DataFrame, last: int | None = None, name: str = "name") -> DataFrame:
    """Checkpoint rows of a folder listing with their ``step``; the ``last`` highest steps if given."""
    found = listing.withColumn("step", checkpoint_step(F.col(name))).where(F.col("step").isNotNull())
    if last is None:
        return found
    return found.orderBy(F.col("step").desc(), F.col(name).desc()).limit(last)


def pending_evals(checkpoints: DataFrame, results: DataFrame, force: bool = False, key: str = "path") -> DataFrame:
    """Checkpoints without results, or all of them when forced."""
    if force:
        return checkpoints
    return checkpoints.join(results.select(key).distinct(), key, "left_anti")


def sweep_summary(checkpoints: DataFrame, exits: DataFrame, group: list[str] = [], key: str = "path") -> DataFrame:
    """Checkpoints, done and failed. ``exits`` has one exit code per run that was started.

    As in the sweep itself, a checkpoint that was skipped counts as done.
    """
    failed = F.coalesce(F.col("exit_code") != 0, F.lit(False))
    return (
        checkpoints.join(exits.select(key, "exit_code"), key, "left")
        .groupBy(*group)
        .agg(
            F.count("*").alias("num_checkpoints"),
            F.count_if(~failed).alias("num_done"),
            F.count_if(failed).alias("num_failed"),
        )
    )
