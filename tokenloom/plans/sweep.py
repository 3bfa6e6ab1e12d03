"""Evaluation sweeps: which checkpoints to run, and the score table of what was logged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.operators.runs import list_checkpoints, pending_evals, sweep_summary
from tokenloom.sources.corpus import list_files


def folder_listing(spark: SparkSession, path: str) -> DataFrame:
    """Names and paths of the folders directly under a run folder."""
    paths = [(p.rstrip("/").split("/")[-1], p) for p in list_files(spark, path, "*", folders=True)]
    return spark.createDataFrame(paths, "name string, path string")


def plan_sweep(listing: DataFrame, results: DataFrame, last: int | None = None, force: bool = False) -> DataFrame:
    """The latest checkpoints that still need evaluating, oldest first."""
    return pending_evals(list_checkpoints(listing, last), results, force).orderBy("step")


def chosen_checkpoints(spark: SparkSession, settings: dict, model: str | None = None) -> DataFrame:
    """Which checkpoints to evaluate, in order: ``place``, ``name``, ``path``, and their ``results`` folder.

    A given model, else the settings' ``checkpoints``, else the (``last``) checkpoints of
    ``checkpoint_dir``, else their ``model``. A single model's results are ``output_dir``
    itself, otherwise each has a folder of its name there.
    """
    output = settings.get("output_dir")
    listed = [model] if model else settings.get("checkpoints")
    if listed is None and settings.get("checkpoint_dir"):
        found = list_checkpoints(folder_listing(spark, settings["checkpoint_dir"]), settings.get("last"))
        listed = [r.path for r in found.orderBy("step", "name").collect()]
        if not listed:
            raise ValueError(f"no step_N or checkpoint-N folders in {settings['checkpoint_dir']}")
    if listed is None and settings.get("model"):
        listed = [settings["model"]]
    if listed is None:
        raise ValueError("the settings name no model, checkpoints or checkpoint_dir")
    alone = len(listed) == 1 and not settings.get("checkpoint_dir") and settings.get("checkpoints") is None
    rows = []
    for place, path in enumerate(listed):
        name = path.rstrip("/").split("/")[-1]
        rows.append((place, name, path, output and (output if alone else f"{output.rstrip('/')}/{name}")))
    return spark.createDataFrame(rows, "place int, name string, path string, results string")


def pending_checkpoints(spark: SparkSession, settings: dict, model: str | None = None, force: bool = False) -> DataFrame:
    """The chosen checkpoints without a result file in their results folder, or all when forced."""
    chosen = chosen_checkpoints(spark, settings, model)
    folders = [r.results for r in chosen.select("results").distinct().collect() if r.results]
    done = [(f,) for f in folders if list_files(spark, f, "results_*.json")]
    finished = spark.createDataFrame(done, "results string")
    return pending_evals(chosen, finished, force, key="results").orderBy("place").drop("place")


def report_sweep(checkpoints: DataFrame, exits: DataFrame) -> DataFrame:
    """Done and failed counts, and the failed paths."""
    failed = exits.where(F.col("exit_code") != 0).select("path")
    return sweep_summary(checkpoints, exits).withColumn(
        "failed", F.coalesce(failed.agg(F.sort_array(F.collect_list("path"))).scalar(), F.array().cast("array<string>"))
    )
