"""Job lists: entries with defaults, dataset names, selection, and what is left to run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.functions.text import dataset_name, raw_slug
from tokenloom.schemas import JOB_ENTRY
from tokenloom.sources.ledger import unfinished

# What an entry means when neither it nor the job list says.
DEFAULTS = {
    "split": "train",
    "text_column": "text",
    "streaming": True,
    "add_bos": False,
    "add_eos": True,
}

DOWNLOAD = "download"
TOKENIZE = "tokenize"


def load_settings(path: str) -> dict:
    """A YAML settings file as a mapping."""
    import yaml

    with open(path, encoding="utf8") as f:
        settings = yaml.safe_load(f)
    if not isinstance(settings, dict):
        raise ValueError(f"expected a mapping, got {type(settings).__name__}")
    return settings


def job_entries(spark: SparkSession, settings: dict) -> DataFrame:
    """The ``datasets`` list of a job file as rows; an entry that names nothing is an error."""
    entries = spark.createDataFrame(listed_rows(settings, JOB_ENTRY.fieldNames()), JOB_ENTRY)
    unnamed = entries.where(F.coalesce("dataset", "raw_dir", "name", F.lit("")) == "").count()
    if unnamed:
        raise ValueError(f"{unnamed} dataset entries have neither dataset, raw_dir nor name")
    return entries


def listed_rows(settings: dict, names: Sequence[str]) -> list[tuple]:
    """The fields ``names`` of each entry under ``datasets``, of which there must be one."""
    rows = [tuple(map(entry.get, names)) for entry in settings.get("datasets") or ()]
    if not rows:
        raise ValueError("the settings list no datasets")
    return rows


def fill_defaults(entries: DataFrame, settings: dict | None = None, overrides: dict | None = None) -> DataFrame:
    """Every field from the override, the entry, the job list's own setting or the default, in that order.

    An entry without a name is named after its dataset and subset.
    """
    settings, overrides = settings or {}, overrides or {}
    columns = {}
    for field in JOB_ENTRY:
        if field.name in ("name", "dataset", "subset", "raw_dir"):
            continue
        own = [F.col(field.name)] if field.name in entries.columns else []
        given = [F.lit(v) for v in (settings.get(field.name), DEFAULTS.get(field.name)) if v is not None]
        override = overrides.get(field.name)
        values = ([F.lit(override)] if override is not None else []) + own + given
        if values:
            columns[field.name] = F.coalesce(*values).cast(field.dataType)
        else:
            columns[field.name] = F.lit(None).cast(field.dataType)
    named = F.coalesce(F.col("name"), dataset_name(F.col("dataset"), F.col("subset")))
    filled = entries.withColumns(columns).withColumn("name", named)
    slug = raw_slug(F.col("dataset"), F.col("subset"), F.col("split"))
    raw = F.coalesce(F.col("raw_dir"), slug) if "raw_dir" in entries.columns else slug
    return filled.withColumn("raw_dir", raw)


def unknown_names(entries: DataFrame, only: DataFrame) -> DataFrame:
    """Requested names (``name``) that no entry has."""
    return only.select("name").distinct().join(entries.select("name"), "name", "left_anti")


def select_datasets(entries: DataFrame, only: list[str] | None) -> DataFrame:
    """Entries with one of the names; an unknown name is an error that lists the known ones."""
    if not only:
        return entries
    spark = entries.sparkSession
    asked = spark.createDataFrame([(n,) for n in only], "name string")
    unknown = sorted(r.name for r in unknown_names(entries, asked).collect())
    if unknown:
        known = [r.name for r in entries.select("name").distinct().orderBy("name").collect()]
        raise ValueError(f"unknown names: {', '.join(unknown)}; available: {', '.join(known)}")
    return entries.where(F.col("name").isin(*only))


def plan(entries: DataFrame, ledger: DataFrame, stage: str) -> DataFrame:
    """Filled entries that still have to go through ``stage``, with the limit spelled out.

    Tokenizing needs a finished download first.
    """
    todo = unfinished(entries, ledger, stage)
    if stage == TOKENIZE:
        ready = ledger.where(F.col("stage") == DOWNLOAD).select("name").distinct()
        todo = todo.join(ready, "name", "left_semi")
    limit = F.when(F.col("max_samples") > 0, F.concat(F.lit("max="), F.col("max_samples").cast("string")))
    return todo.withColumns(
        {
            "limit": F.coalesce(limit, F.lit("all")),
            "mode": F.when(F.col("streaming"), F.lit("streaming")).otherwise(F.lit("full")),
        }
    )
