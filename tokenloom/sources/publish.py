"""Versions of a dataset's files, made visible by one entry.

A version is written aside, to a folder of its own; publishing it appends one small file to
the folder's list of entries. Readers follow the latest entry of each dataset. A job that
dies before it leaves the old version to them, one that dies after it the new one, and
nothing in between can be read. Versions without an entry are leftovers.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Entries lie beside the versions; readers of the folder itself do not see names with an underscore.
_ENTRIES = "_published"
_SCHEMA = "name string, version string, number long"

_appending = threading.Lock()


def new_version(path: str) -> tuple[str, str]:
    """A version's name and its folder under ``path``, which nothing reads yet."""
    version = uuid.uuid4().hex
    return version, version_folder(path, version)


def version_folder(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/version={version}"


def publish(spark: SparkSession, path: str, name: str, version: str) -> None:
    """Make ``version`` the one that readers of ``name`` find. Jobs of one driver take turns."""
    with _appending:
        latest = published(spark, path, name)
        number = latest["number"] + 1 if latest else 0
        entry = spark.createDataFrame([(name, version, number)], _SCHEMA).coalesce(1)
        entry.write.mode("append").parquet(f"{path.rstrip('/')}/{_ENTRIES}")


def published(spark: SparkSession, path: str, name: str):
    """The latest entry of ``name``, or None."""
    entries = _latest(spark, path)
    return entries.where(F.col("name") == name).first() if entries is not None else None


def published_versions(spark: SparkSession, path: str) -> dict[str, str] | None:
    """The version of every dataset published under ``path``; None where nothing ever was."""
    entries = _latest(spark, path)
    return None if entries is None else {r["name"]: r["version"] for r in entries.collect()}


def _latest(spark: SparkSession, path: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{_ENTRIES}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    entries = spark.read.schema(_SCHEMA).parquet(folder.toString())
    return entries.groupBy("name").agg(F.max_by("version", "number").alias("version"), F.max("number").alias("number"))
