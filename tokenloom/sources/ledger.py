"""The run ledger: which stage finished for which dataset. Only a ledger entry counts as done."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.schemas import LEDGER
from tokenloom.session import empty_table

_appending = threading.Lock()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All completion marks; an absent ledger is an empty one."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    if not hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop(path)):
        return empty_table(spark, LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def mark_done(done: DataFrame, path: str, stage: str) -> None:
    """Append completion marks for ``done`` (``name`` and ``path``); jobs of one driver take turns."""
    marks = done.select(
        F.lit(stage).alias("stage"), F.col("name"), F.col("path"), F.current_timestamp().alias("finished_at")
    )
    with _appending:
        marks.write.mode("append").parquet(path)


def unfinished(work: DataFrame, ledger: DataFrame, stage: str, key: str = "name") -> DataFrame:
    """The part of ``work`` without a mark for ``stage``."""
    done = ledger.where(F.col("stage") == stage).select(F.col("name").alias(key)).distinct()
    return work.join(done, key, "left_anti")
