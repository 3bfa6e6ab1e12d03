"""A training-data pipeline over ``documents``: each stage is one operator of ``tokenloom.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm.decontaminate import decontaminate
from tokenloom.llm.line_dedup import dedup_lines
from tokenloom.llm.ngram_join import keep_one
from tokenloom.llm.packing import pack_best_fit
from tokenloom.llm.toxicity import drop_toxic
from tokenloom.session import settle

#: Tokens of a packed sequence.
SEQUENCE = 1024


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line matches; ``n_chars`` follows the text."""
    return dedup_lines(docs, length_col="n_chars")


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every token of every document lies in the packed sequences."""
    return pack_best_fit(docs, SEQUENCE)


STAGES = [
    ("toxicity", _toxicity),
    ("line_dedup", _line_dedup),
    ("ngram_jaccard_join", _near_duplicates),
    ("benchmark_decontamination", _decontamination),
    ("best_fit_packing", _packing),
]

#: Best-fit packing is one choice after another and the toxicity model is fitted; SQL states neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query."""
    return run(spark, sf_dir)
