"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import licenses, line_dedup, quality
from tokenloom.llm.clustering import clustering_report
from tokenloom.llm.decontaminate import contamination
from tokenloom.llm.embedding_join import embedding_classes
from tokenloom.llm.importance import resampling_report
from tokenloom.llm.kneser_ney import lm_scores
from tokenloom.llm.ngram_join import ngram_jaccard_classes
from tokenloom.llm.packing import pack_best_fit
from tokenloom.llm.paragraph_dedup import repeated_passages
from tokenloom.llm.secrets import scan_secrets
from tokenloom.llm.toxicity import toxicity_scores

#: Tokens of a packed sequence.
SEQUENCE = 1024


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_classes(_table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(_table(spark, sf_dir, "documents"), SEQUENCE)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_classes(_table(spark, sf_dir, "embeddings"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering_report(_table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_benchmark_decontamination, op3_best_fit_packing, op4_substring_dedup, op5_lm_scoring, op6_toxicity, op7_secret_scan, op8_license_scan, op9_line_dedup, op10_embedding_near_dedup, op11_centroid_clustering, op12_importance_resampling, op13_quality_rules)}

ORACLES: dict[str, str] = {"op8_license_scan": licenses.sql(), "op9_line_dedup": line_dedup.SQL, "op13_quality_rules": quality.SQL}
