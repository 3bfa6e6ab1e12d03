"""Queries that compare logged logits: embeddings as logits, each row's successor as its teacher.

The first row is the successor of the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.functions import scoring as score
from tokenloom.operators import scoring
from tokenloom.operators.ordering import CHUNKS, chunk_by_key, div, running_totals
from workload.base import table

TEMPERATURE = 2.0
ALPHA = 0.5
ROWS_PER_STEP = 32
ROWS_PER_MICRO_STEP = 8


def _logits(spark, sf_dir):
    rows = chunk_by_key(table(spark, sf_dir, "embeddings"), "vec_id")
    rows = running_totals(rows, group=[], chunk=CHUNKS, order=["vec_id"], totals={"place": F.lit(1)}).drop(*CHUNKS)
    last = table(spark, sf_dir, "embeddings").agg(F.count("*") - 1).scalar()
    before = F.when(F.col("place") == 0, last).otherwise(F.col("place") - 1)
    teacher = rows.select(before.alias("place"), F.col("embedding").alias("teacher"))
    return rows.join(teacher, "place").select(
        "vec_id",
        F.col("embedding").alias("student"),
        "teacher",
        F.when(F.col("label") == 9, score.IGNORE_LABEL).otherwise(F.col("label")).alias("label"),
        div(F.col("vec_id"), ROWS_PER_STEP).alias("step"),
        div(F.col("vec_id"), ROWS_PER_MICRO_STEP).alias("micro_step"),
    )


def log_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends and total probability of every row's log-probabilities."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", score.log_softmax(F.col("embedding"), TEMPERATURE).alias("lp")
    )
    return rows.select(
        "vec_id",
        F.round(F.element_at("lp", 1), 6).alias("first_lp"),
        F.round(F.element_at("lp", -1), 6).alias("last_lp"),
        F.round(F.aggregate("lp", F.lit(0.0), lambda a, x: a + F.exp(x)), 6).alias("mass"),
    )


def reverse_kl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean divergence per label, scaled by the temperature squared."""
    rows = _logits(spark, sf_dir)
    divergence = score.row_reverse_kl(
        score.log_softmax(F.col("student"), TEMPERATURE), score.log_softmax(F.col("teacher"), TEMPERATURE)
    )
    mean = scoring.mean_score(rows, divergence * TEMPERATURE**2, ["label"], "reverse_kl")
    return mean.withColumn("reverse_kl", F.round("reverse_kl", 6))


def cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean cross entropy per step, ignored labels left out."""
    ignored = F.when(F.col("label") == 9, score.IGNORE_LABEL).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("embedding").alias("student"), ignored.alias("label"), div(F.col("vec_id"), ROWS_PER_STEP).alias("step")
    )
    loss = score.row_cross_entropy(score.log_softmax(F.col("student")), F.col("label"))
    return rows.groupBy("step").agg(F.count(loss).alias("scored"), F.round(F.avg(loss), 6).alias("ce"))


def blended_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = scoring.distill_losses(
        _logits(spark, sf_dir),
        student="student",
        teacher="teacher",
        label="label",
        temperature=TEMPERATURE,
        alpha=ALPHA,
        step="step",
        micro_step="micro_step",
    )
    return losses.select("step", "micro_batches", *[F.round(c, 6).alias(c) for c in ("ce", "distill", "loss")])


QUERIES = {f.__name__: f for f in (log_softmax, reverse_kl, cross_entropy, blended_loss)}


def log_probs_sql(logits: str, temperature: float) -> str:
    scaled = f"list_transform({logits}, lambda x: x::DOUBLE / {temperature})"
    return f"list_transform({scaled}, lambda x: x - ln(list_sum(list_transform({scaled}, lambda y: exp(y)))))"


ROWS_SQL = f"""
scored AS (
  SELECT s.vec_id, CASE WHEN s.label = 9 THEN -100 ELSE s.label END AS label,
         s.vec_id // {ROWS_PER_STEP} AS step, s.vec_id // {ROWS_PER_MICRO_STEP} AS micro_step,
         {log_probs_sql('s.embedding', 1.0)} AS lp1,
         {log_probs_sql('s.embedding', TEMPERATURE)} AS ls,
         {log_probs_sql('s.teacher', TEMPERATURE)} AS lt
  FROM (SELECT *, coalesce(lead(embedding) OVER (ORDER BY vec_id), first_value(embedding) OVER (ORDER BY vec_id)) AS teacher
        FROM embeddings) s),
losses AS (
  SELECT *, CASE WHEN label <> -100 THEN -lp1[label + 1] END AS ce,
         list_sum(list_transform(range(1, len(ls) + 1), lambda i: exp(ls[i]) * (ls[i] - lt[i]))) * {TEMPERATURE ** 2} AS kl
  FROM scored)"""

ORACLES = {
    "log_softmax": f"""
        WITH l AS (SELECT vec_id, {log_probs_sql('embedding', TEMPERATURE)} AS lp FROM embeddings)
        SELECT vec_id, round(lp[1], 6) AS first_lp, round(lp[-1], 6) AS last_lp,
               round(list_sum(list_transform(lp, lambda x: exp(x))), 6) AS mass FROM l""",
    "reverse_kl": f"""
        WITH {ROWS_SQL} SELECT label, count(*) AS num_examples, round(avg(kl), 6) AS reverse_kl FROM losses GROUP BY label""",
    "cross_entropy": f"""
        WITH {ROWS_SQL} SELECT step, count(ce) AS scored, round(avg(ce), 6) AS ce FROM losses GROUP BY step""",
    "blended_loss": f"""
        WITH {ROWS_SQL},
        micro AS (SELECT step, micro_step, avg(ce) AS ce, avg(kl) AS kl FROM losses GROUP BY ALL)
        SELECT step, count(*) AS micro_batches, round(avg(ce), 6) AS ce, round(avg(kl), 6) AS distill,
               round(avg({ALPHA} * ce + {1 - ALPHA} * kl), 6) AS loss
        FROM micro GROUP BY step""",
}
