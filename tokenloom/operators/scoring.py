"""Aggregates over scored outputs and logged logits. All means combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.functions.scoring import (
    DISTILL_LOSSES,
    best_choice,
    log_softmax,
    row_cross_entropy,
)

# Fixed value: free-form judge scores are out of five.
FREEFORM_SCALE = 5


def mean_score(df: DataFrame, score: Column, group: list[str], name: str = "score") -> DataFrame:
    """Examples and mean of a per-example score per group."""
    return df.groupBy(*group).agg(F.count("*").alias("num_examples"), F.avg(score).alias(name))


def loglik_accuracy(
    df: DataFrame, group: list[str], *, logprobs: str, gold: str, token_lengths: str, char_lengths: str
) -> DataFrame:
    """Accuracy of the best choice, plain and per token and per character."""
    plain = best_choice(F.col(logprobs))
    by_token = best_choice(F.col(logprobs), F.col(token_lengths))
    by_char = best_choice(F.col(logprobs), F.col(char_lengths))
    return df.groupBy(*group).agg(
        F.count("*").alias("num_examples"),
        *[
            F.avg((choice == F.col(gold)).cast("double")).alias(name)
            for choice, name in ((plain, "acc"), (by_token, "acc_norm_token"), (by_char, "acc_norm"))
        ],
    )


def judge_score_mean(df: DataFrame, group: list[str], *, score: str, freeform: Column) -> DataFrame:
    """Mean judge score; free-form scores are brought from five points down to one."""
    scaled = F.when(freeform, F.col(score) / FREEFORM_SCALE).otherwise(F.col(score).cast("double"))
    return mean_score(df, scaled, group, "judge_score")


def distill_losses(
    df: DataFrame,
    *,
    student: str,
    teacher: str,
    label: str,
    temperature: float,
    alpha: float,
    step: str,
    micro_step: str,
    loss: str = "reverse_kl",
) -> DataFrame:
    """Per step the cross entropy, the distillation loss and their blend.

    Rows average within a micro-batch, micro-batches average within a step. Logits are
    reduced to two numbers per row before anything is exchanged.
    """
    if loss not in DISTILL_LOSSES:
        raise ValueError(f"unknown distillation loss {loss!r}; known: {sorted(DISTILL_LOSSES)}")
    rows = df.select(
        step,
        micro_step,
        DISTILL_LOSSES[loss](
            log_softmax(F.col(student), temperature), log_softmax(F.col(teacher), temperature)
        ).alias("divergence"),
        row_cross_entropy(log_softmax(F.col(student)), F.col(label)).alias("ce"),
    )
    micro = rows.groupBy(step, micro_step).agg(
        F.avg("ce").alias("ce"), (F.avg("divergence") * temperature**2).alias("distill")
    )
    blended = alpha * F.col("ce") + (1.0 - alpha) * F.col("distill")
    return micro.groupBy(step).agg(
        F.count("*").alias("micro_batches"),
        F.avg("ce").alias("ce"),
        F.avg("distill").alias("distill"),
        F.avg(blended).alias("loss"),
    )
