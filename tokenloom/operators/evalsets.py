"""Evaluation sets: one common shape for multiple-choice sources, prompts, few-shot examples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tokenloom.functions.hashing import seeded_digest
from tokenloom.functions.text import strip
from tokenloom.session import settle

# Answer letters and prompt formats.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BBH_PROMPT = ("Question: ", "\nAnswer: ")
MATH_PROMPT = (
    "Solve the following math problem efficiently and clearly.  The last line of your response should be of"
    " the following format: 'Therefore, the final answer is: $\\boxed{ANSWER}$. I hope it is correct'"
    " (without quotes) where ANSWER is just the final number or expression that solves the problem."
    " Think step by step before answering.\n\n"
)
SKIPPED_PERTURBATION = "critical thinking"


@dataclass(frozen=True)
class EvalSpec:
    """How a multiple-choice source maps to question, context, choices and gold index.

    ``choices`` is one array column (dots allowed) or several option columns. ``rule`` says
    how ``answer`` names the gold choice: see ``ANSWER_RULES``. ``labels`` is the array the
    ``label`` rule looks in.
    """

    name: str
    question: str
    answer: str
    rule: str
    choices: tuple[str, ...] | str = ()
    context: str | None = None
    labels: str | None = None


def _letter_index(answer: Column, _labels: Column | None) -> Column:
    """Only a single letter is an answer; anything else is outside all choices."""
    return F.when(F.length(answer) == 1, F.instr(F.lit(LETTERS), answer) - 1).otherwise(F.lit(-1))


# Answer text or number to 0-based gold index.
ANSWER_RULES = {
    "index": lambda answer, _: answer.cast("int"),
    "one_based": lambda answer, _: answer.cast("int") - 1,
    "letter": _letter_index,
    "digit_or_letter": lambda answer, _: F.when(
        answer.rlike("^[0-9]+$"), answer.try_cast("int") - 1
    ).otherwise(_letter_index(answer, None)),
    "label": lambda answer, labels: (F.array_position(labels, strip(answer)) - 1).cast("int"),
    "boolean": lambda answer, _: F.when(answer.cast("boolean"), F.lit(0)).when(~answer.cast("boolean"), F.lit(1)),
}

# The multiple-choice sources and where their fields are.
MCQ_SPECS = {
    s.name: s
    for s in (
        EvalSpec("arc", "question", "answerKey", "digit_or_letter", "choices.text"),
        EvalSpec("boolq", "question", "answer", "boolean", (), context="passage"),
        EvalSpec("hellaswag", "ctx_a", "label", "index", "endings", context="activity_label"),
        EvalSpec("commonsenseqa", "question", "answerKey", "label", "choices.text", labels="choices.label"),
        EvalSpec("openbookqa", "question_stem", "answerKey", "letter", "choices.text"),
        EvalSpec("winogrande", "sentence", "answer", "one_based", ("option1", "option2")),
        EvalSpec("piqa", "goal", "label", "index", ("sol1", "sol2")),
        EvalSpec("siqa", "question", "label", "one_based", ("answerA", "answerB", "answerC"), context="context"),
        EvalSpec("mmlu", "question", "answer", "index", "choices"),
        EvalSpec("mmlu_pro", "question", "answer_index", "index", "options"),
    )
}

YES_NO = ("yes", "no")


def normalize_mcq(df: DataFrame, spec: EvalSpec, keep: list[str] = []) -> DataFrame:
    """``task``, ``question``, ``context``, ``choices`` and ``gold_idx`` of every source row.

    An answer that names none of the choices fails the job.
    """
    if isinstance(spec.choices, str):
        choices = F.col(spec.choices)
    elif spec.choices:
        choices = F.array(*[F.col(c) for c in spec.choices])
    else:
        choices = F.array(*[F.lit(c) for c in YES_NO])
    question = F.col(spec.question)
    if spec.name == "hellaswag":
        question = F.concat_ws(" ", F.col("ctx_a"), F.col("ctx_b"))
    labels = F.col(spec.labels) if spec.labels else None
    gold = ANSWER_RULES[spec.rule](F.col(spec.answer), labels)
    valid = gold.isNotNull() & (gold >= 0) & (gold < F.size(choices))
    bad = F.raise_error(
        F.concat(F.lit(f"{spec.name}: answer out of range: "), F.coalesce(F.col(spec.answer).cast("string"), F.lit("NULL")))
    ).cast("int")
    return df.select(
        *keep,
        F.lit(spec.name).alias("task"),
        question.alias("question"),
        (F.col(spec.context) if spec.context else F.lit(None).cast("string")).alias("context"),
        choices.alias("choices"),
        F.when(valid, gold).otherwise(bad).alias("gold_idx"),
    )


def bbh_prompt(question: Column) -> Column:
    return F.concat(F.lit(BBH_PROMPT[0]), question, F.lit(BBH_PROMPT[1]))


def math_prompt(question: Column) -> Column:
    return F.concat(F.lit(MATH_PROMPT), question)


def build_prompts(df: DataFrame, query: Column, gold: str, keep: list[str] = []) -> DataFrame:
    """Open-answer examples: the query text, the gold answer as the only choice, gold index 0."""
    return df.select(*keep, query.alias("query"), F.array(F.col(gold)).alias("choices"), F.lit(0).alias("gold_idx"))


def keep_scorable(df: DataFrame, kind: str = "perturbation_type") -> DataFrame:
    """Without the perturbations whose answers text extraction cannot score; NULL kinds stay."""
    return df.where(~F.col(kind).eqNullSafe(F.lit(SKIPPED_PERTURBATION)))


def few_shot(
    pool: DataFrame, k: int, *, group: list[str], order: list[str], example: Column, seed: int | None = None
) -> DataFrame:
    """Per task the ``k`` examples to show: the first by ``order``, or a seeded sample.

    Only ``k`` rows per task and scan task take part in the exchange.
    """
    rank_by = [F.col(c) for c in order]
    if seed is not None:
        rank_by = [seeded_digest(F.lit(seed), *rank_by), *rank_by]
    position = F.row_number().over(Window.partitionBy(*group).orderBy(*rank_by))
    ranked = pool.select(*group, example.alias("example"), position.alias("shot")).where(F.col("shot") <= k)
    shots = F.sort_array(F.collect_list(F.struct("shot", "example")))
    return ranked.groupBy(*group).agg(shots.alias("s")).select(*group, F.col("s.example").alias("shots"))


def with_few_shot(examples: DataFrame, shots: DataFrame, group: list[str]) -> DataFrame:
    """Each example with its task's shots; a task without a pool gets none."""
    return examples.join(settle(shots, "shots"), group, "left").withColumn(
        "shots", F.coalesce("shots", F.array().cast("array<string>"))
    )


def few_shot_prompt(shots: Column, query: Column) -> Column:
    """Shots and query separated by blank lines."""
    return F.array_join(F.concat(shots, F.array(query)), "\n\n")
