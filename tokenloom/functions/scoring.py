"""Column expressions that score one logged model output or one row of logits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tokenloom.functions.arrays import let
from tokenloom.functions.text import strip

# Reasoning tags cut from predictions, and the judge's input budget.
REASONING_BLOCK = r"(?s)<think>.*?</think>"
MAX_JUDGE_TOKENS = 2048
CHARS_PER_TOKEN = 4

# Fixed value: label that takes no part in the cross entropy.
IGNORE_LABEL = -100

# Fixed value: words that a normalized answer leaves out.
ARTICLES = ("a", "an", "the")

ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def exact_match(prediction: Column, gold: Column) -> Column:
    """1.0 when both are equal after stripping; a missing prediction is wrong."""
    return F.coalesce((strip(prediction) == strip(gold)).cast("double"), F.lit(0.0))


def normalize_answer(text: Column) -> Column:
    """Lower case, no ASCII punctuation, no English articles, single blanks."""
    words = F.split(F.translate(F.lower(text), ASCII_PUNCTUATION, ""), "[ \n\t]")
    return F.array_join(F.filter(words, lambda w: ~w.isin("", *ARTICLES)), " ")


def quasi_exact_match(prediction: Column, gold: Column) -> Column:
    """1.0 when both are equal after :func:`normalize_answer`; a missing prediction is wrong."""
    return F.coalesce((normalize_answer(prediction) == normalize_answer(gold)).cast("double"), F.lit(0.0))


def last_number(text: Column) -> Column:
    """The last number in a text as a double, thousands separators removed; NULL if none."""
    numbers = F.regexp_extract_all(text, F.lit(r"-?[0-9][0-9,]*(?:\.[0-9]+)?"), F.lit(0))
    return F.replace(F.try_element_at(numbers, F.lit(-1)), F.lit(","), F.lit("")).try_cast("double")


def numeric_match(prediction: Column, gold: Column) -> Column:
    """1.0 when the last number of the prediction is the gold text's last number."""
    return F.coalesce((last_number(prediction) == last_number(gold)).cast("double"), F.lit(0.0))


def _braces(text: Column) -> Column:
    """The text cut at its braces: runs of ``part`` and the ``brace`` behind it, NULL behind the last."""
    parts, braces = F.split(text, "[{}]", -1), F.regexp_extract_all(text, F.lit("[{}]"), F.lit(0))
    return F.zip_with(parts, braces, lambda part, brace: F.struct(part.alias("part"), brace.alias("brace")))


def _box_start(text: Column) -> Column:
    """Characters from the inside of the box that closes last to the end of the text; NULL if none closes.

    One walk over the braces from the end. ``depth`` is the nesting behind the brace at hand,
    ``low`` the least one further right: a brace is closed if that is below its own. ``inside``
    is the least nesting up to the end of the box found so far; a box around that one never
    goes below its own depth there, and takes its place.
    """
    start = F.struct(
        F.lit(0).alias("at"),
        F.lit(0).alias("depth"),
        F.lit(2**31 - 1).alias("low"),
        F.lit(0).alias("inside"),
        F.lit(None).cast("int").alias("box"),
    )

    def step(seen: Column, cut: Column) -> Column:
        opens, is_brace = cut["brace"] == "{", cut["brace"].isNotNull()
        boxed = opens & cut["part"].endswith("\\boxed") & (seen["low"] < seen["depth"])
        found = F.coalesce(boxed & (seen["box"].isNull() | (seen["inside"] >= seen["depth"])), F.lit(False))
        depth, past = seen["depth"], seen["at"] + F.length(cut["part"])
        return F.struct(
            F.when(is_brace, past + 1).otherwise(past).alias("at"),
            F.when(~is_brace, depth).when(opens, depth - 1).otherwise(depth + 1).alias("depth"),
            F.when(is_brace, F.least(seen["low"], depth)).otherwise(seen["low"]).alias("low"),
            F.when(found, depth - 1).when(is_brace, F.least(seen["inside"], depth)).otherwise(seen["inside"]).alias("inside"),
            F.when(found, seen["at"]).otherwise(seen["box"]).alias("box"),
        )

    return F.aggregate(F.reverse(_braces(text)), start, step, lambda seen: seen["box"])


def _up_to_close(rest: Column) -> Column:
    """A text up to the brace that closes what was open before it."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(None).cast("int").alias("end"))

    def step(seen: Column, cut: Column) -> Column:
        past = seen["at"] + F.length(cut["part"])
        depth = F.when(cut["brace"] == "{", seen["depth"] + 1).otherwise(seen["depth"] - 1)
        end = F.coalesce(seen["end"], F.when(depth < 0, past))
        return F.struct((past + 1).alias("at"), depth.alias("depth"), end.alias("end"))

    return F.left(rest, F.aggregate(_braces(rest), start, step, lambda seen: seen["end"]))


def boxed_answer(text: Column) -> Column:
    r"""The content of the last ``\boxed{...}``, nested to any depth; NULL if none closes.

    A box within a closed box belongs to the outer one. Time grows with the text alone.
    """
    return let(F.right(text, _box_start(text)), _up_to_close)


def boxed_match(prediction: Column, gold: Column) -> Column:
    """1.0 when the boxed answer equals the gold text, as numbers if both are, else as text."""
    answer = strip(boxed_answer(prediction))
    as_number = answer.try_cast("double") == strip(gold).try_cast("double")
    return F.coalesce(F.coalesce(as_number, answer == strip(gold)).cast("double"), F.lit(0.0))


def clean_prediction(response: Column, generated_tokens: Column) -> Column:
    """Without reasoning blocks, stripped, and cut from the left to the judge's input budget."""
    text = strip(F.regexp_replace(response, REASONING_BLOCK, ""))
    budget = MAX_JUDGE_TOKENS * CHARS_PER_TOKEN
    return F.when(generated_tokens > MAX_JUDGE_TOKENS, F.right(text, F.lit(budget))).otherwise(text)


def best_choice(logprobs: Column, lengths: Column | None = None) -> Column:
    """0-based index of the highest log-probability, divided by ``lengths`` if given.

    The earliest choice wins a tie.
    """
    scores = logprobs.cast("array<double>")
    if lengths is not None:
        scores = F.zip_with(scores, lengths, lambda p, n: p / n)
    return let(scores, lambda s: F.array_position(s, F.array_max(s)) - 1).cast("int")


def log_softmax(logits: Column, temperature: float = 1.0) -> Column:
    """Log-probabilities of a logits array at a temperature."""

    def shifted(scaled: Column, top: Column) -> Column:
        total = F.aggregate(scaled, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
        return let(top + F.ln(total), lambda norm: F.transform(scaled, lambda x: x - norm))

    scaled = F.transform(logits.cast("array<double>"), lambda x: x / temperature)
    return let(scaled, lambda s: let(F.array_max(s), lambda top: shifted(s, top)))


def row_reverse_kl(student_log_probs: Column, teacher_log_probs: Column) -> Column:
    """Sum over the vocabulary of p_student * (log p_student - log p_teacher)."""
    terms = F.zip_with(student_log_probs, teacher_log_probs, lambda s, t: F.exp(s) * (s - t))
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def row_cross_entropy(log_probs: Column, label: Column) -> Column:
    """Minus the log-probability of the label; NULL for the ignored label. Other labels outside the logits fail."""
    bad = F.raise_error(F.concat(F.lit("label out of range: "), label.cast("string"))).cast("double")
    loss = F.when((label < 0) | (label >= F.size(log_probs)), bad).otherwise(-F.get(log_probs, label.cast("int")))
    return F.when(label != IGNORE_LABEL, loss)


# Distillation losses by name, as training settings name them.
DISTILL_LOSSES = {"reverse_kl": row_reverse_kl}
