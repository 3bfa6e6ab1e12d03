import pytest
from pyspark.sql import functions as F, types as T

from tokenloom.functions import text
from tokenloom.operators.messages import flatten_turns
from tokenloom.schemas import MESSAGES


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_to_text_spells_cells_as_python_does(spark):
    assert value(spark, text.to_text(F.lit(None).cast("bigint"))) == "None"
    assert value(spark, text.to_text(F.lit(None).cast("bigint"), null_as_empty=True)) == ""
    assert value(spark, text.to_text(F.lit(7))) == "7"
    assert value(spark, text.to_text(F.lit(True), T.BooleanType())) == "True"


def flat(messages):
    """What the rule says, in plain Python."""
    if messages is None:
        return ""
    contents = [m["content"] if isinstance(m, dict) else str(m) for m in messages]
    return "\n\n".join(c.strip() for c in contents if c)


@pytest.mark.parametrize(
    "contents",
    [[], ["a"], [" a ", "", None, "b\n"], ["  "], ["  ", "x"], [" x ", "\x1cy　"], [None, ""]],
)
def test_flatten_messages(spark, contents):
    rows = [([{"role": "user", "content": c} for c in contents],)]
    got = spark.createDataFrame(rows, T.StructType([T.StructField("m", MESSAGES)])).select(
        text.flatten_messages(F.col("m"), MESSAGES.elementType).alias("v")
    ).first().v
    assert got == flat(rows[0][0])


def test_flatten_messages_null_list_and_plain_values(spark):
    strings = T.ArrayType(T.StringType())
    df = spark.createDataFrame([(None,), (["a ", None, ""],)], T.StructType([T.StructField("m", strings)]))
    got = [r.v for r in df.select(text.flatten_messages(F.col("m"), T.StringType()).alias("v")).collect()]
    assert got == ["", flat(["a ", None, ""])]


def test_messages_without_content_are_empty(spark):
    element = T.StructType([T.StructField("role", T.StringType())])
    df = spark.createDataFrame([([("user",)],)], T.StructType([T.StructField("m", T.ArrayType(element))]))
    assert df.select(text.flatten_messages(F.col("m"), element).alias("v")).first().v == ""


def test_flatten_turns_joins_stretches_like_one_list(spark):
    turns = {
        1: [f" t{i} " if i % 3 else "" for i in range(20)],
        2: ["", None],
        3: ["  ", "x", "", " "],
    }
    rows = [(c, i, t) for c, ts in turns.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows[::-1], "c bigint, i int, t string")
    got = {r.c: r.text for r in flatten_turns(df, "c", "i", "t", turns_per_part=4).collect()}
    assert got == {c: flat([{"content": t} for t in ts]) for c, ts in turns.items()}


def test_names(spark):
    def named(dataset, subset):
        return value(spark, text.dataset_name(F.lit(dataset), F.lit(subset).cast("string")))

    assert named("Org/Some Data", None) == "some-data"
    assert named("Org/Some Data", "Part A") == "some-data-part-a"
    assert named("plain", "") == "plain"
    assert value(spark, text.raw_slug(F.lit("a/b"), F.lit("c"), F.lit("train"))) == "a__b__c__train"
    assert value(spark, text.raw_slug(F.lit("a/b"), F.lit(None).cast("string"), F.lit("test"))) == "a__b__test"


def test_unknown_preprocess(spark):
    with pytest.raises(ValueError, match="flatten_messages"):
        text.prepare_text(F.lit("x"), T.StringType(), "shout")
