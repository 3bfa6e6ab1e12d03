"""Pipeline stages on tables whose own columns have the names of the stages' helper columns."""

import pytest

from tokenloom.llm.decontaminate import decontaminate
from tokenloom.llm.line_dedup import dedup_lines
from tokenloom.llm.names import free_name
from tokenloom.llm.ngram_join import keep_one
from tokenloom.llm.quality import clean_documents
from tokenloom.llm.toxicity import drop_toxic

WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen".split()
ROWS = [(1, " ".join(WORDS)), (2, " ".join(WORDS)), (3, " ".join(reversed(WORDS))), (None, "x y z"), (4, None), (5, "")]
NAMES = ["__found", "__kept", "__toxicity", "__judged", "component_id", "score", "n", "cls", "line", "gone"]


@pytest.fixture
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    return df.selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in NAMES])


def rows(df):
    return sorted((r.doc_id or -1, r.text, [r[n] for n in NAMES]) for r in df.where("text is not null").collect())


def test_stages_keep_columns_of_any_name(spark, docs):
    labels = spark.createDataFrame([(1, 0), (3, 0)], "doc_id bigint, toxic int")
    tests = spark.createDataFrame([(7, " ".join(reversed(WORDS)))], "item_id bigint, text string")
    stages = {
        "toxicity": (drop_toxic(docs, labels), {1, 2, 3, 4, 5, None}),
        "lines": (dedup_lines(docs), {1, 3, 4, 5, None}),
        "near": (keep_one(docs), {1, 3, 4, 5, None}),
        "decontaminate": (decontaminate(docs, tests), {1, 2, 4, 5, None}),
        "quality": (clean_documents(docs), set()),
    }
    given = {r[0]: r for r in rows(docs)}
    for name, (out, want) in stages.items():
        assert out.columns == docs.columns, name
        got = rows(out)
        assert all(given[r[0]] == r for r in got), name
        assert {r[0] for r in got} <= {i or -1 for i in want}, name
        assert {r[0] for r in got} >= {i or -1 for i in want - {4, 5}}, name


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2)], "__Found int, `__found_` int")
    assert free_name(df, "__found") == "__found__" and free_name(df, "other") == "other"
