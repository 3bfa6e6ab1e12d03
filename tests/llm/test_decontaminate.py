import plain
import pytest
from tokenloom.llm.decontaminate import contamination, decontaminate, find_matches

SF_DIR = "/root/testdata/sf0.001"
DOC, ITEM = "doc_id long, text string, n_words int", "item_id long, text string"


def result(rows):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows}


def test_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tests = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    want = plain.contamination(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in tests.collect()]
    )
    assert result(contamination(docs, tests).collect()) == want
    assert any(r[4] for r in want.values())


BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen".split()
CASES = [
    (1, None, 1), (2, "", 1), (3, " .,; ", 1), (4, "pad " + " ".join(BASE) + " pad", 1), (5, " ".join(BASE[:12]), 1),
    (6, " ".join(BASE[:13]) + " x" * 400, 1), (7, "tiny item", None), (7, "tiny item", None), (8, "tiny itemx", 1),
    (9, "TINY, Item! " + " ".join(BASE[2:]).upper() + " " + " ".join(BASE), 1), (None, " ".join(BASE), 2),
    (10, "a " * 50_000 + " ".join(BASE), 1), (11, "aa" * 300_000, 1),
]
ITEMS = [(1, " ".join(BASE)), (2, "tiny item"), (2, "other words"), (3, None), (4, ""), (10, " ".join(BASE)), (None, "a a a a a")]


@pytest.mark.parametrize("block_words", [1_000_000, 10])
def test_hand_cases(spark, block_words):
    docs, tests = spark.createDataFrame(CASES, DOC), spark.createDataFrame(ITEMS, ITEM)
    found = find_matches(docs, tests, block_words=block_words).collect()
    want = plain.contamination([((r.doc_id, r.text), r.text) for r in docs.collect()], ITEMS)
    for row in found:
        words, hit, items, _, _ = want[(row.doc_id, row.text)]
        got = row["__found"]
        assert (got.n_words, sum(b - a for a, b in got.spans), len(got.items)) == (words, hit, items), row.doc_id
    longest = {r.doc_id: r["__found"].longest for r in found}
    assert (longest[4], longest[6], longest[7], longest[9]) == (15, 13, 2, 15)
    assert len(found) == len(CASES)


def test_filter_keeps_rows_and_columns(spark):
    docs, tests = spark.createDataFrame(CASES, DOC), spark.createDataFrame(ITEMS, ITEM)
    kept = decontaminate(docs, tests)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 6, 8, 11]


def test_empty_tables(spark):
    docs, tests = spark.createDataFrame(CASES, DOC), spark.createDataFrame(ITEMS, ITEM)
    assert contamination(docs.where("false"), tests).collect() == []
    assert {r.n_hit for r in contamination(docs, tests.where("false")).collect()} == {0}
