from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenloom.functions.tokens import HashTokenizer
from tokenloom.llm.packing import best_fit, fill_bins, pack_best_fit

SF_DIR = "/root/testdata/sf0.001"


def plain_best_fit(pieces, capacity):
    """Looks at every bin for every piece."""
    bins, out = [], []
    for size, source, cluster in pieces:
        fits = [
            (capacity - sum(p[0] for p in held), number)
            for number, held in enumerate(bins)
            if sum(p[0] for p in held) + size <= capacity
            and not any((source is not None and p[1] == source) or (cluster is not None and p[2] == cluster) for p in held)
        ]
        number = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([])
        out.append((number, len(bins[number]), sum(p[0] for p in bins[number])))
        bins[number].append((size, source, cluster))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.sampled_from("abcd") | st.none(), st.sampled_from("xyz") | st.none()), max_size=40))
def test_tightest_compatible_bin(pieces):
    assert best_fit(pieces, 20) == plain_best_fit(pieces, 20)


def check(docs, placed, capacity):
    """Everything placed once, nothing overlaps, no conflicts."""
    source = {r.doc_id: r.source for r in docs.collect()}
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in placed.collect():
        bins[r.bin_id].append(r)
        pieces[r.doc_id].append(r)
    for rows in bins.values():
        rows.sort(key=lambda r: r.position)
        assert [r.position for r in rows] == list(range(len(rows)))
        assert [r.offset for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
        assert sum(r.n_tokens for r in rows) <= capacity
        named = [source[r.doc_id] for r in rows if source[r.doc_id] is not None]
        assert len(named) == len(set(named))
    return bins, pieces


@pytest.mark.parametrize("group", [2048, 20])
def test_whole_corpus(spark, group):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    placed = pack_best_fit(docs, 512, group=group)
    _, pieces = check(docs, placed, 512)
    sizes = {r.doc_id: r.n for r in docs.select("doc_id", HashTokenizer().count(F.col("text")).alias("n")).collect()}
    assert {d: sum(r.n_tokens for r in rows) for d, rows in pieces.items()} == sizes
    for rows in pieces.values():
        rows.sort(key=lambda r: r.piece)
        assert [r.start for r in rows] == [512 * r.piece for r in rows]


CASES = [
    (1, None, "a", 1), (2, "", "a", 1), (3, "w " * 25, "a", 1), (4, "w w", None, 1), (5, "W  w", None, 1), (6, "w w", None, 1),
    (6, "w w", None, 1), (None, "x y z", "b", 1), (7, "   \n", None, 1), (8, "q " * 9, "c", 1), (9, "r " * 100_000, "d", 1),
]
SCHEMA = "doc_id long, text string, source string, piece int"


def test_hand_cases(spark):
    docs = spark.createDataFrame(CASES, SCHEMA)
    placed = pack_best_fit(docs, 10)
    bins, pieces = check(docs, placed, 10)
    assert {d: sum(r.n_tokens for r in rows) for d, rows in pieces.items()} == {
        1: 1, 2: 1, 3: 26, 4: 3, 5: 3, 6: 6, None: 4, 7: 1, 8: 10, 9: 100_001
    }
    copies = [r.bin_id for d in (4, 5, 6) for r in pieces[d]]
    assert len(set(copies)) == 4
    assert pack_best_fit(docs.where("false"), 10).collect() == []


def test_filled_bins_hold_all_tokens(spark):
    docs = spark.createDataFrame([c for c in CASES if c[0] in (2, 3, 4, 8)], SCHEMA)
    bins = {r.bin_id: r.tokens for r in fill_bins(docs, pack_best_fit(docs, 10)).collect()}
    ids = {r.doc_id: r.ids for r in docs.select("doc_id", HashTokenizer().ids(F.col("text")).alias("ids")).collect()}
    for r in pack_best_fit(docs, 10).collect():
        assert bins[r.bin_id][r.offset : r.offset + r.n_tokens] == ids[r.doc_id][r.start : r.start + r.n_tokens]
