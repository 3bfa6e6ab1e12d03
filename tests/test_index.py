import pytest
from pyspark.sql import functions as F

from tokenloom.operators import index as idx
from tokenloom.operators.ordering import chunk_by_key

SIZES = [3, 5, 0, 4, 0, 1, 20]


def indexed(spark):
    rows = [("d", i, n) for i, n in enumerate(SIZES)] + [("e", 9, 2)]
    df = chunk_by_key(spark.createDataFrame(rows, "dataset string, doc bigint, num_tokens bigint"), "doc", 2, 2)
    return idx.index_sequences(df, order=["doc"], width=2)


def test_ids_are_dense_after_dropping_empties(spark):
    got = [(r.doc, r.seq_id, r.token_start, r.token_end, r.byte_pointer) for r in
           indexed(spark).where("dataset = 'd'").orderBy("seq_id").collect()]
    assert got == [(0, 0, 0, 3, 0), (1, 1, 3, 8, 6), (3, 2, 8, 12, 16), (5, 3, 12, 13, 24), (6, 4, 13, 33, 26)]


def test_count_empty(spark):
    df = spark.createDataFrame([("d", n) for n in SIZES], "dataset string, num_tokens int")
    row = idx.count_empty(df, ["dataset"]).first()
    assert (row.num_kept, row.num_empty) == (5, 2)


def test_document_index(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 2)], "doc string, seq_id int")
    assert {r.doc: r.last_seq_id for r in idx.document_index(df, ["doc"]).collect()} == {"a": 1, "b": 2}


def test_get_sequences_with_repeats(spark):
    wanted = spark.createDataFrame([("d", 4), ("d", 0), ("d", 0), ("e", 0)], "dataset string, seq_id bigint")
    got = sorted((r.dataset, r.seq_id, r.num_tokens) for r in idx.get_sequences(indexed(spark), wanted).collect())
    assert got == [("d", 0, 3), ("d", 0, 3), ("d", 4, 20), ("e", 0, 2)]


@pytest.mark.parametrize("bad", [("d", 5), ("d", -1), ("missing", 0)])
def test_get_sequences_out_of_range(spark, bad):
    wanted = spark.createDataFrame([("d", 0), bad], "dataset string, seq_id bigint")
    with pytest.raises(Exception, match="sequence out of range"):
        idx.get_sequences(indexed(spark), wanted).collect()


@pytest.mark.parametrize("span", [1, 3, 7, 4096])
def test_locate_every_offset(spark, span):
    offsets = spark.range(33).select(F.lit("d").alias("dataset"), F.col("id").alias("offset"))
    got = sorted((r.offset, r.seq_id, r.offset_in_seq) for r in idx.locate_tokens(indexed(spark), offsets, span=span).collect())
    sizes = [n for n in SIZES if n]
    want = [(sum(sizes[:s]) + i, s, i) for s, n in enumerate(sizes) for i in range(n)]
    assert got == want


def test_offset_outside_the_stream_fails(spark):
    offsets = spark.createDataFrame([("a", -1)], "dataset string, offset long")
    with pytest.raises(Exception, match="token offset out of range"):
        idx.locate_tokens(indexed(spark), offsets).collect()
