import hashlib

import pytest
from pyspark.sql import functions as F

from tokenloom.functions import tokens as toks
from tokenloom.plans.prepare import tokenize, tokenize_external
from tokenloom.sources import token_table
from workload import base, packing

TEXTS = ["one two\nthree", "", "  \n ", " a  b \n\n c ", "tab\tinside stays", "a" * 50, None]


def expected(text, tokenizer):
    if text is None:
        return None
    words = [w for w in text.replace("\n", " ").split(" ") if w]
    ids = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % tokenizer.vocab_size for w in words]
    if tokenizer.max_len is not None:
        ids = ids[: tokenizer.max_len]
    return [tokenizer.bos_id] * tokenizer.add_bos + ids + [tokenizer.eos_id] * tokenizer.add_eos


@pytest.mark.parametrize(
    "tokenizer",
    [
        toks.HashTokenizer(),
        toks.HashTokenizer(add_eos=False),
        toks.HashTokenizer(vocab_size=11, add_bos=True, max_len=2),
        toks.HashTokenizer(max_len=0, add_eos=False),
    ],
)
def test_hash_tokenizer(spark, tokenizer):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    for row in tokenize(df, tokenizer).collect():
        want = expected(TEXTS[row.i], tokenizer)
        assert row.tokens == want
        if want is not None:
            assert row.num_tokens == len(want)


def test_token_width(spark):
    df = spark.createDataFrame([(65535,), (65536,)], "v int").select(toks.token_width(F.col("v")).alias("w"))
    assert [r.w for r in df.collect()] == [2, 4]


def test_check_ids(spark):
    ids = F.array(F.lit(0), F.lit(9))
    assert spark.range(1).select(toks.check_ids(ids, 10).alias("v")).first().v == [0, 9]
    with pytest.raises(Exception, match="token id 9 outside vocabulary of 9"):
        spark.range(1).select(toks.check_ids(ids, 9)).collect()


def test_external_tokenizer_keeps_rows_and_order(spark):
    def load():
        return lambda texts: [[len(w) for w in t.split()] for t in texts]

    rows = [(i, " ".join("x" * (j + 1) for j in range(i % 5))) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, text string").repartition(4)
    got = tokenize_external(df, toks.external_tokenizer(load, batch_size=7)).collect()
    assert len(got) == 500
    assert all(r.tokens == list(range(1, r.i % 5 + 1)) and r.num_tokens == r.i % 5 for r in got)


def test_tokenizer_json(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.WordLevel({"[UNK]": 0, "a": 1, "b": 2}, unk_token="[UNK]"))
    tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
    encode = toks.external_tokenizer(toks.tokenizer_json(tokenizer.to_str()))
    df = spark.createDataFrame([("a b zzz",), ("",)], "text string")
    assert [r.tokens for r in tokenize_external(df, encode).collect()] == [[1, 2, 0], []]


def test_buckets_follow_the_stored_tokens(spark, monkeypatch):
    """Eight buckets for a small table, more for a larger one, and the same streams from either."""
    folder = "/root/testdata/sf0.001"
    tokens = base.stored(spark, folder)
    size = tokens.agg(F.sum("num_tokens")).first()[0] * 4
    assert token_table.bucket_count(tokens, size) == 1 and token_table.bucket_count(tokens, size - 1) == 2
    usual = sorted(packing.resumed_worker_streams(spark, folder).collect())
    monkeypatch.setattr(base, "_written", {})
    monkeypatch.setattr(base, "BUCKET_BYTES", size // 20)
    base.stored_in_buckets(spark, folder)
    name = next(v for k, v in base._written.items() if k[2] == "buckets")
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert int(described["Num Buckets"]) >= 20
    assert sorted(packing.resumed_worker_streams(spark, folder).collect()) == usual
