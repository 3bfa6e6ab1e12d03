"""Explicit schemas of the tables the library reads and writes."""

from pyspark.sql import types as T

TOKEN_TABLE = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("seq_id", T.LongType()),
        T.StructField("num_tokens", T.LongType()),
        T.StructField("token_start", T.LongType()),
        T.StructField("byte_pointer", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.IntegerType())),
    ]
)

MESSAGES = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)

MIX = T.StructType(
    [
        T.StructField("ds_idx", T.IntegerType(), False),
        T.StructField("dataset", T.StringType(), False),
        T.StructField("weight", T.DoubleType()),
        T.StructField("name", T.StringType()),
    ]
)

JOB_ENTRY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("subset", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("text_column", T.StringType()),
        T.StructField("max_samples", T.LongType()),
        T.StructField("preprocess", T.StringType()),
        T.StructField("tokenizer", T.StringType()),
        T.StructField("streaming", T.BooleanType()),
        T.StructField("add_bos", T.BooleanType()),
        T.StructField("add_eos", T.BooleanType()),
        T.StructField("raw_dir", T.StringType()),
        T.StructField("max_seq_length", T.IntegerType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("stage", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("path", T.StringType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)
