"""Queries over text and token columns, and the sequence index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.functions import text as texts, tokens as toks
from tokenloom.operators import index as idx, messages
from tokenloom.operators.ordering import chunk_by_key, chunk_by_order, div
from tokenloom.plans.prepare import tokenize as add_tokens
from tokenloom.schemas import MESSAGES
from tokenloom.session import scratch_path
from tokenloom.streaming import ingest
from workload.base import (
    INDEX_SQL,
    SIZES_SQL,
    TOKENIZER,
    WORDS_SQL,
    corpus,
    describe_sql,
    described,
    documents,
    ids_sql,
    sizes,
    stored_as_one,
    table,
)


def to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label cells as text; documents without a label have NULL there."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    cells = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("good", F.col("quality") == 1)
    return cells.select(
        "doc_id",
        *[texts.to_text(F.col(c), cells.schema[c].dataType).alias(c) for c in ("n_chars", "quality", "good")],
        texts.to_text(F.col("toxic"), null_as_empty=True).alias("toxic"),
    )


def flatten_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a document as a message; blank lines and padding test the rules."""
    lines = F.split("text", "\n")
    listed = documents(spark, sf_dir).select(
        "doc_id",
        F.transform(lines, lambda x: F.struct(F.lit("user").alias("role"), F.concat(F.lit(" "), x, F.lit("\t")).alias("content")))
        .cast(MESSAGES)
        .alias("messages"),
        F.transform(lines, lambda x: F.struct(F.lit("user").alias("role"), F.replace(x, F.lit("."), F.lit(" ")).alias("content")))
        .cast(MESSAGES)
        .alias("bare"),
    )
    flat = [texts.flatten_messages(F.col(c), MESSAGES.elementType).alias(c) for c in ("messages", "bare")]
    return listed.select("doc_id", *flat)


def flatten_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.flatten_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", turns_per_part=3)


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = add_tokens(documents(spark, sf_dir).select("doc_id", "text"), TOKENIZER)
    return described(docs, "doc_id", "num_tokens")


def truncate_and_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncation first, then both special tokens: up to two more than the limit."""
    tokenizer = toks.HashTokenizer(vocab_size=70000, add_bos=True, add_eos=True, max_len=64)
    docs = add_tokens(documents(spark, sf_dir).select("doc_id", "text"), tokenizer)
    checked = docs.withColumn("tokens", toks.check_ids(F.col("tokens"), tokenizer.id_count))
    return described(checked, "doc_id", "num_tokens")


def _lines(spark, sf_dir):
    tokenizer = toks.HashTokenizer(add_eos=False)
    lines = documents(spark, sf_dir).select(F.col("lang").alias("dataset"), "doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return add_tokens(lines, tokenizer)


def drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as sequences without EOS: blank ones are empty and go."""
    kept = idx.drop_empty(_lines(spark, sf_dir))
    return kept.select("doc_id", "line", "num_tokens", F.element_at("tokens", 1).alias("first_id"))


def count_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idx.count_empty(_lines(spark, sf_dir), ["dataset"])


def num_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sizes(spark, sf_dir)


def token_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = F.col("n_chars") * 40
    return table(spark, sf_dir, "documents").select("doc_id", toks.token_width(vocab).alias("width"))


def tokenize_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch columns on a stream, written as it arrives."""
    schema = table(spark, sf_dir, "documents").schema
    stream = ingest.read_stream(spark, f"{sf_dir}/documents.parquet", schema, max_files=64)
    rows = ingest.tokenize_stream(stream.select("doc_id", "text"), TOKENIZER)
    target = scratch_path(spark, "token-stream")
    ingest.ingest_stream(rows, target, scratch_path(spark, "token-stream-checkpoint")).awaitTermination()
    return described(spark.read.parquet(target), "doc_id", "num_tokens")


def sequence_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chunk_by_key(sizes(spark, sf_dir), "doc_id")
    placed = idx.index_sequences(rows, order=["doc_id"], width=toks.token_width(F.lit(TOKENIZER.id_count)))
    return placed.select("dataset", "doc_id", "seq_id", "num_tokens", "token_start", "token_end", "byte_pointer")


def sequence_index_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same index in the order of a key that is spread over its whole range."""
    hashed = sizes(spark, sf_dir).withColumn("key", F.md5(F.col("doc_id").cast("string")))
    placed = idx.index_sequences(chunk_by_order(hashed, ["key"]), order=["key"])
    return placed.select("dataset", "doc_id", "seq_id", "num_tokens", "token_start")


def document_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as sequences of conversations; a long conversation spans several chunks."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        TOKENIZER.count(F.col("text")).alias("num_tokens"),
        div(F.col("conv_id"), 1 << 20).alias("conv_chunk_hi"),
        div(F.col("conv_id"), 1 << 10).alias("conv_chunk"),
        div(F.col("turn"), 1 << 14).alias("turn_chunk"),
    )
    placed = idx.index_sequences(
        turns, group=[], order=["turn"], chunk=["conv_chunk_hi", "conv_chunk", "conv_id", "turn_chunk"]
    )
    return idx.document_index(placed, ["conv_id"])


def get_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled ids looked up as sequence ids in the stored table, with their tokens."""
    wanted = table(spark, sf_dir, "labels").select(F.lit("documents").alias("dataset"), F.col("doc_id").alias("seq_id"))
    return described(idx.get_sequences(stored_as_one(spark, sf_dir), wanted), "dataset", "seq_id", "num_tokens", "token_start")


def locate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token offsets scattered by the events over the whole stream."""
    index = stored_as_one(spark, sf_dir).drop("tokens")
    total = index.agg(F.sum("num_tokens")).scalar()
    offsets = table(spark, sf_dir, "events").select(
        F.lit("documents").alias("dataset"), ((F.col("event_id") * 7919 + F.col("user_id")) % total).alias("offset")
    )
    return idx.locate_tokens(index, offsets)


QUERIES = {
    f.__name__: f
    for f in (
        to_text,
        flatten_messages,
        flatten_turns,
        tokenize,
        truncate_and_mark,
        drop_empty,
        count_empty,
        num_tokens,
        token_width,
        tokenize_stream,
        sequence_index,
        sequence_index_by_hash,
        document_index,
        get_sequences,
        locate_tokens,
    )
}

BLANKS_SQL = "'" + texts.WHITESPACE + "'"

LINES_SQL = r"""
lines AS (
  SELECT doc_id, lang AS dataset, pos - 1 AS line, line_text AS text
  FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line_text,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents))"""

ONE_SQL = f"""
one AS (
  SELECT doc_id, num_tokens, tokens, row_number() OVER (ORDER BY doc_id) - 1 AS seq_id,
         (sum(num_tokens) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - num_tokens)::BIGINT AS token_start
  FROM sized)"""

ORACLES = {
    "to_text": """
        SELECT doc_id, n_chars::VARCHAR AS n_chars, coalesce(quality::VARCHAR, 'None') AS quality,
               CASE WHEN quality IS NULL THEN 'None' WHEN quality = 1 THEN 'True' ELSE 'False' END AS good,
               coalesce(toxic::VARCHAR, '') AS toxic
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "flatten_messages": f"""
        SELECT doc_id,
               array_to_string(list_transform(string_split(text, chr(10)), lambda x: trim(x, {BLANKS_SQL})),
                               chr(10) || chr(10)) AS messages,
               array_to_string(list_transform(
                   list_filter(list_transform(string_split(text, chr(10)), lambda x: replace(x, '.', ' ')),
                               lambda x: x <> ''),
                   lambda x: trim(x, {BLANKS_SQL})), chr(10) || chr(10)) AS bare
        FROM documents""",
    "flatten_turns": f"""
        SELECT conv_id, coalesce(string_agg(trim(text, {BLANKS_SQL}), chr(10) || chr(10) ORDER BY turn)
                                 FILTER (WHERE text <> ''), '') AS text
        FROM conversations GROUP BY conv_id""",
    "tokenize": f"WITH {INDEX_SQL} SELECT doc_id, num_tokens, {describe_sql()} FROM idx",
    "truncate_and_mark": f"""
        WITH t AS (SELECT doc_id, list_append(list_prepend(70001, ({ids_sql().replace('50000', '70000')})[1:64]), 70000) AS tokens
                   FROM documents)
        SELECT doc_id, len(tokens)::BIGINT AS num_tokens, {describe_sql()} FROM t""",
    "drop_empty": f"""
        WITH {LINES_SQL}, t AS (SELECT doc_id, line, {ids_sql()} AS tokens FROM lines)
        SELECT doc_id, line::INTEGER AS line, len(tokens)::BIGINT AS num_tokens, tokens[1] AS first_id
        FROM t WHERE len(tokens) > 0""",
    "count_empty": f"""
        WITH {LINES_SQL}
        SELECT dataset, count(*) FILTER (WHERE len({WORDS_SQL.format(text='text')}) > 0) AS num_kept,
               count(*) FILTER (WHERE len({WORDS_SQL.format(text='text')}) = 0) AS num_empty
        FROM lines GROUP BY dataset""",
    "num_tokens": f"WITH {INDEX_SQL} SELECT doc_id, dataset, len(tokens)::BIGINT AS num_tokens FROM idx",
    "token_width": "SELECT doc_id, CASE WHEN n_chars * 40 < 65536 THEN 2 ELSE 4 END AS width FROM documents",
    "tokenize_stream": f"WITH {INDEX_SQL} SELECT doc_id, num_tokens, {describe_sql()} FROM idx",
    "sequence_index": f"""
        WITH {INDEX_SQL}
        SELECT dataset, doc_id, seq_id, num_tokens, token_start, token_start + num_tokens AS token_end,
               token_start * 2 AS byte_pointer FROM idx""",
    "sequence_index_by_hash": f"""
        WITH {SIZES_SQL}
        SELECT dataset, doc_id, row_number() OVER by_key - 1 AS seq_id, num_tokens,
               (sum(num_tokens) OVER by_key - num_tokens)::BIGINT AS token_start
        FROM sized WINDOW by_key AS (PARTITION BY dataset ORDER BY md5(doc_id::VARCHAR) ROWS UNBOUNDED PRECEDING)""",
    "document_index": """
        SELECT conv_id, max(seq_id) AS last_seq_id
        FROM (SELECT conv_id, row_number() OVER (ORDER BY conv_id, turn) - 1 AS seq_id FROM conversations)
        GROUP BY conv_id""",
    "get_sequences": f"""
        WITH {SIZES_SQL}, {ONE_SQL}
        SELECT 'documents' AS dataset, seq_id, num_tokens, token_start, {describe_sql()}
        FROM one JOIN labels ON labels.doc_id = one.seq_id""",
    "locate_tokens": f"""
        WITH {SIZES_SQL}, {ONE_SQL},
        asked AS (SELECT (event_id * 7919 + user_id) % (SELECT sum(num_tokens)::BIGINT FROM one) AS "offset" FROM events)
        SELECT 'documents' AS dataset, "offset", seq_id, "offset" - token_start AS offset_in_seq
        FROM asked ASOF JOIN one ON asked."offset" >= one.token_start""",
}
