"""Shared inputs of the registered queries, and the SQL that mirrors them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.functions.tokens import HashTokenizer
from tokenloom.plans.prepare import index_corpus
from tokenloom.session import scratch_path
from tokenloom.sources.corpus import spread
from tokenloom.sources.token_table import bucket_count, bucket_tokens, compact_tokens, read_tokens, write_tokens

TOKENIZER = HashTokenizer()
# One token more than a sample, for the labels.
BLOCK_LEN = 2049
SEED = 42
WORKERS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, ready for row work on their texts."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language: four datasets of unequal size, one of them holding most rows."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("dataset"), "text")


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their token count and without their text."""
    return corpus(spark, sf_dir).select("doc_id", "dataset", TOKENIZER.count(F.col("text")).alias("num_tokens"))


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token table rows of the corpus."""
    return index_corpus(corpus(spark, sf_dir), TOKENIZER, key="doc_id", dense_key=True)


_written: dict[tuple[str, str, str], str] = {}

# Small tables, so small files and few buckets; the bytes of a bucket in a larger table.
FILE_BYTES = 1 << 20
BUCKETS = 8
BUCKET_BYTES = 16 << 20


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as a written token table, as a training run finds it.

    Each session tokenizes a corpus once and its feeds read the result; what needs ids and
    sizes reads just those columns.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "tokens")
    if key not in _written:
        path = scratch_path(spark, "token-table")
        write_tokens(indexed(spark, sf_dir), path, presorted=True)
        _written[key] = path
    return read_tokens(spark, _written[key])


def stored_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table compacted, as lookups find it."""
    key = (spark.sparkContext.applicationId, sf_dir, "ranges")
    if key not in _written:
        path = scratch_path(spark, "token-ranges")
        compact_tokens(stored(spark, sf_dir), path, FILE_BYTES)
        _written[key] = path
    return read_tokens(spark, _written[key])


def stored_as_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one dataset, stored and compacted."""
    key = (spark.sparkContext.applicationId, sf_dir, "one")
    if key not in _written:
        path = scratch_path(spark, "one-dataset")
        docs = corpus(spark, sf_dir).withColumn("dataset", F.lit("documents"))
        write_tokens(index_corpus(docs, TOKENIZER, key="doc_id", dense_key=True), path, presorted=True)
        compact_tokens(read_tokens(spark, path), f"{path}-ranges", FILE_BYTES)
        _written[key] = f"{path}-ranges"
    return read_tokens(spark, _written[key])


def stored_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table in buckets, as feeds find it."""
    key = (spark.sparkContext.applicationId, sf_dir, "buckets")
    if key not in _written:
        path = scratch_path(spark, "token-buckets")
        name = path.rsplit("/", 1)[1].replace("-", "_")
        tokens = stored(spark, sf_dir)
        bucket_tokens(tokens, name, path, max(BUCKETS, bucket_count(tokens, BUCKET_BYTES)))
        _written[key] = name
    return spark.table(_written[key])


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at a precision that does not depend on the order of addition."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(name, digits) for name in doubles})


def digest(tokens: Column) -> Column:
    return F.md5(F.array_join(tokens.cast("array<string>"), ","))


def described(df: DataFrame, *keep: str, tokens: str = "tokens") -> DataFrame:
    """Token arrays as length, ends and digest, which every engine compares alike."""
    ids = F.col(tokens)
    return df.select(
        *keep,
        F.size(ids).cast("bigint").alias("length"),
        F.get(ids, F.lit(0)).cast("bigint").alias("first_id"),
        F.try_element_at(ids, F.lit(-1)).cast("bigint").alias("last_id"),
        digest(ids).alias("tokens_md5"),
    )


# ---- SQL fragments -------------------------------------------------------------------

WORDS_SQL = r"list_filter(string_split_regex({text}, '[ \n]+'), lambda w: w <> '')"
IDS_SQL = "list_transform({words}, lambda w: (('0x' || substr(md5(w), 1, 8))::BIGINT % 50000)::INTEGER)"


def ids_sql(text: str = "text") -> str:
    return IDS_SQL.format(words=WORDS_SQL.format(text=text))


def describe_sql(tokens: str = "tokens") -> str:
    return (
        f"len({tokens})::BIGINT AS length, {tokens}[1]::BIGINT AS first_id, {tokens}[-1]::BIGINT AS last_id, "
        f"md5(array_to_string({tokens}, ',')) AS tokens_md5"
    )


SIZES_SQL = f"""
sized AS (
  SELECT doc_id, lang AS dataset, list_append({ids_sql()}, 50000) AS tokens,
         len({WORDS_SQL.format(text='text')})::BIGINT + 1 AS num_tokens
  FROM documents)"""

INDEX_SQL = f"""{SIZES_SQL},
idx AS (
  SELECT dataset, doc_id, tokens, num_tokens,
         row_number() OVER (PARTITION BY dataset ORDER BY doc_id) - 1 AS seq_id,
         (sum(num_tokens) OVER (PARTITION BY dataset ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - num_tokens)::BIGINT
           AS token_start
  FROM sized)"""

FLAT_SQL = f"""{INDEX_SQL},
flat AS (
  SELECT dataset, token_start + pos - 1 AS off, tok
  FROM (SELECT dataset, token_start, unnest(tokens) AS tok, generate_subscripts(tokens, 1) AS pos FROM idx))"""

BLOCKS_SQL = f"""{FLAT_SQL},
blocks AS (
  SELECT dataset, off // {BLOCK_LEN} AS block_id, list(tok ORDER BY off) AS tokens
  FROM flat GROUP BY ALL HAVING count(*) = {BLOCK_LEN})"""
