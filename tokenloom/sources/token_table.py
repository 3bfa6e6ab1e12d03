"""The token table: one row per sequence, partitioned by dataset, ordered by sequence id."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.functions.tokens import token_width
from tokenloom.operators.ordering import CHUNK_KEYS, chunk_by_key, div, running_totals
from tokenloom.schemas import TOKEN_TABLE
from tokenloom.session import settle
from tokenloom.sources.corpus import list_files
from tokenloom.sources.publish import new_version, publish, published_versions, version_folder

# Bytes of one stored token before compression, and of the tokens of one compacted file.
TOKEN_BYTES = 4
FILE_BYTES = 256 * 1024 * 1024

# What names a sequence.
SEQUENCE = ["dataset", "seq_id"]


def write_tokens(df: DataFrame, path: str, mode: str = "errorifexists", presorted: bool = False) -> None:
    """Write an indexed token frame.

    Rows straight from the index sit in chunk partitions in sequence order; ``presorted``
    says so. Files then hold narrow ``seq_id`` and ``token_start`` ranges, lookups skip row
    groups, and nothing is exchanged or sorted for it. Mode ``replace`` puts the datasets of
    ``df`` in the place of what the table has of them and leaves others alone.
    """
    rows = df.select(*[f.name for f in TOKEN_TABLE])
    if not presorted:
        rows = rows.sortWithinPartitions("dataset", "seq_id")
    writer = rows.write.mode("overwrite" if mode == "replace" else mode).partitionBy("dataset")
    if mode == "replace":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def publish_tokens(df: DataFrame, path: str, name: str) -> None:
    """Write the indexed token frame of one dataset as its new version in the table under ``path``.

    Until the version is whole and published, readers find the one before it.
    """
    version, folder = new_version(path)
    write_tokens(df, folder, presorted=True)
    publish(df.sparkSession, path, name, version)


def read_tokens(spark: SparkSession, path: str, datasets: list[str] | None = None) -> DataFrame:
    """Read a token table; a wrong layout or a missing dataset is an error.

    ``datasets`` prunes to those partitions. Of a table of published versions, the latest of
    each dataset is read.
    """
    versions = published_versions(spark, path)
    if versions is not None:
        return _read_published(spark, path, versions, datasets)
    found = spark.read.parquet(path)
    for field in TOKEN_TABLE:
        if field.name not in found.columns:
            raise ValueError(f"{path} is not a token table: no column {field.name}")
        actual = found.schema[field.name].dataType.simpleString()
        if field.name != "dataset" and actual != field.dataType.simpleString():
            raise ValueError(f"{path}: column {field.name} is {actual}, not {field.dataType.simpleString()}")
    table = spark.read.schema(TOKEN_TABLE).parquet(path)
    if datasets is None:
        return table
    present = {unquote(p.rsplit("dataset=", 1)[1]) for p in list_files(spark, path, "dataset=*")}
    missing = sorted(set(datasets) - present)
    if missing:
        raise FileNotFoundError(f"{path} has no dataset {', '.join(missing)}")
    return table.where(F.col("dataset").isin(*datasets))


def _read_published(spark: SparkSession, path: str, versions: dict[str, str], datasets: list[str] | None) -> DataFrame:
    missing = sorted(set(datasets or ()) - set(versions))
    if missing:
        raise FileNotFoundError(f"{path} has no dataset {', '.join(missing)}")
    folders = [version_folder(path, v) for n, v in sorted(versions.items()) if datasets is None or n in datasets]
    return spark.read.schema(TOKEN_TABLE).option("basePath", path).parquet(*folders).select(*TOKEN_TABLE.fieldNames())


def compact_tokens(tokens: DataFrame, path: str, target_bytes: int = FILE_BYTES) -> None:
    """Write a stored token table again, in files of about ``target_bytes`` that follow the sequence order.

    A file is planned from the running token count: it holds the sequences that start in its
    ``target_bytes`` of a dataset's stream, so files hold disjoint ranges of ``seq_id``, their
    number follows from the bytes, and a lookup by id or offset skips the others.
    """
    start = F.col("token_start") * TOKEN_BYTES
    last = F.max(F.col("token_start") + F.col("num_tokens") - 1) * TOKEN_BYTES
    ends = tokens.groupBy("dataset").agg((div(last, target_bytes) + 1).alias("files__"))
    placed = settle(running_totals(ends, group=[], chunk=[], order=["dataset"], totals={"before__": F.col("files__")}), "files")
    files = placed.agg(F.sum("files__")).first()[0] or 1
    numbered = tokens.join(placed, "dataset").withColumn("file__", (F.col("before__") + div(start, target_bytes)).cast("int"))
    rows = numbered.repartitionById(int(files), "file__").sortWithinPartitions("dataset", "seq_id")
    rows.select(*[f.name for f in TOKEN_TABLE]).write.partitionBy("dataset").parquet(path)


def bucket_count(tokens: DataFrame, target_bytes: int = FILE_BYTES) -> int:
    """Buckets of about ``target_bytes`` for a stored token table; only its counts are read."""
    total = tokens.agg(F.coalesce(F.sum("num_tokens"), F.lit(0)).cast("bigint")).first()[0]
    return max(1, -(-total * TOKEN_BYTES // target_bytes))


def bucket_tokens(tokens: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Store a token table bucketed by (dataset, seq_id), as the catalog's table ``name``.

    Joins by sequence, as feeds make them, then move only their other, narrow side. Each
    bucket is one sorted file. A new session finds the table by :func:`open_buckets`.
    """
    rows = tokens.select(*[f.name for f in TOKEN_TABLE]).repartition(buckets, *SEQUENCE)
    rows.write.format("parquet").bucketBy(buckets, *SEQUENCE).sortBy(*SEQUENCE).option("path", path).saveAsTable(name)
    return tokens.sparkSession.table(name)


def open_buckets(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """The table that :func:`bucket_tokens` stored under ``path``, entered in this session's catalog if it is not there."""
    columns, keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TOKEN_TABLE), ", ".join(SEQUENCE)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def chunk_tokens(tokens: DataFrame, sequences_per_chunk: int = CHUNK_KEYS) -> DataFrame:
    """Chunk columns for a stored token table, by sequence id."""
    return chunk_by_key(tokens, "seq_id", sequences_per_chunk)


def dataset_stats(
    index: DataFrame,
    *,
    vocab_size: Column | int,
    tokenizer: str = "hash",
    add_bos: bool = False,
    add_eos: bool = True,
    document: str | None = None,
    group: list[str] = ["dataset"],
) -> DataFrame:
    """The metadata of each dataset: sequences, documents, tokens, id width and what was added.

    ``document`` names the document key when a document may hold several sequences; without
    it every sequence is a document.
    """
    vocab = F.lit(vocab_size) if isinstance(vocab_size, int) else vocab_size
    documents = F.count("*") if document is None else F.count_distinct(document)
    return (
        index.groupBy(*group)
        .agg(
            F.count("*").alias("num_sequences"),
            documents.alias("num_documents"),
            F.sum("num_tokens").cast("bigint").alias("num_tokens"),
            F.max("num_tokens").cast("bigint").alias("longest_sequence"),
        )
        .withColumns(
            {
                "width": token_width(vocab),
                "vocab_size": vocab.cast("bigint"),
                "tokenizer": F.lit(tokenizer),
                "add_bos": F.lit(add_bos),
                "add_eos": F.lit(add_eos),
            }
        )
    )
