"""From raw text to an indexed token table: read, prepare, cap, tokenize, index, write, mark."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.functions.tokens import HashTokenizer, num_tokens, token_width
from tokenloom.operators.index import index_sequences
from tokenloom.operators.ordering import CHUNK_KEYS, CHUNKS, chunk_by_key, chunk_by_order
from tokenloom.plans.jobs import DOWNLOAD, TOKENIZE, fill_defaults, job_entries, plan, select_datasets
from tokenloom.sources.corpus import (
    PATTERNS,
    SHARD_BYTES,
    assign_shards,
    cap_samples,
    list_files,
    read_corpus,
    string_bytes,
    text_column,
    with_file_order,
    with_line_order,
    write_shards,
)
from tokenloom.sources.ledger import mark_done, read_ledger
from tokenloom.sources.publish import new_version, publish, published_versions, version_folder
from tokenloom.sources.token_table import dataset_stats, publish_tokens, read_tokens
from tokenloom.streaming.ingest import ingest_in_order, read_stream

# Datasets that are worked on at a time.
PARALLEL = 4


def with_text(df: DataFrame, column: str = "text", preprocess: str | None = None) -> DataFrame:
    """The prepared text of ``column`` as ``text``."""
    text = text_column(df, column, preprocess)
    if column != "text":
        df = df.drop("text") if "text" in df.columns else df
        return df.withColumn("text", text).drop(column)
    return df.withColumn("text", text)


def tokenize(df: DataFrame, tokenizer: HashTokenizer, text: str = "text") -> DataFrame:
    """Add ``num_tokens`` and ``tokens`` with the built-in tokenizer.

    The count has its own expression: what needs sizes only never hashes a word.
    """
    return df.withColumns({"num_tokens": tokenizer.count(F.col(text)), "tokens": tokenizer.ids(F.col(text))})


def tokenize_external(df: DataFrame, encode, text: str = "text") -> DataFrame:
    """Add ``tokens`` and ``num_tokens`` with a plugged-in tokenizer column function."""
    return df.withColumn("tokens", encode(F.col(text))).withColumn("num_tokens", num_tokens(F.col("tokens")))


def _chunked(corpus: DataFrame, key: str | None, dense_key: bool, keys_per_chunk: int = CHUNK_KEYS) -> DataFrame:
    """With chunk columns for the key; a corpus without one has those of its files."""
    if key is None:
        return corpus
    if dense_key:
        return chunk_by_key(corpus, key, keys_per_chunk)
    return chunk_by_order(corpus, [key], rows_per_chunk=keys_per_chunk)


def index_corpus(
    corpus: DataFrame,
    tokenizer: HashTokenizer = HashTokenizer(),
    *,
    key: str | None = None,
    dense_key: bool = False,
    keys_per_chunk: int = CHUNK_KEYS,
) -> DataFrame:
    """Token table rows for a ``dataset``, ``text`` corpus in the order of a ``key``.

    The key may be anything that sorts; ``dense_key`` says that it is an integer without wide
    gaps, which saves ranking the keys first. Without a key the corpus carries the columns of :func:`with_file_order` and keeps that
    order. Text is what gets exchanged into order; it is tokenized afterwards, in the
    partitions it ends up in, however unevenly the input files are cut.
    """
    rows = _chunked(corpus, key, dense_key, keys_per_chunk)
    counted = rows.withColumn("num_tokens", tokenizer.count(F.col("text")))
    width = token_width(F.lit(tokenizer.id_count))
    indexed = index_sequences(counted, order=[key or "row"], width=width)
    return indexed.withColumn("tokens", tokenizer.ids(F.col("text"))).drop("text")


def _is_jsonl(spark: SparkSession, path: str) -> bool:
    """A folder of JSONL files without Parquet among them."""
    return bool(list_files(spark, path, PATTERNS["jsonl"])) and not list_files(spark, path, PATTERNS["parquet"])


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet or JSONL folder with its file order; the schema is what the files have.

    Of a folder with a published version, that is what is read.
    """
    versions = published_versions(spark, path)
    if versions:
        (path,) = [version_folder(path, v) for v in versions.values()]
    if not _is_jsonl(spark, path):
        return with_file_order(spark.read.parquet(path))
    found = spark.read.option("pathGlobFilter", PATTERNS["jsonl"]).json(path).schema
    return with_line_order(read_corpus(spark, path, schema=found))


def prepare_corpus(
    raw: DataFrame,
    *,
    name: str,
    target: str,
    ledger: str,
    key: str | None = None,
    dense_key: bool = False,
    tokenizer: HashTokenizer = HashTokenizer(),
    text: str = "text",
    preprocess: str | None = None,
    max_samples: int | None = None,
) -> DataFrame:
    """Write one dataset into the token table, mark it done and return its metadata row.

    ``raw`` comes from :func:`read_ordered` or straight from a Parquet reader, or has a ``key``
    for its order.
    """
    spark: SparkSession = raw.sparkSession
    if key:
        rows, order = raw.select(key, text), [key]
    else:
        placed = raw if {"file", "row", *CHUNKS} <= set(raw.columns) else with_file_order(raw)
        rows = placed.select(text, "row", *CHUNKS)
        order = ["row"]
    corpus = with_text(rows, text, preprocess).withColumn("dataset", F.lit(name))
    if max_samples is not None:
        corpus = cap_samples(_chunked(corpus, key, dense_key), max_samples, order=order).drop(*(CHUNKS if key else []))
    publish_tokens(index_corpus(corpus, tokenizer, key=key, dense_key=dense_key), target, name)
    mark_done(spark.createDataFrame([(name, target)], "name string, path string"), ledger, TOKENIZE)
    return dataset_stats(
        read_tokens(spark, target, [name]), vocab_size=tokenizer.id_count, add_bos=tokenizer.add_bos, add_eos=tokenizer.add_eos
    )


def ingest_corpus(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    name: str,
    ledger: str,
    streaming: bool = True,
    max_samples: int | None = None,
    target_bytes: int = SHARD_BYTES,
) -> None:
    """Bring a reachable dataset into its raw folder and mark it done.

    Rows are laid out in size-targeted shards in source order, capped if asked. Streaming
    takes files in as they come and resumes after a stop; otherwise all is laid out at once,
    as a version that readers of the raw folder find when it is whole. JSONL datasets are never streamed.
    """
    if streaming and not _is_jsonl(spark, source):
        schema = spark.read.parquet(source).schema
        ingest_in_order(
            read_stream(spark, source, schema), target, f"{target}/_stream_checkpoint",
            columns=schema.names, max_samples=max_samples, target_bytes=target_bytes,
        ).awaitTermination()
    else:
        rows, order = read_ordered(spark, source), ["row"]
        capped = cap_samples(rows, max_samples, order=order, group=[])
        columns = [c for c in rows.columns if c not in ("file", "row", *CHUNKS)]
        size = string_bytes(capped.select(*columns))
        placed = assign_shards(capped, order=order, size=size, target_bytes=target_bytes, group=[])
        version, folder = new_version(target)
        write_shards(placed, folder, group=[], order=["file", "row"], columns=columns)
        publish(spark, target, name, version)
    mark_done(spark.createDataFrame([(name, target)], "name string, path string"), ledger, DOWNLOAD)


def run_jobs(
    spark: SparkSession, settings: dict, stage: str, *, only=None, overrides=None, dry_run=False, parallel: int = PARALLEL
) -> DataFrame:
    """Run a stage for every entry of a job list that still needs it; returns the plan.

    ``source_dir`` holds the datasets, ``input_dir`` the raw folders, ``output_dir`` the token
    table and ``ledger`` the completion marks. A download is followed by the tokenizing of
    what is downloaded, unless the setting ``tokenize`` says no. Each entry is jobs over the
    whole cluster; ``parallel`` of them run side by side, so that small datasets and the ends
    of large ones leave no core idle. An entry that fails does not stop the others; the first
    failure is raised when all have ended.
    """
    entries = select_datasets(fill_defaults(job_entries(spark, settings), settings, overrides), only)
    todo = plan(entries, read_ledger(spark, settings["ledger"]), stage)
    if dry_run:
        return todo
    listed = todo.collect()
    follows = stage == DOWNLOAD and settings.get("tokenize", True)
    asked = listed if stage == TOKENIZE else entries.collect() if follows else []
    if unknown := sorted({e.tokenizer for e in asked} - {None, "hash"}):
        raise ValueError(f"unknown tokenizers: {', '.join(unknown)}; available: hash")
    _side_by_side(spark, {DOWNLOAD: _download, TOKENIZE: _tokenize}[stage], settings, listed, parallel)
    if follows:
        run_jobs(spark, settings, TOKENIZE, only=only, overrides=overrides, parallel=parallel)
    return spark.createDataFrame(listed, todo.schema) if listed else todo.limit(0)


def _side_by_side(spark: SparkSession, run, settings: dict, listed: list, parallel: int) -> None:
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(run), spark, settings, entry) for entry in listed]
    failures = [e for e in (job.exception() for job in started) if e]
    if failures:
        raise failures[0]


def _download(spark: SparkSession, settings: dict, entry) -> None:
    parts = [settings["source_dir"], entry.dataset, entry.subset, entry.split]
    ingest_corpus(
        spark, "/".join(p for p in parts if p), f"{settings['input_dir']}/{entry.raw_dir}", name=entry["name"],
        ledger=settings["ledger"], streaming=entry.streaming, max_samples=entry.max_samples,
    )


def _tokenize(spark: SparkSession, settings: dict, entry) -> None:
    prepare_corpus(
        read_ordered(spark, f"{settings['input_dir']}/{entry.raw_dir}"), name=entry["name"], target=settings["output_dir"],
        ledger=settings["ledger"], text=entry.text_column, preprocess=entry.preprocess,
        tokenizer=HashTokenizer(add_bos=entry.add_bos, add_eos=entry.add_eos, max_len=entry.max_seq_length),
    )
