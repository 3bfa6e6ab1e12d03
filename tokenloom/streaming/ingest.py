"""Incremental ingest and tokenizing of files as they arrive.

Progress lives in the stream's checkpoint, so a stopped run continues with the files it has
not finished, and a repeated run adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tokenloom.functions.tokens import HashTokenizer
from tokenloom.operators.ordering import CHUNKS, div, running_totals
from tokenloom.sources.corpus import ROWS_PER_FILE_CHUNK, SHARD_BYTES, SHARD_DIGITS, cap_samples, string_bytes, write_shards


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    kind: str = "parquet",
    pattern: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Files under ``path`` as a stream, at most ``max_files`` or ``max_bytes`` per micro-batch.

    A stream watches a folder; given a single file, it watches that name in the file's folder.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).isFile(hadoop):
        path, pattern = hadoop.getParent().toString(), hadoop.getName()
    reader = spark.readStream.schema(schema).format(kind)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def ingest_stream(stream: DataFrame, target: str, checkpoint: str, partition_by: list[str] = []) -> StreamingQuery:
    """Append everything available now to a Parquet folder, each row exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(target)


def ingest_in_order(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    *,
    columns: list[str],
    max_samples: int | None = None,
    target_bytes: int = SHARD_BYTES,
) -> StreamingQuery:
    """Bring everything available now into size-targeted shards in source order, each row exactly once.

    Straight from :func:`read_stream` of Parquet: the order is micro-batch by micro-batch, and
    by file name and row within one. A micro-batch goes on where the rows and bytes of the
    earlier ones end, so shards have their size across them and a cap counts all rows; where
    that is, each writes under its own number, and a replayed one replaces its own shards.
    """
    kept = stream.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    progress = f"{target}/_progress"

    def bring_in(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _progress(spark, progress, number)
        rows = batch.withColumns({CHUNKS[0]: F.col("file"), CHUNKS[1]: div(F.col("row"), ROWS_PER_FILE_CHUNK)})
        left = None if max_samples is None else max(0, max_samples - before["rows"])
        capped = cap_samples(rows, left, order=["row"], group=[])
        size = string_bytes(capped.select(*columns))
        placed = running_totals(
            capped.withColumn("bytes", size), group=[], chunk=CHUNKS, order=["row"], totals={"bytes_before": F.col("bytes")}
        )
        shard = div(F.col("bytes_before") + before["bytes"], target_bytes)
        here = f"{target}/batch={number:0{SHARD_DIGITS}d}"
        write_shards(placed.withColumn("shard", shard), here, order=["file", "row"], columns=columns, group=[], mode="overwrite")
        written = spark.read.schema(batch.select(*columns).schema).parquet(here).select(*columns)
        written = written.agg(F.count("*").alias("rows"), F.coalesce(F.sum(string_bytes(written)), F.lit(0)).alias("bytes"))
        after = written.select((F.col("rows") + before["rows"]).alias("rows"), (F.col("bytes") + before["bytes"]).alias("bytes"))
        after.write.mode("overwrite").parquet(f"{progress}/batch={number}")

    return kept.writeStream.foreachBatch(bring_in).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _progress(spark: SparkSession, path: str, number: int) -> dict:
    """Rows and bytes of all micro-batches before the given one, as the one before it wrote them."""
    if number == 0:
        return {"rows": 0, "bytes": 0}
    return spark.read.schema("rows long, bytes long").parquet(f"{path}/batch={number - 1}").first().asDict()


def tokenize_stream(stream: DataFrame, tokenizer: HashTokenizer, text: str = "text") -> DataFrame:
    """The batch tokenizer's columns on a stream: ``num_tokens`` and ``tokens``, empty rows dropped."""
    return count_stream(stream, tokenizer, text).withColumn("tokens", tokenizer.ids(F.col(text))).drop(text)


def count_stream(stream: DataFrame, tokenizer: HashTokenizer, text: str = "text") -> DataFrame:
    """Only ``num_tokens`` beside the text, empty rows dropped."""
    return stream.withColumn("num_tokens", tokenizer.count(F.col(text))).where(F.col("num_tokens") > 0)
