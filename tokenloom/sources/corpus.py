"""Raw text corpora: Parquet and JSONL folders, explicit row order, caps, size-targeted shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tokenloom.functions.text import prepare_text
from tokenloom.operators.ordering import CHUNKS, chunk_by_order, div, first_rows, running_totals
from tokenloom.session import settle

# Fixed value: target size of one output shard.
SHARD_BYTES = 256 * 1024 * 1024
SHARD_DIGITS = 18

ROWS_PER_FILE_CHUNK = 1 << 10

# Scanned bytes of one task of a spread table. A union of several selections of it may be run
# partition by partition, and its tasks then read that many times as much.
SPREAD_BYTES = 8 << 20

# File names of each kind, in order of preference.
PATTERNS = {"parquet": "*.parquet", "jsonl": "*.jsonl"}


def read_corpus(
    spark: SparkSession, path: str, *columns: str, schema: T.StructType | None = None, jsonl: str = PATTERNS["jsonl"]
) -> DataFrame:
    """A Parquet file or folder, or a folder of JSONL files when it holds no Parquet.

    Only the named columns reach the scan. JSONL needs a ``schema``; ``jsonl`` are its file
    names, if others than usual. A folder with neither kind of file is an error.
    """
    kind = corpus_format(spark, path, jsonl)
    if kind == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.option("pathGlobFilter", PATTERNS[kind]).parquet(path)
    else:
        if schema is None:
            raise ValueError("JSONL needs an explicit schema")
        df = spark.read.schema(schema).option("pathGlobFilter", jsonl).json(path)
    return df.select(*columns) if columns else df


def corpus_format(spark: SparkSession, path: str, jsonl: str = PATTERNS["jsonl"]) -> str:
    """``parquet`` or ``jsonl``; Parquet wins when both are present."""
    if path.endswith(".parquet"):
        return "parquet"
    for kind, pattern in (PATTERNS | {"jsonl": jsonl}).items():
        if list_files(spark, path, pattern):
            return kind
    raise FileNotFoundError(f"no .parquet or .jsonl files in {path}")


def list_files(spark: SparkSession, path: str, pattern: str, folders: bool = False) -> list[str]:
    """Paths matching ``pattern`` directly under ``path``, on any file system Spark knows; only ``folders`` if asked."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop(f"{path}/{pattern}"))
    return [f.getPath().toString() for f in found or () if not folders or f.isDirectory()]


def scan_bytes(df: DataFrame) -> int:
    """The size of a scan, as the catalog knows it before anything is read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over all cores when its scan is too small to be cut that finely, else unchanged.

    Row work such as tokenizing otherwise runs in as many tasks as the input has row groups.
    The decision uses the scan's size from the catalog, so a large input is never exchanged.
    Below that the tasks' number follows the size, so that what one of them reads is bounded.
    """
    spark = df.sparkSession
    size = scan_bytes(df)
    cores = spark.sparkContext.defaultParallelism
    cut = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if size >= cores * cut:
        return df
    return df.repartition(max(cores, -(-size // SPREAD_BYTES)), key)


def with_file_order(df: DataFrame, rows_per_chunk: int = ROWS_PER_FILE_CHUNK) -> DataFrame:
    """Add the (file name, row position) order of a Parquet scan, with chunk columns to match.

    Take it straight from the reader: ``_metadata`` belongs to the scan.
    """
    return df.withColumns(
        {
            "file": F.col("_metadata.file_path"),
            "row": F.col("_metadata.row_index"),
            CHUNKS[0]: F.col("_metadata.file_path"),
            CHUNKS[1]: div(F.col("_metadata.row_index"), rows_per_chunk),
        }
    )


def with_line_order(df: DataFrame) -> DataFrame:
    """Add the (file name, line) order of a JSONL scan, with chunk columns to match.

    Take it straight from the reader. A text file has no row numbers: lines are told apart by
    where their split of the file starts and by the order in which the split is read, and
    numbered from that over all files. The parsed rows are written once on the way, so that
    another read of the files cannot cut them elsewhere.
    """
    placed = df.withColumns(
        {
            "file": F.col("_metadata.file_path"),
            "split__": F.col("_metadata.file_block_start"),
            "line__": F.monotonically_increasing_id(),
        }
    )
    order = ["file", "split__", "line__"]
    chunked = chunk_by_order(settle(placed, "lines"), order, group=[])
    numbered = running_totals(chunked, group=[], chunk=CHUNKS, order=order, totals={"row": F.lit(1)})
    return numbered.drop("split__", "line__")


def text_column(df: DataFrame, column: str = "text", preprocess: str | None = None) -> Column:
    """The corpus text of ``column`` after the named preparation."""
    return prepare_text(F.col(column), df.schema[column].dataType, preprocess)


def union_datasets(parts: dict[str, DataFrame]) -> DataFrame:
    """Several datasets as one table, each row tagged with its dataset's name."""
    tagged = [df.withColumn("dataset", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def cap_samples(
    df: DataFrame, max_samples: int | None, *, order: list[str], group: list[str] = ["dataset"], chunk: list[str] = CHUNKS
) -> DataFrame:
    """The first ``max_samples`` rows of each dataset; ``None`` keeps all."""
    if max_samples is None:
        return df
    return first_rows(df, group=group, chunk=chunk, order=order, limit=max_samples)


def string_bytes(df: DataFrame) -> Column:
    """UTF-8 bytes of all string columns of a row."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in strings], F.lit(0)).cast(
        "bigint"
    )


def assign_shards(
    df: DataFrame,
    *,
    order: list[str],
    size: Column,
    target_bytes: int = SHARD_BYTES,
    group: list[str] = ["dataset"],
    chunk: list[str] = CHUNKS,
) -> DataFrame:
    """Add ``shard`` so that shards follow row order and hold about ``target_bytes`` each.

    A shard exceeds the target by at most its last row.
    """
    placed = running_totals(
        df.withColumn("bytes", size),
        group=group, chunk=chunk, order=order, totals={"bytes_before": F.col("bytes")},
    )
    return placed.withColumn("shard", div(F.col("bytes_before"), target_bytes))


def assign_even_shards(
    df: DataFrame,
    *,
    order: list[str],
    size: Column,
    target_bytes: int = SHARD_BYTES,
    group: list[str] = ["dataset"],
    chunk: list[str] = CHUNKS,
) -> DataFrame:
    """Add ``shard`` by splitting the rows evenly over ``max(1, bytes div target)`` runs.

    The first ``rows mod shards`` shards are one row longer.
    """
    sized = df.withColumn("bytes", size)
    whole = sized.groupBy(*group).agg(F.count("*").alias("rows"), F.sum("bytes").alias("total_bytes"))
    shards = F.greatest(F.lit(1).cast("bigint"), div(F.col("total_bytes").cast("bigint"), target_bytes))
    base, extra = div(F.col("rows"), F.col("shards")), F.col("rows") % F.col("shards")
    long_rows = extra * (base + 1)
    position = F.col("position")
    shard = F.when(position < long_rows, div(position, base + 1)).otherwise(
        extra + F.try_divide(position - long_rows, base).cast("bigint")
    )
    placed = running_totals(sized, group=group, chunk=chunk, order=order, totals={"position": F.lit(1)})
    return (
        placed.join(settle(whole.withColumn("shards", shards).drop("total_bytes"), "totals"), group)
        .withColumn("shard", shard)
        .drop("position", "rows", "shards")
    )


def write_shards(
    df: DataFrame, path: str, *, order: list[str], columns: list[str], group: list[str] = ["dataset"], mode: str = "errorifexists"
) -> None:
    """One folder per dataset and shard, rows in order; folder names sort as the shards do.

    Each shard is one write task's file and holds ``columns``. Mode ``overwrite`` replaces
    what is under ``path``, as a run does that starts again after one that died.
    """
    named = df.withColumn("shard", F.lpad(F.col("shard").cast("string"), SHARD_DIGITS, "0"))
    placed = named.repartition(*group, "shard")
    rows = placed.sortWithinPartitions(*group, "shard", *order).select(*group, *columns, "shard")
    rows.write.mode(mode).partitionBy(*group, "shard").parquet(path)
