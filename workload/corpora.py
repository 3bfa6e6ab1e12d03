"""Queries over raw corpora: reading, order, caps, shards, ledger, job plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tokenloom.operators.ordering import chunk_by_key, running_totals
from tokenloom.plans import jobs
from tokenloom.functions.text import dataset_name, raw_slug
from tokenloom.session import scratch_path
from tokenloom.sources import corpus as raw, ledger as runs, token_table
from tokenloom.streaming import ingest
from workload.base import INDEX_SQL, TOKENIZER, corpus, describe_sql, described, indexed, sizes, table

SHARD_BYTES = 64 * 1024
CAP = 50
# Files of a delivery that fits them, the scanned bytes of each in a larger one, and the size of an ordered shard.
FILES = 5
FILE_BYTES = 16 << 20
ORDERED_BYTES = 1 << 18


def read_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.read_corpus(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")


def jsonl_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON lines and read back with a declared schema."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    path = scratch_path(spark, "jsonl")
    docs.write.json(path)
    return raw.read_corpus(spark, path, "doc_id", "lang", "text", schema=docs.schema, jsonl="*.json")


def _delivered(docs: DataFrame, size: int) -> DataFrame:
    """Rows in order over files; a larger table (``size`` bytes) comes in more files, as one task writes each."""
    files = max(FILES, -(-size // FILE_BYTES))
    return docs.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")


def jsonl_line_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line of every document over several files of JSON lines."""
    source = table(spark, sf_dir, "documents")
    docs = source.select("doc_id", "text")
    path = scratch_path(spark, "jsonl-order")
    _delivered(docs, raw.scan_bytes(source)).write.json(path)
    lines = raw.with_line_order(raw.read_corpus(spark, path, schema=docs.schema, jsonl="*.json"))
    return lines.select("doc_id", "row", F.md5("text").alias("text_md5"))


def ingest_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of several files each, streamed into shards that follow the source order."""
    source = table(spark, sf_dir, "documents")
    docs = source.select("doc_id", "source", "text")
    half = F.col("doc_id") < docs.agg(F.expr("max(doc_id) div 2")).scalar()
    paths = {name: scratch_path(spark, name) for name in ("deliveries", "ordered", "ordered-checkpoint")}
    for part in (half, ~half):
        _delivered(docs.where(part), raw.scan_bytes(source) // 2).write.mode("append").parquet(paths["deliveries"])
        stream = ingest.read_stream(spark, paths["deliveries"], docs.schema)
        ingest.ingest_in_order(
            stream, paths["ordered"], paths["ordered-checkpoint"], columns=docs.columns, target_bytes=ORDERED_BYTES
        ).awaitTermination()
    rows = raw.with_file_order(spark.read.parquet(paths["ordered"])).select("doc_id", "shard", "row", "chunk_hi", "chunk")
    placed = running_totals(rows, group=[], chunk=["chunk_hi", "chunk"], order=["row"], totals={"position": F.lit(1)})
    return placed.select("doc_id", F.col("shard").cast("bigint").alias("shard"), "position")


def file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position of every document in (file, row) order."""
    rows = raw.with_file_order(table(spark, sf_dir, "documents")).select("doc_id", "row", "chunk_hi", "chunk")
    placed = running_totals(
        rows, group=[], chunk=["chunk_hi", "chunk"], order=["row"], totals={"position": F.lit(1)}
    )
    return placed.select("doc_id", "position")


def cap_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = chunk_by_key(corpus(spark, sf_dir), "doc_id")
    return raw.cap_samples(docs, CAP, order=["doc_id"]).select("dataset", "doc_id", F.md5("text").alias("text_md5"))


def max_samples_per_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation limit: the first examples of every task, a task here being a source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("task"))
    capped = raw.cap_samples(chunk_by_key(docs, "doc_id"), 10, order=["doc_id"], group=["task"])
    return capped.select("task", "doc_id")


def _sized_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("lang", "dataset")
    size = raw.string_bytes(docs)
    return chunk_by_key(docs.select("dataset", "doc_id", size.alias("size")), "doc_id")


def assign_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _sized_documents(spark, sf_dir)
    placed = raw.assign_shards(docs, order=["doc_id"], size=F.col("size"), target_bytes=SHARD_BYTES)
    return placed.select("dataset", "doc_id", "bytes", "shard")


def assign_even_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _sized_documents(spark, sf_dir)
    placed = raw.assign_even_shards(docs, order=["doc_id"], size=F.col("size"), target_bytes=SHARD_BYTES)
    return placed.select("dataset", "doc_id", "shard")


def write_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard folders written and read back: rows, text bytes and id range of each."""
    docs = chunk_by_key(corpus(spark, sf_dir), "doc_id")
    placed = raw.assign_shards(docs, order=["doc_id"], size=F.octet_length("text").cast("bigint"), target_bytes=SHARD_BYTES)
    path = scratch_path(spark, "shards")
    raw.write_shards(placed, path, order=["doc_id"], columns=["doc_id", "text"])
    return spark.read.parquet(path).groupBy("dataset", F.col("shard").cast("bigint").alias("shard")).agg(
        F.count("*").alias("rows"),
        F.sum(F.octet_length("text")).alias("bytes"),
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
    )


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents taken in as a stream; the run is repeated to show it adds nothing."""
    source = table(spark, sf_dir, "documents")
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-checkpoint")
    for _ in range(2):
        stream = ingest.read_stream(spark, f"{sf_dir}/documents.parquet", source.schema, max_files=64)
        query = ingest.ingest_stream(stream.select("doc_id", "lang", "text"), target, checkpoint, ["lang"])
        query.awaitTermination()
    return spark.read.parquet(target).select("doc_id", "lang", F.md5("text").alias("text_md5"))


def unfinished_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources left to do when those with a toxic document have been marked done."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    work = docs.groupBy(F.col("source").alias("name")).agg(F.count("*").alias("documents"))
    done = docs.join(toxic, "doc_id", "left_semi").select(F.col("source").alias("name")).distinct()
    path = scratch_path(spark, "ledger")
    runs.mark_done(done.withColumn("path", F.col("name")), path, jobs.DOWNLOAD)
    return runs.unfinished(work, runs.read_ledger(spark, path), jobs.DOWNLOAD)


def union_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {
        "documents": table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text"),
        "conversations": table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("row_id"), "text"),
        "benchmark": table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("row_id"), "text"),
    }
    return raw.union_datasets(parts).select("dataset", "row_id", F.md5("text").alias("text_md5"))


def token_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_table.write_tokens(indexed(spark, sf_dir), path, presorted=True)
    tokens = token_table.read_tokens(spark, path)
    return described(tokens, "dataset", "seq_id", "num_tokens", "token_start", "byte_pointer")


def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table.dataset_stats(sizes(spark, sf_dir), vocab_size=TOKENIZER.id_count)


def _entries(spark, sf_dir):
    """Job entries told by the documents: one per source and language."""
    docs = table(spark, sf_dir, "documents")
    listed = docs.groupBy("source", "lang").agg(
        F.count("*").alias("documents"), F.min("doc_id").alias("first_doc"), F.sum("n_chars").alias("chars")
    )
    first = F.col("first_doc") % 3
    return listed.select(
        F.when(first == 0, F.concat_ws("-", "source", "lang")).alias("name"),
        F.concat(F.lit("Some Org/"), F.col("source"), F.lit(" Set")).alias("dataset"),
        F.col("lang").alias("subset"),
        F.when(first == 1, F.lit("test")).alias("split"),
        F.when(first == 2, F.lit("content")).alias("text_column"),
        F.when(F.col("documents") > 5, F.col("documents") - 5).alias("max_samples"),
        F.when(first == 1, F.lit(False)).alias("streaming"),
    )


def dataset_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dataset = F.concat(F.lit("Some Org/"), F.col("source"), F.lit(" Set"))
    subset = F.when(F.col("lang") != "en", F.concat(F.lit("Lang "), F.col("lang")))
    split = F.when(F.col("n_chars") > 1000, "train").otherwise("test")
    return docs.select(
        "doc_id", dataset_name(dataset, subset).alias("name"), raw_slug(dataset, subset, split).alias("slug")
    )


def unknown_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages and roles asked for as datasets; only languages exist."""
    entries = table(spark, sf_dir, "documents").select(F.col("lang").alias("name")).distinct()
    roles = table(spark, sf_dir, "conversations").select(F.col("role").alias("name")).distinct()
    return jobs.unknown_names(entries, entries.unionByName(roles))


def select_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two languages picked from the entries the documents make, one per language."""
    listed = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("documents"))
    entries = listed.select(
        F.col("lang").alias("name"), F.lit("org/texts").alias("dataset"), F.col("lang").alias("subset"),
        F.col("documents").alias("max_samples"),
    )
    chosen = jobs.select_datasets(jobs.fill_defaults(entries), ["fr", "en"])
    return chosen.select("name", "raw_dir", "max_samples")


def job_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries with defaults filled in, without those whose language has a finished run."""
    entries = jobs.fill_defaults(_entries(spark, sf_dir), {"tokenizer": "hash"}, {"add_bos": True})
    finished = entries.where(F.col("subset") == "fr").select("name", F.col("raw_dir").alias("path"))
    path = scratch_path(spark, "ledger")
    runs.mark_done(finished, path, jobs.DOWNLOAD)
    todo = jobs.plan(entries, runs.read_ledger(spark, path), jobs.DOWNLOAD)
    return todo.select(
        "name", "dataset", "subset", "split", "text_column", "limit", "mode", "tokenizer", "add_bos", "add_eos", "raw_dir"
    )


QUERIES = {
    f.__name__: f
    for f in (
        read_corpus,
        jsonl_corpus,
        jsonl_line_order,
        ingest_in_order,
        file_order,
        cap_samples,
        max_samples_per_task,
        assign_shards,
        assign_even_shards,
        write_shards,
        ingest_stream,
        unfinished_work,
        union_datasets,
        token_table_roundtrip,
        dataset_stats,
        dataset_names,
        unknown_names,
        select_datasets,
        job_plan,
    )
}

STRING_BYTES_SQL = "octet_length(encode(text)) + octet_length(encode(lang)) + octet_length(encode(source))"

ENTRIES_SQL = """
listed AS (
  SELECT source, lang, count(*) AS documents, min(doc_id) % 3 AS m FROM documents GROUP BY ALL),
entries AS (
  SELECT CASE WHEN m = 0 THEN source || '-' || lang ELSE replace(lower(source || ' Set-' || lang), ' ', '-') END AS name,
         'Some Org/' || source || ' Set' AS dataset, lang AS subset,
         CASE WHEN m = 1 THEN 'test' ELSE 'train' END AS split,
         CASE WHEN m = 2 THEN 'content' ELSE 'text' END AS text_column,
         CASE WHEN documents > 5 THEN 'max=' || (documents - 5) ELSE 'all' END AS "limit",
         CASE WHEN m = 1 THEN 'full' ELSE 'streaming' END AS mode,
         'Some Org__' || source || ' Set__' || lang || '__' || CASE WHEN m = 1 THEN 'test' ELSE 'train' END AS raw_dir
  FROM listed)"""

ORACLES = {
    "read_corpus": "SELECT doc_id, text FROM documents",
    "jsonl_corpus": "SELECT doc_id, lang, text FROM documents",
    "jsonl_line_order": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row, md5(text) AS text_md5 FROM documents",
    "ingest_in_order": f"""
        SELECT doc_id, (sum(strlen(source) + strlen(text)) OVER o - strlen(source) - strlen(text))::BIGINT // {ORDERED_BYTES} AS shard,
               row_number() OVER o - 1 AS position
        FROM documents WINDOW o AS (ORDER BY doc_id ROWS UNBOUNDED PRECEDING)""",
    "file_order": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents",
    "cap_samples": f"""
        SELECT lang AS dataset, doc_id, md5(text) AS text_md5 FROM documents
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= {CAP}""",
    "max_samples_per_task": """
        SELECT source AS task, doc_id FROM documents
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 10""",
    "assign_shards": f"""
        WITH b AS (SELECT lang AS dataset, doc_id, ({STRING_BYTES_SQL})::BIGINT AS bytes FROM documents)
        SELECT dataset, doc_id, bytes,
               ((sum(bytes) OVER (PARTITION BY dataset ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - bytes)::BIGINT
                // {SHARD_BYTES})::BIGINT AS shard
        FROM b""",
    "assign_even_shards": f"""
        WITH b AS (SELECT lang AS dataset, doc_id, ({STRING_BYTES_SQL})::BIGINT AS bytes FROM documents),
        p AS (SELECT dataset, doc_id, row_number() OVER (PARTITION BY dataset ORDER BY doc_id) - 1 AS pos,
                     count(*) OVER (PARTITION BY dataset) AS n,
                     greatest(1, sum(bytes) OVER (PARTITION BY dataset)::BIGINT // {SHARD_BYTES}) AS k
              FROM b),
        bounds AS (SELECT dataset, i, i * (n // k) + least(i, n % k) AS lo,
                          (i + 1) * (n // k) + least(i + 1, n % k) AS hi
                   FROM (SELECT DISTINCT dataset, n, k FROM p), unnest(range(k)) AS u(i))
        SELECT p.dataset, doc_id, i::BIGINT AS shard
        FROM p JOIN bounds ON p.dataset = bounds.dataset AND pos >= lo AND pos < hi""",
    "write_shards": f"""
        WITH b AS (SELECT lang AS dataset, doc_id, octet_length(encode(text))::BIGINT AS bytes FROM documents),
        s AS (SELECT dataset, doc_id, bytes,
                ((sum(bytes) OVER (PARTITION BY dataset ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - bytes)::BIGINT
                 // {SHARD_BYTES})::BIGINT AS shard FROM b)
        SELECT dataset, shard, count(*) AS "rows", sum(bytes)::BIGINT AS bytes,
               min(doc_id) AS first_doc, max(doc_id) AS last_doc
        FROM s GROUP BY ALL""",
    "ingest_stream": "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents",
    "unfinished_work": """
        SELECT source AS name, count(*) AS documents FROM documents
        WHERE source NOT IN (SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
        GROUP BY source""",
    "union_datasets": """
        SELECT 'documents' AS dataset, doc_id AS row_id, md5(text) AS text_md5 FROM documents
        UNION ALL SELECT 'conversations', conv_id, md5(text) FROM conversations
        UNION ALL SELECT 'benchmark', item_id, md5(text) FROM benchmark""",
    "token_table_roundtrip": f"""
        WITH {INDEX_SQL}
        SELECT dataset, seq_id, num_tokens, token_start, token_start * 2 AS byte_pointer, {describe_sql()} FROM idx""",
    "dataset_stats": f"""
        WITH {INDEX_SQL}
        SELECT dataset, count(*) AS num_sequences, count(*) AS num_documents, sum(num_tokens)::BIGINT AS num_tokens,
               max(num_tokens) AS longest_sequence, 2 AS width, 50002::BIGINT AS vocab_size, 'hash' AS tokenizer,
               false AS add_bos, true AS add_eos
        FROM idx GROUP BY dataset""",
    "dataset_names": """
        SELECT doc_id,
               replace(lower(source || ' Set' || CASE WHEN lang <> 'en' THEN '-Lang ' || lang ELSE '' END), ' ', '-') AS name,
               'Some Org__' || source || ' Set__' || CASE WHEN lang <> 'en' THEN 'Lang ' || lang || '__' ELSE '' END
                 || CASE WHEN n_chars > 1000 THEN 'train' ELSE 'test' END AS slug
        FROM documents""",
    "unknown_names": """
        SELECT DISTINCT role AS name FROM conversations WHERE role NOT IN (SELECT lang FROM documents)""",
    "select_datasets": """
        SELECT lang AS name, 'org__texts__' || lang || '__train' AS raw_dir, count(*) AS max_samples
        FROM documents WHERE lang IN ('en', 'fr') GROUP BY lang""",
    "job_plan": f"""
        WITH {ENTRIES_SQL}
        SELECT name, dataset, subset, split, text_column, "limit", mode, 'hash' AS tokenizer, true AS add_bos,
               true AS add_eos, raw_dir
        FROM entries WHERE subset <> 'fr'""",
}
