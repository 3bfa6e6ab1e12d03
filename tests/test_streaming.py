import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tokenloom.functions.tokens import HashTokenizer
from tokenloom.plans.prepare import index_corpus
from tokenloom.operators.packing import pack_blocks
from tokenloom.sources.corpus import with_file_order
from tokenloom.streaming import ingest, pack

SCHEMA = "doc_id bigint, dataset string, text string"
LEN = 16


def arrivals(spark, lo, hi):
    rows = [(i, "ab"[i % 3 == 0], " ".join(f"w{i}_{j}" for j in range(i % 11))) for i in range(lo, hi)]
    return spark.createDataFrame(rows, SCHEMA)


def schema(spark):
    return arrivals(spark, 0, 1).schema


def test_ingest_resumes_after_a_stop(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run():
        stream = ingest.read_stream(spark, source, schema(spark), max_files=1)
        ingest.ingest_stream(stream, target, checkpoint, ["dataset"]).awaitTermination()
        return sorted(r.doc_id for r in spark.read.parquet(target).collect())

    arrivals(spark, 0, 30).repartition(3).write.parquet(source)
    assert run() == list(range(30))
    assert run() == list(range(30))
    arrivals(spark, 30, 50).write.mode("append").parquet(source)
    assert run() == list(range(50))


def test_ordered_ingest_goes_on_where_it_stopped(spark, tmp_path):
    """Deliveries of several files: one order, shards of their size across micro-batches, a cap over all of them."""
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")

    def run(source, cap):
        stream = ingest.read_stream(spark, source, schema(spark))
        ingest.ingest_in_order(stream, target, checkpoint, columns=["doc_id", "text"], max_samples=cap, target_bytes=200).awaitTermination()
        rows = with_file_order(spark.read.parquet(target)).orderBy("file", "row").collect()
        return [(r.doc_id, r.shard) for r in rows]

    source, want, size = str(tmp_path / "in"), [], 0
    texts = {r.doc_id: len(r.text) for r in arrivals(spark, 0, 60).collect()}
    for i in range(50):
        want.append((i, size // 200))
        size += texts[i]
    for lo, hi in ((0, 25), (25, 30), (30, 60)):
        arrivals(spark, lo, hi).repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").write.mode("append").parquet(source)
        got = run(source, 50)
        assert got == want[:hi]
    # as after a crash between the shards and the commit: the last delivery is taken in once more
    last = max(int(p.name) for p in (tmp_path / "check" / "commits").iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (tmp_path / "check" / "commits" / name).unlink()
    assert run(source, 50) == want


def test_jsonl_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.jsonl").write_text('{"doc_id": 1, "dataset": "a", "text": "one two"}\n')
    stream = ingest.read_stream(spark, str(tmp_path / "in"), schema(spark), kind="json", pattern="*.jsonl")
    rows = ingest.tokenize_stream(stream, HashTokenizer())
    ingest.ingest_stream(rows, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).first().num_tokens == 3


def batch_blocks(spark, n):
    tokens = index_corpus(arrivals(spark, 0, n), key="doc_id", keys_per_chunk=8)
    return {(r.dataset, r.block_id): r.tokens for r in pack_blocks(tokens, LEN).collect()}


def stream_blocks(spark, paths):
    rows = pack.read_packed(spark, paths["target"]).collect()
    assert len({(r.dataset, r.block_id) for r in rows}) == len(rows)
    return {(r.dataset, r.block_id): r.tokens for r in rows}


def run_pack(spark, source, paths, **options):
    stream = ingest.tokenize_stream(ingest.read_stream(spark, source, schema(spark), max_files=1), HashTokenizer())
    query = pack.pack_stream(stream, LEN, key="doc_id", **paths, **options)
    query.awaitTermination()
    return query


def states(spark, paths):
    rows = spark.read.format("statestore").load(paths["checkpoint"]).select("key.*", "value.*").collect()
    return {r["dataset"]: r["groupState"] for r in rows}


def test_packing_a_stream_equals_packing_the_table(spark, tmp_path):
    """One file to a micro-batch, and a restart after some; the state holds a tail per dataset."""
    source = str(tmp_path / "in")
    paths = {n: str(tmp_path / n) for n in ("target", "checkpoint")}
    for step, (lo, hi) in enumerate([(0, 40), (40, 41), (41, 80), (80, 83), (83, 90)]):
        arrivals(spark, lo, hi).coalesce(1).write.mode("append").parquet(source)
        if step in (1, 3, 4):
            run_pack(spark, source, paths)
    assert stream_blocks(spark, paths) == batch_blocks(spark, 90)
    want = arrivals(spark, 0, 90).groupBy("dataset").agg(F.sum(HashTokenizer().count(F.col("text"))).alias("n"))
    want = {r.dataset: r.n for r in want.collect()}
    held = states(spark, paths)
    assert {d: s.total_tokens for d, s in held.items()} == want
    assert {d: len(s.tail) for d, s in held.items()} == {d: n % LEN for d, n in want.items()}


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    source = str(tmp_path / "in")
    paths = {n: str(tmp_path / n) for n in ("target", "checkpoint")}
    arrivals(spark, 0, 40).coalesce(1).write.parquet(source)
    run_pack(spark, source, paths)
    arrivals(spark, 40, 70).coalesce(1).write.mode("append").parquet(source)
    run_pack(spark, source, paths)
    # As after a crash between the output and the commit of the last batch: the commit is lost.
    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    run_pack(spark, source, paths)
    assert stream_blocks(spark, paths) == batch_blocks(spark, 70)
    arrivals(spark, 70, 90).coalesce(1).write.mode("append").parquet(source)
    run_pack(spark, source, paths)
    assert stream_blocks(spark, paths) == batch_blocks(spark, 90)


def test_lanes_are_streams_of_their_own(spark, tmp_path):
    source = str(tmp_path / "in")
    paths = {n: str(tmp_path / n) for n in ("target", "checkpoint")}
    arrivals(spark, 0, 90).coalesce(1).write.parquet(source)
    run_pack(spark, source, paths, lanes=3)
    rows = arrivals(spark, 0, 90).select("dataset", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("lane"), "doc_id", HashTokenizer().ids(F.col("text")).alias("tokens"))
    lanes = {}
    for r in rows.orderBy("doc_id").collect():
        lanes.setdefault((r.dataset, r.lane), []).extend(r.tokens)
    want = {(*k, i): t[i * LEN : (i + 1) * LEN] for k, t in lanes.items() for i in range(len(t) // LEN)}
    got = {(r.dataset, r.lane, r.block_id): r.tokens for r in pack.read_packed(spark, paths["target"]).collect()}
    assert got == want


class Held:
    """A group's state, as Spark hands it to the function."""

    def __init__(self, *value):
        self.exists, self.get = bool(value), value

    def update(self, value):
        self.get = value


def test_a_task_does_not_hold_its_micro_batch():
    """Tokens of many Arrow batches, keys in no order: whole blocks in key order, in a fraction of their memory."""
    batches, rows, size, block_len = 40, 500, 500, 64
    keys = np.random.default_rng(5).permutation(batches * rows)

    def arriving():
        for part in keys.reshape(batches, rows):
            yield pd.DataFrame({"key": part, "tokens": [np.full(size, k, np.int32) for k in part]})

    state, at, wrong = Held(13, [7] * 13), 0, 0
    tracemalloc.start()
    for out in pack._continue_stream(block_len)(("a", 0), arriving(), state):
        ids = np.concatenate(out["tokens"].to_list())
        assert out["block_id"].tolist() == list(range(at // block_len, (at + len(ids)) // block_len))
        place = np.arange(at, at + len(ids)) - 13
        wrong += int((ids != np.where(place < 0, 7, place // size)).sum())
        at += len(ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    total = 13 + batches * rows * size
    assert not wrong and at == total // block_len * block_len
    assert state.get == (total, [len(keys) - 1] * (total % block_len))
    assert peak < total * 4 / 4


def test_a_packing_stream_bounds_its_arrow_batches(spark, tmp_path, monkeypatch):
    """The setting holds for the stream alone."""
    name, usual = pack._BATCH_ROWS[0], spark.conf.get(pack._BATCH_ROWS[0])
    source, sizes = str(tmp_path / "in"), str(tmp_path / "sizes")

    def sizes_only(block_len):
        def run(group, batches, state):
            for batch in batches:
                with open(sizes, "a") as out:
                    out.write(f"{len(batch)}\n")
                yield batch.head(0)[[]]

        return run

    monkeypatch.setattr(pack, "_continue_stream", sizes_only)
    arrivals(spark, 0, 2000).coalesce(1).write.parquet(source)
    run_pack(spark, source, {n: str(tmp_path / n) for n in ("target", "checkpoint")})
    with open(sizes) as lines:
        sizes = [int(n) for n in lines]
    assert max(sizes) <= 512 and sum(sizes) == 2000
    assert spark.conf.get(name) == usual
