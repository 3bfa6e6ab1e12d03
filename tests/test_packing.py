import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tokenloom.operators import packing
from tokenloom.operators.index import index_sequences
from tokenloom.operators.ordering import CHUNKS, chunk_by_key

quick = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

SEED = 7
corpora = st.dictionaries(
    st.sampled_from(["a", "b"]), st.lists(st.integers(0, 12), min_size=1, max_size=14), min_size=1
).filter(lambda c: all(any(sizes) for sizes in c.values()))


def make(sizes_by_dataset):
    """Distinct token ids, so that any misplaced token shows."""
    corpus, token = {}, 0
    for dataset, sizes in sizes_by_dataset.items():
        corpus[dataset] = []
        for n in sizes:
            corpus[dataset].append(list(range(token, token + n)))
            token += n
    return corpus


def frame(spark, corpus, width=3):
    rows = [(d, i, s, len(s)) for d, seqs in corpus.items() for i, s in enumerate(seqs)]
    df = spark.createDataFrame(rows, "dataset string, doc bigint, tokens array<int>, num_tokens bigint").repartition(4)
    return index_sequences(chunk_by_key(df, "doc", width, 2), order=["doc"])


def full(corpus):
    return {d: [s for s in seqs if s] for d, seqs in corpus.items()}


def cut(stream, length):
    return [stream[i : i + length] for i in range(0, len(stream) - length + 1, length)]


def got(df, *keys):
    rows = df.collect()
    out = {tuple(r[k] for k in keys): r.tokens for r in rows}
    assert len(out) == len(rows)
    return out


def want_blocks(corpus, length):
    return {
        (d, b): block for d, seqs in corpus.items() for b, block in enumerate(cut(sum(seqs, []), length))
    }


@quick
@given(sizes=corpora, length=st.integers(1, 9), width=st.integers(1, 6))
def test_blocks_are_the_stream_cut_up(spark, sizes, length, width):
    corpus = make(sizes)
    df = frame(spark, corpus, width)
    want = want_blocks(corpus, length)
    assert got(packing.pack_blocks(df, length, local=CHUNKS), "dataset", "block_id") == want
    assert got(packing.pack_blocks(df, length), "dataset", "block_id") == want
    counts = {r.dataset: (r.num_sequences, r.total_tokens, r.num_blocks) for r in packing.block_counts(df, length).collect()}
    assert counts == {
        d: (len(seqs), sum(map(len, seqs)), sum(map(len, seqs)) // length) for d, seqs in full(corpus).items()
    }


@pytest.mark.parametrize("sizes", [[3, 5, 0, 4], [16], [4, 4, 4, 4], [1] * 17, [40, 1, 1]])
def test_block_boundaries(spark, sizes):
    corpus = make({"d": sizes})
    assert got(packing.pack_blocks(frame(spark, corpus), 4, local=CHUNKS), "dataset", "block_id") == want_blocks(corpus, 4)


def test_block_length_must_be_positive(spark):
    with pytest.raises(ValueError, match="positive"):
        packing.pack_blocks(frame(spark, make({"d": [3]})), 0)


def test_get_blocks(spark):
    corpus = make({"a": [3, 9, 2, 30], "b": [9]})
    wanted = [("a", 0), ("a", 5), ("a", 5), ("a", 10), ("b", 1)]
    df = spark.createDataFrame(wanted, "dataset string, block_id bigint")
    found = got(packing.get_blocks(frame(spark, corpus), df, 4), "dataset", "block_id")
    assert found == {k: want_blocks(corpus, 4)[k] for k in set(wanted)}


@pytest.mark.parametrize("bad", [("a", 2), ("a", -1), ("z", 0)])
def test_get_blocks_out_of_range(spark, bad):
    df = spark.createDataFrame([("a", 0), bad], "dataset string, block_id bigint")
    with pytest.raises(Exception, match="block out of range"):
        packing.get_blocks(frame(spark, make({"a": [9]})), df, 4).collect()


def numbering(spark):
    counts = [(0, "a", 3), (1, "b", 0), (2, "a", 3), (3, "c", 2)]
    return packing.block_numbering(spark.createDataFrame(counts, "ds_idx int, dataset string, num_blocks bigint"))


def test_global_numbers(spark):
    assert [r.first_block for r in numbering(spark).orderBy("ds_idx").collect()] == [0, 3, 3, 6]
    ids = spark.range(8).withColumnRenamed("id", "global_id")
    rows = packing.resolve_global_blocks(numbering(spark), ids).orderBy("global_id").collect()
    assert [(r.ds_idx, r.dataset, r.block_id) for r in rows] == [
        (0, "a", 0), (0, "a", 1), (0, "a", 2), (2, "a", 0), (2, "a", 1), (2, "a", 2), (3, "c", 0), (3, "c", 1)
    ]


@pytest.mark.parametrize("bad", [8, -1])
def test_global_number_out_of_range(spark, bad):
    ids = spark.createDataFrame([(bad,)], "global_id bigint")
    with pytest.raises(Exception, match="block out of range"):
        packing.resolve_global_blocks(numbering(spark), ids).collect()


def test_samples_shift_by_one(spark):
    blocks = spark.createDataFrame([([1, 2, 3, 4],)], "tokens array<int>")
    row = packing.to_samples(blocks, 4).first()
    assert (row.input_ids, row.labels) == ([1, 2, 3], [2, 3, 4])


@quick
@given(sizes=corpora, length=st.integers(1, 7), count=st.integers(0, 12), start=st.integers(0, 40))
def test_cyclic_blocks(spark, sizes, length, count, start):
    corpus = make(sizes)
    want = {}
    for d, seqs in full(corpus).items():
        at, stream = start % len(seqs), []
        while len(stream) < count * length:
            stream += seqs[at]
            at = (at + 1) % len(seqs)
        want |= {(d, b): x for b, x in enumerate(cut(stream[: count * length], length))}
    df = frame(spark, corpus)
    assert got(packing.pack_cyclic(df, length, count, start_seq=start), "dataset", "block_id") == want


def order(n, epoch):
    return sorted(range(n), key=lambda i: (hashlib.md5(f"{SEED + epoch}:{i}".encode()).hexdigest(), i))


def worker_stream(seqs, worker, workers, epochs, length, start_epoch=0):
    stride = min(workers, len(seqs))
    stream = []
    for epoch in range(start_epoch, start_epoch + epochs):
        for i in order(len(seqs), epoch)[worker % stride :: stride]:
            stream += seqs[i]
    return cut(stream, length)


@quick
@given(
    sizes=corpora, length=st.integers(1, 9), workers=st.integers(1, 18), epochs=st.integers(1, 3),
    start_epoch=st.integers(0, 2), start_block=st.integers(0, 2),
)
def test_worker_streams(spark, sizes, length, workers, epochs, start_epoch, start_block):
    corpus = make(sizes)
    want = {
        (d, w, b): block
        for d, seqs in full(corpus).items()
        for w in range(workers)
        for b, block in enumerate(worker_stream(seqs, w, workers, epochs, length, start_epoch))
        if b >= start_block
    }
    blocks = packing.pack_worker_streams(
        frame(spark, corpus), length, seed=SEED, workers=workers, epochs=epochs,
        start_epoch=start_epoch, start_block=start_block,
    )
    assert got(blocks, "dataset", "worker", "block_id") == want


def test_every_epoch_shuffles_and_shards_everything_once(spark):
    index = frame(spark, make({"d": [1] * 30})).select("dataset", "seq_id", "num_tokens")
    rows = packing.worker_positions(index, seed=SEED, workers=4, epochs=2).collect()
    by_epoch = {e: sorted((r.rank, r.seq_id) for r in rows if r.epoch == e) for e in (0, 1)}
    for ranked in by_epoch.values():
        assert [r for r, _ in ranked] == list(range(30))
        assert sorted(s for _, s in ranked) == list(range(30))
    assert by_epoch[0] != by_epoch[1]
    assert [s for _, s in by_epoch[1]] == order(30, 1)
    sizes = [sum(r.shard == s and r.epoch == 0 for r in rows) for s in range(4)]
    assert sorted(sizes) == [7, 7, 8, 8]
