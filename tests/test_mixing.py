import hashlib

import pytest
from pyspark.sql import functions as F

from test_packing import SEED, cut, frame, make, order
from tokenloom.operators import mixing
from tokenloom.operators.packing import block_counts
from tokenloom.plans import mix as plans
from tokenloom.schemas import MIX

ENTRIES = [(0, "a", 0.5, None), (1, "b", 0.3, None), (2, "a", 0.15, "again"), (3, "c", None, None)]


def mix(spark, entries=ENTRIES):
    return mixing.normalize_weights(spark.createDataFrame(entries, MIX))


def shares(entries=ENTRIES):
    weights = [1.0 if w is None else w for _, _, w, _ in entries]
    return [w / sum(weights) for w in weights]


def draw(worker, step):
    u = int(hashlib.md5(f"{SEED + worker}:{step}".encode()).hexdigest()[:13], 16) / 2**52
    total = 0.0
    for i, share in enumerate(shares()):
        total += share
        if u < total:
            return i
    return len(ENTRIES) - 1


def schedule(spark, draws, workers):
    return mixing.mix_schedule(spark, mix(spark), draws=draws, workers=workers, seed=SEED)


def test_weights_are_normalized(spark):
    got = [r.share for r in mix(spark).orderBy("ds_idx").collect()]
    assert got == pytest.approx(shares())


@pytest.mark.parametrize("weight", [0.0, -1.0])
def test_non_positive_weight(spark, weight):
    with pytest.raises(Exception, match="non-positive weight in mix entry 1"):
        mix(spark, [(0, "a", 1.0, None), (1, "b", weight, None)]).collect()


def test_schedule_follows_the_draws_and_nears_the_weights(spark):
    rows = schedule(spark, 500, 4).collect()
    assert len(rows) == 2000 and len({(r.worker, r.step) for r in rows}) == 2000
    assert all(r.ds_idx == draw(r.worker, r.step) and r.dataset == ENTRIES[r.ds_idx][1] for r in rows)
    for i, share in enumerate(shares()):
        assert abs(sum(r.ds_idx == i for r in rows) / 2000 - share) < 0.05


def test_draw_numbers_count_per_worker_and_entry(spark):
    for r in mixing.number_draws(schedule(spark, 60, 3), steps_per_chunk=7).collect():
        assert r.block_no == sum(draw(r.worker, s) == r.ds_idx for s in range(r.step))


CORPUS = {"a": [5, 1, 9, 4, 4, 7, 0, 3], "b": [2, 6], "c": [3] * 5}


def feed(spark, workers, draws, length, **settings):
    tokens = frame(spark, make(CORPUS))
    return plans.training_feed(
        mix(spark), tokens, length, draws=draws, workers=workers, seed=SEED, **settings
    )


def imitate(workers, draws, length):
    """The endless iterators, walked one block at a time."""
    corpus = {d: [s for s in seqs if s] for d, seqs in make(CORPUS).items()}

    def stream(seqs, worker):
        stride, buffer, epoch = min(workers, len(seqs)), [], 0
        while True:
            for i in order(len(seqs), epoch)[worker % stride :: stride]:
                buffer += seqs[i]
                while len(buffer) >= length:
                    yield buffer[:length]
                    buffer = buffer[length:]
            epoch += 1

    out = {}
    for worker in range(workers):
        streams = [stream(corpus[d], worker) for _, d, _, _ in ENTRIES]
        for step in range(draws):
            out[(worker, step)] = next(streams[draw(worker, step)])
    return out


@pytest.mark.parametrize("workers, length", [(1, 4), (3, 3), (7, 5)])
def test_feed_equals_the_iterators(spark, workers, length):
    want = imitate(workers, 40, length)
    rows = feed(spark, workers, 40, length).collect()
    assert {(r.worker, r.step): (r.input_ids, r.labels) for r in rows} == {
        k: (b[:-1], b[1:]) for k, b in want.items()
    }


def test_a_short_shard_gets_more_epochs(spark):
    """One long and many tiny sequences: the average says one epoch, most shards need many."""
    corpus = make({"d": [400] + [1] * 15})
    tokens = frame(spark, corpus)
    entries = mix(spark, [(0, "d", 1.0, None)])
    rows = plans.training_feed(entries, tokens, 7, draws=9, workers=8, seed=SEED).collect()
    seqs, want = corpus["d"], {}
    for worker in range(8):
        stream, epoch = [], 0
        while len(stream) < 9 * 7:
            for i in order(16, epoch)[worker::8]:
                stream += seqs[i]
            epoch += 1
        want |= {(worker, step): b[:-1] for step, b in enumerate(cut(stream, 7)[:9])}
    assert {(r.worker, r.step): r.input_ids for r in rows} == want


def test_skipping_is_the_tail_of_the_full_schedule(spark):
    full = {(r.worker, r.step): r.input_ids for r in feed(spark, 3, 30, 4).collect()}
    tail = {(r.worker, r.step): r.input_ids for r in feed(spark, 3, 30, 4, skip=17).collect()}
    assert tail == {k: v for k, v in full.items() if k[1] >= 17}


def test_batches_drop_the_partial_last_one(spark):
    rows = feed(spark, 2, 23, 4, skip=3, batch_size=6).collect()
    assert len(rows) == 2 * 18
    assert all((r.batch, r.slot) == ((r.step - 3) // 6, (r.step - 3) % 6) for r in rows)


def test_a_dataset_without_tokens_is_an_error(spark):
    entries = [(0, "a", 1.0, None), (1, "nowhere", 1.0, None)]
    tokens = frame(spark, make(CORPUS))
    with pytest.raises(Exception, match="no tokens in mix dataset nowhere"):
        plans.training_feed(mix(spark, entries), tokens, 4, draws=30, workers=2, seed=SEED).collect()
    with pytest.raises(Exception, match="no tokens in mix dataset nowhere"):
        plans.validate_mix(mix(spark, entries), tokens, 4).collect()


def test_report(spark):
    report = plans.validate_mix(mix(spark), frame(spark, make(CORPUS)), 5).collect()
    rows = {r.ds_idx: r for r in report}
    assert (rows[0].num_sequences, rows[0].num_tokens, rows[0].num_blocks) == (7, 33, 6)
    assert rows[2].num_tokens == 33 and rows[2].dataset == "a"
    total = rows[None]
    assert (total.dataset, total.num_sequences, total.num_tokens, total.num_blocks) == ("TOTAL", 21, 89, 16)
    assert total.share == pytest.approx(1.0)


def test_map_samples_number_every_entry(spark):
    entries = [(0, "b", 1.0, None), (1, "c", 5.0, None), (2, "b", 1.0, None)]
    corpus = make(CORPUS)
    rows = plans.map_samples(mix(spark, entries), frame(spark, corpus), 4).orderBy("global_id").collect()
    blocks = [b for d in "bcb" for b in cut(sum(corpus[d], []), 4)]
    assert [r.global_id for r in rows] == list(range(len(blocks)))
    assert [r.input_ids for r in rows] == [b[:-1] for b in blocks]


def test_ledger_runs_up(spark):
    batches = spark.createDataFrame([(w, b) for w in range(2) for b in range(5) for _ in range(3)], "worker int, batch bigint")
    rows = mixing.token_ledger(batches, accumulation=2, tokens=F.lit(10)).orderBy("train_step").collect()
    assert [(r.effective_batch, r.step_tokens, r.tokens_seen) for r in rows] == [(12, 120, 120), (12, 120, 240), (6, 60, 300)]


def test_worker_share_splits_a_rank_total(spark):
    for samples in (0, 4, 8, 20, 24):
        got = [
            r.n for r in spark.range(3).select(mixing.worker_share(samples, 4, F.col("id"), 3).alias("n")).collect()
        ]
        dealt = [sum(b % 3 == w for b in range(samples // 4)) * 4 for w in range(3)]
        assert got == dealt


def test_mix_settings(tmp_path):
    path = tmp_path / "mix.yaml"
    path.write_text(
        "seq_len: 16\ndatasets:\n  - {path: data/tokens/a/a, weight: 0.3, name: first}\n  - {path: data/tokens/b/b}\n"
    )
    mix = plans.Mix.from_yaml(str(path))
    assert (mix.block_len, mix.seed, mix.entries[1]) == (17, 42, ("data/tokens/b/b", 1.0, None))
    for broken in ("datasets: []\n", "datasets:\n  - {weight: 1}\n", "datasets:\n  - {path: a, weight: 0}\n", "- 1\n"):
        path.write_text(broken)
        with pytest.raises(ValueError):
            plans.Mix.from_yaml(str(path))


def test_mix_frame(spark):
    mix = plans.Mix((("x/a", 1.0, None), ("x/b/", 3.0, "named")), 8, 1)
    assert [(r.ds_idx, r.dataset, r.share) for r in mix.frame(spark).orderBy("ds_idx").collect()] == [
        (0, "a", 0.25), (1, "b", 0.75)
    ]


def test_block_counts_feed_the_report(spark):
    counts = block_counts(frame(spark, make(CORPUS)), 5)
    assert {r.dataset: r.num_blocks for r in counts.collect()} == {"a": 6, "b": 1, "c": 3}


def test_paths_that_share_a_dataset_name(spark):
    with pytest.raises(ValueError, match="same dataset"):
        plans.Mix((("x/a", 1.0, None), ("y/a", 1.0, None)), 8, 1).frame(spark)


def test_resume_by_a_ranks_total(spark):
    """What two workers had supplied together and what the resumed feed supplies make the full feed."""
    tokens = frame(spark, make(CORPUS))
    mix = mixing.normalize_weights(spark.createDataFrame([(0, "a", 1.0, None), (1, "b", 2.0, None)], plans.MIX))
    feed = lambda **more: {
        (r.worker, r.step): tuple(r.labels) for r in plans.training_feed(mix, tokens, 5, draws=8, workers=2, seed=3, **more).collect()
    }
    full = feed(batch_size=2)
    resumed = feed(batch_size=2, samples_done=6)
    seen = {(0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (1, 1)}
    assert len(full) == 16 and set(resumed) == set(full) - seen
    assert all(full[k] == resumed[k] for k in resumed)


def test_resume_with_two_ranks(spark):
    """Ranks of two workers each: a rank's share is dealt over its own workers, in their turns."""
    tokens = frame(spark, make(CORPUS))
    mix = mixing.normalize_weights(spark.createDataFrame([(0, "a", 1.0, None), (1, "b", 2.0, None)], plans.MIX))
    feed = lambda **more: {
        (r.worker, r.step): tuple(r.labels) for r in plans.training_feed(mix, tokens, 5, draws=8, workers=4, seed=3, batch_size=2, **more).collect()
    }
    full, resumed = feed(), feed(samples_done=6, num_workers=2)
    seen = {(w, s) for w, batches in ((0, 2), (1, 1), (2, 2), (3, 1)) for s in range(2 * batches)}
    assert len(full) == 32 and set(resumed) == set(full) - seen
    assert all(full[k] == resumed[k] for k in resumed)
    with pytest.raises(ValueError, match="no whole number of ranks"):
        feed(samples_done=6, num_workers=3)
