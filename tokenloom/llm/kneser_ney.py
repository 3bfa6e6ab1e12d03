"""An interpolated modified Kneser-Ney model of word n-grams, counted and applied in Spark.

The model is never in one place. N-grams are 64-bit hashes; a shard holds a range of them as
sorted arrays in a file that its task maps into memory. Texts are cut into blocks. At each
order, from the highest down, every block sends its distinct n-grams with what it adds to
their counts to the shards, and gets the totals back by binary search: one exchange counts the
corpus and answers what scoring needs. A block that was the first to bring an n-gram passes it on
to the next lower order, to its context and to its continuation count.

What moves is distinct n-grams per block, compressed; no word, however common, is a key of its own.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.llm import words
from tokenloom.session import scratch_path, settle

#: Bytes of text in a block, at least one text.
BLOCK_BYTES = 8 << 20
#: Distinct n-grams that a shard gets from all blocks, about.
SHARD_KEYS = 2_000_000

_START, _END = words.mix(np.array([0x51, 0xE5D], np.uint64))
#: What a shard sums for an n-gram: its own count, then tokens and kinds of words after it.
_SUMS = ("count", "after", "once", "twice", "more", "raw")


def _squeezed(values: np.ndarray) -> bytes:
    """64-bit values byte plane by byte plane, so that small ones cost little."""
    return pa.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unsqueezed(data: bytes, count: int) -> np.ndarray:
    plain = np.frombuffer(pa.decompress(data, 8 * count, "zstd"), np.uint8)
    return np.ascontiguousarray(plain.reshape(8, count).T).view("<u8").ravel()


class _Block:
    """The tokens of some texts, and their n-grams of every order as indexes of sorted distinct ones."""

    def __init__(self, blob: bytes, order: int):
        table = pa.ipc.open_stream(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd")).read_all()
        self.ids, self.teaches = table.column("id").combine_chunks(), np.array(table.column("teaches").to_numpy(zero_copy_only=False), bool)
        parts, sizes = [], []
        for chunk in words.split(table.column("text").combine_chunks(), words.BLANK_WORDS):
            parts.append(np.insert(chunk.hashes, chunk.first[1:], _END))
            sizes.append(np.diff(chunk.first) + 1)
        self.sizes = np.concatenate(sizes)
        tokens, first = np.concatenate(parts), np.cumsum(self.sizes) - self.sizes
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = np.arange(len(tokens)) - first[self.row]
        before = [tokens]
        for back in range(1, order):
            before.append(np.where(place >= back, np.roll(tokens, back), _START))
        self.keys, self.gram, self.context = {}, {}, {}
        for n in range(1, order + 1):
            gram = self._joined(before[:n])
            # the context of a word is the n-gram that ends before it; that of a first word is all start marks
            start = self._joined([np.array([_START])] * n)
            wanted = np.concatenate((gram, start)) if n < order and len(first) else gram
            self.keys[n], index = np.unique(wanted, return_inverse=True)
            index = index.astype(np.int32)
            self.gram[n] = index[: len(gram)]
            if n < order:
                self.context[n] = np.where(place > 0, np.roll(self.gram[n], 1), index[-1:])

    @staticmethod
    def _joined(parts) -> np.ndarray:
        if len(parts) == 1:
            return parts[0]
        return words.mix(sum(p * words._STEPS[k] for k, p in enumerate(parts)))

    def taught(self, n: int) -> np.ndarray:
        """Occurrences in teaching texts of each distinct n-gram."""
        return np.bincount(self.gram[n][self.teaches[self.row]], minlength=len(self.keys[n])).astype(np.uint64)

    def adds(self, n: int, order: int, answers: dict[int, np.ndarray]) -> dict[str, np.ndarray]:
        """What this block adds to the sums of its n-grams, given the totals of the next higher order."""
        zero = np.zeros(len(self.keys[n]), np.uint64)
        out = dict.fromkeys(_SUMS, zero)
        if n == 1:
            out["raw"] = self.taught(1)
        if n == order:
            out["count"] = self.taught(n)
            return out
        count, own = answers[n + 1]["count"], answers[n + 1]["own"].astype(bool)
        seen = np.zeros(len(self.keys[n + 1]), np.int64)
        seen[self.gram[n + 1]] = np.arange(len(self.row))  # a place of each distinct longer n-gram
        held = np.flatnonzero(own & (count > 0))
        held = held[self.keys[n + 1][held] == self.keys[n + 1][self.gram[n + 1][seen[held]]]]
        count, at = count[held], seen[held]
        add = lambda index, weight: np.bincount(index, weight, len(zero)).astype(np.uint64)
        ones = np.ones(len(at))
        context = self.context[n][at]
        out["count"] = add(self.gram[n][at], ones)
        out["after"] = add(context, count.astype(np.float64))
        for name, kind in (("once", count == 1), ("twice", count == 2), ("more", count > 2)):
            out[name] = add(context, kind.astype(np.float64))
        return out

    def scores(self, order: int, answers, discounts: dict[int, np.ndarray], tokens: int, kinds: int, base_total: int):
        """Per text: tokens, known tokens, base score, model score."""
        total, of = base_total, answers[1]["count"][self.gram[1]]
        cut = discounts[1][np.minimum(of, 3).astype(np.int64)]
        rest = float((discounts[1][1:] * self.lowest[1:]).sum())
        p = (np.maximum(of - cut, 0) + rest / (kinds + 1)) / total if total else np.full(len(of), 1 / (kinds + 1))
        for n in range(2, order + 1):
            of, context = answers[n]["count"][self.gram[n]], answers[n - 1]
            at = self.context[n - 1]
            total = context["after"][at].astype(np.float64)
            kept = sum(discounts[n][k] * context[name][at].astype(np.float64) for k, name in ((1, "once"), (2, "twice"), (3, "more")))
            cut = discounts[n][np.minimum(of, 3).astype(np.int64)]
            with np.errstate(divide="ignore", invalid="ignore"):
                p = np.where(total > 0, (np.maximum(of - cut, 0) + kept * p) / total, p)
        raw = answers[1]["raw"][self.gram[1]].astype(np.float64)
        base = np.log10((raw + 0.5) / (tokens + 0.5 * (kinds + 1)))
        add = lambda values: np.bincount(self.row, values, len(self.sizes))
        return self.sizes, add((raw > 0).astype(np.float64)), add(base), add(np.log10(p))


def _cut(block_bytes: int):
    """Texts of a partition as compressed blocks."""

    def run(batches):
        part, held, size, number = TaskContext.get().partitionId(), [], 0, 0

        def row():
            table = pa.Table.from_batches(held)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            plain = sink.getvalue()
            blob = len(plain).to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)
            tokens = pa.array([plain.size], pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + number], pa.int64()), pa.array([blob], pa.binary()), tokens], ["block", "blob", "size"])

        for batch in batches:
            ends = np.cumsum(np.diff(words.buffers(batch.column(2))[0]))
            start = 0
            while start < batch.num_rows:
                done = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + block_bytes - size, "right")))
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1] - done)
                start = stop
                if size >= block_bytes or start < batch.num_rows:
                    yield row()
                    held, size, number = [], 0, number + 1
        if held:
            yield row()

    return run


def _answers(batch: pa.RecordBatch, i: int, block: _Block, orders) -> dict[int, dict[str, np.ndarray]]:
    out = {}
    for n in orders:
        parts = sorted(batch.column(f"answers_{n}")[i].as_py(), key=lambda part: part["shard"])
        names = (*_SUMS, "own")
        columns = {name: [_unsqueezed(p["sums"][k], p["n"]) for p in parts] for k, name in enumerate(names)}
        out[n] = {name: np.concatenate(c) for name, c in columns.items()}
        assert len(out[n]["own"]) == len(block.keys[n])
    return out


def _ask(n: int, order: int, shards: int):
    """What each block sends to each shard at order ``n``."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch.column("blob")[i].as_py(), order)
                adds = block.adds(n, order, _answers(batch, i, block, [n + 1] if n < order else []))
                keys = block.keys[n]
                borders = np.searchsorted(keys, _borders(shards))
                rows = [(s, lo, hi) for s, (lo, hi) in enumerate(zip(np.r_[0, borders], np.r_[borders, len(keys)])) if hi > lo]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([s for s, _, _ in rows], pa.int64()),
                        pa.array([batch.column("block")[i].as_py()] * len(rows), pa.int64()),
                        pa.array([hi - lo for _, lo, hi in rows], pa.int64()),
                        pa.array([_squeezed(np.diff(keys[lo:hi], prepend=np.uint64(0))) for _, lo, hi in rows], pa.binary()),
                        pa.array([[_squeezed(adds[name][lo:hi]) for name in _SUMS] for _, lo, hi in rows], pa.list_(pa.binary())),
                    ],
                    ["shard", "block", "n", "keys", "sums"],
                )

    return run


def _borders(shards: int) -> np.ndarray:
    """First hash of each shard but the first."""
    return np.array([(k << 64) // shards for k in range(1, shards)], np.uint64)


def _serve(table):
    """One shard: its n-grams as sorted arrays in a mapped file, and the totals each block asked for."""
    table = table.sort_by("block")
    counts = table.column("n").to_pylist()
    keys = [np.cumsum(_unsqueezed(k.as_py(), n), dtype=np.uint64) for k, n in zip(table.column("keys"), counts)]
    every, first, where = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    with tempfile.TemporaryFile() as file:
        every.tofile(file)
        for k in range(len(_SUMS)):
            adds = np.concatenate([_unsqueezed(s[k].as_py(), n) for s, n in zip(table.column("sums"), counts)])
            np.bincount(where, adds, len(every)).astype("<u8").tofile(file)
        del where
        file.flush()
        model = np.memmap(file, "<u8", "r", shape=(1 + len(_SUMS), len(every)))
        own, at, out = np.zeros(sum(counts), np.uint64), 0, []
        own[first] = 1
        for block, asked in zip(table.column("block").to_pylist(), keys):
            place = np.searchsorted(model[0], asked)
            sums = [_squeezed(model[1 + k][place]) for k in range(len(_SUMS))]
            out.append((block, len(asked), [*sums, _squeezed(own[at : at + len(asked)])]))
            at += len(asked)
        count, raw = model[1], model[1 + _SUMS.index("raw")]
        facts = [int((count == k).sum()) for k in (1, 2, 3, 4)] + [int((count > 2).sum()), int(count.sum()), int(raw.sum()), int((raw > 0).sum())]
        del model, count, raw
    shard = table.column("shard")[0].as_py()
    return pa.table(
        [
            pa.array([shard] * (len(out) + 1), pa.int64()),
            pa.array([*(b for b, _, _ in out), None], pa.int64()),
            pa.array([*(n for _, n, _ in out), 0], pa.int64()),
            pa.array([*(s for _, _, s in out), []], pa.list_(pa.binary())),
            pa.array([*([] for _ in out), facts], pa.list_(pa.int64())),
        ],
        names=["shard", "block", "n", "sums", "facts"],
    )


def _discounts(ones: int, twos: int, threes: int, fours: int) -> np.ndarray:
    """The three discounts by counts of counts; where these run out, half a count a step."""
    plain = np.array([0, 0.5, 1.0, 1.5])
    if not (ones and twos and threes and fours):
        return plain
    y = ones / (ones + 2 * twos)
    found = [0, 1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes]
    return np.array([f if 0 <= f <= k else p for k, (f, p) in enumerate(zip(found, plain))])


def score_texts(
    docs: DataFrame, teaches: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
    block_bytes: int = BLOCK_BYTES, shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """One row per text: id, teaches, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the lower-cased words between blanks and one end. The model of ``order`` words is
    learned from the rows where ``teaches`` holds; ``score`` is the log10 probability of a text under
    it, ``base_score`` that of single tokens with half a count added. Start marks fill the context
    of first words. A NULL text is empty and has its end; ids may be NULL or repeat, rows
    are texts of their own. Without teaching rows all probabilities are those of one unknown word.
    """
    if order < 2:
        raise ValueError("order must be at least 2")
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(teaches, F.lit(False)).alias("teaches"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    # written in buckets of the block, so that answers come to the texts and not the other way round
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"blocks_{uuid.uuid4().hex}"
    blocks = texts.mapInArrow(_cut(block_bytes), "block long, blob binary, size long")
    blocks.write.bucketBy(buckets, "block").sortBy("block").option("path", scratch_path(spark, "text-blocks")).saveAsTable(name)
    blocks = spark.table(name)
    size = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(1, int(size) // 8 // shard_keys)

    facts, answers = {}, {}
    for n in range(order, 0, -1):
        have = _with(blocks, {n + 1: answers[n + 1]} if n < order else {})
        asked = have.mapInArrow(_ask(n, order, shards), "shard long, block long, n long, keys binary, sums array<binary>")
        served = asked.groupBy("shard").applyInArrow(_serve, "shard long, block long, n long, sums array<binary>, facts array<long>")
        served = settle(served, f"answers-{n}")
        sums = served.where("block is null").agg(*[F.coalesce(F.sum(F.col("facts")[k]), F.lit(0)) for k in range(8)]).first()
        facts[n], answers[n] = [int(x) for x in sums], served.where("block is not null")

    discounts = {n: _discounts(*f[:4]) for n, f in facts.items()}
    lowest = np.array([0, facts[1][0], facts[1][1], facts[1][4]], np.float64)
    base_total, tokens, kinds = facts[1][5:8]

    def score(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch.column("blob")[i].as_py(), order)
                block.lowest = lowest
                found = _answers(batch, i, block, range(1, order + 1))
                sizes, known, base, model = block.scores(order, found, discounts, tokens, kinds, base_total)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.ids, pa.array(block.teaches), pa.array(sizes.astype(np.int64)), pa.array(known.astype(np.int64)),
                        pa.array(np.full(len(sizes), tokens, np.int64)), pa.array(base), pa.array(model),
                    ],
                    ["id", "teaches", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = "id long, teaches boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = settle(_with(blocks, answers).mapInArrow(score, schema), "lm-scores")
    spark.sql(f"DROP TABLE {name}")
    return out.withColumnRenamed("id", id_col)


def _with(blocks: DataFrame, answers: dict[int, DataFrame]) -> DataFrame:
    out = blocks.select("block", "blob")
    for n, served in answers.items():
        parts = served.groupBy("block").agg(F.collect_list(F.struct("shard", "n", "sums")).alias(f"answers_{n}"))
        out = out.join(parts, "block")
    return out


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """Scores of all texts by a model of those whose crc32 of the id as text is not 1 by five."""
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 1, F.lit(False))
    out = score_texts(docs, ~held, id_col, text_col, order)
    return out.select(id_col, (~F.col("teaches")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
