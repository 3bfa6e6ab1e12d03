import math
import zlib
from collections import Counter, defaultdict

import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenloom.llm import kneser_ney
from tokenloom.llm.kneser_ney import lm_scores, score_texts

SF_DIR = "/root/testdata/sf0.001"


def discounts(counts):
    n = [sum(c == k for c in counts) for k in range(5)]
    if not all(n[1:]):
        return [0, 0.5, 1.0, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    found = [0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
    return [f if 0 <= f <= k else 0.5 * k for k, f in enumerate(found)]


class Plain:
    """Interpolated modified Kneser-Ney by the book."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [None] * (order + 1)
        tops = Counter(g for t in texts for g in self.grams(t))
        self.raw = Counter(w for t in texts for w in [*plain.blank_words(t), "</s>"])
        self.counts[order] = tops
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.cut = [None, *(discounts(self.counts[n].values()) for n in range(1, order + 1))]
        self.after = [None] * (order + 1)  # tokens after a context, and what is cut off them
        for n in range(1, order + 1):
            self.after[n] = defaultdict(lambda: [0, 0.0])
            for g, c in self.counts[n].items():
                self.after[n][g[:-1]][0] += c
                self.after[n][g[:-1]][1] += self.cut[n][min(c, 3)]

    def grams(self, text):
        tokens = ["<s>"] * (self.order - 1) + [*plain.blank_words(text), "</s>"]
        return [tuple(tokens[i : i + self.order]) for i in range(len(tokens) - self.order + 1)]

    def p(self, gram):
        if not gram:
            return 1 / (len(self.raw) + 1)
        n, lower = len(gram), self.p(gram[1:])
        total, kept = self.after[n].get(gram[:-1], (0, 0))
        if not total:
            return lower
        c = self.counts[n][gram]
        return (max(c - self.cut[n][min(c, 3)], 0) + kept * lower) / total

    def row(self, text):
        total, kinds = sum(self.raw.values()), len(self.raw)
        tokens = [*plain.blank_words(text), "</s>"]
        base = sum(math.log10((self.raw[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
        return len(tokens), sum(self.raw[w] > 0 for w in tokens), total, base, sum(math.log10(self.p(g)) for g in self.grams(text))


def same(got, want):
    assert got[:3] == want[:3]
    assert got[3:] == pytest.approx(want[3:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_equals_the_book(spark, order):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(4)
    rows = docs.select("doc_id", "text").collect()
    model = Plain([r.text for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 != 1], order)
    if order == 2:
        found = lm_scores(docs).collect()
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in found)
    else:
        found = score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % 5 != 1, order=3, block_bytes=50_000, shard_keys=5_000).collect()
    texts = {r.doc_id: r.text for r in rows}
    assert len(found) == len(rows)
    for r in found:
        same((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score), model.row(texts[r.doc_id]))
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


CASES = [(1, "a b a b c", 1), (2, None, 2), (3, "", 3), (None, "A  B", 4), (4, "zz", 5), (5, "q " * 60_000, 6), (4, "a", 7), (4, "a", 7)]
SCHEMA = "doc_id long, text string, score int"


def test_hand_cases(spark):
    docs = spark.createDataFrame(CASES, SCHEMA)
    found = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.score) for r in score_texts(docs, F.col("score") < 5).collect())
    model = Plain([t for _, t, s in CASES if s < 5], 2)
    want = sorted((str(d), *model.row(t)[:2], model.row(t)[4]) for d, t, _ in CASES)
    for g, w in zip(found, want):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3])


def test_nothing_to_learn_or_to_score(spark):
    docs = spark.createDataFrame(CASES, SCHEMA)
    assert {r.score for r in score_texts(docs, F.lit(False)).collect()} == {0.0}
    assert lm_scores(docs.where("false")).collect() == []


def test_contexts_are_looked_up_among_the_ngrams_before(monkeypatch):
    made, joined = [], kneser_ney._Block._joined
    monkeypatch.setattr(kneser_ney._Block, "_joined", staticmethod(lambda parts: made.append(len(parts[0])) or joined(parts)))
    table = pa.table({"id": [1, 2, 3], "teaches": [True, True, False], "text": ["a b a b", "", "b a"]})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    data = sink.getvalue()
    block = kneser_ney._Block(len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True), 3)
    # tokens: a b a b end, end, b a end
    for n in (1, 2):
        of, before = block.gram[n].tolist(), block.context[n].tolist()
        assert before[1:5] == of[:4] and before[7:] == of[6:8]
        assert before[0] == before[5] == before[6] and block.keys[n][before[0]] == joined([kneser_ney._START[None]] * n)[0]
    assert sum(size == 9 for size in made) == 3
