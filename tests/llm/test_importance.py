import hashlib
import math
import random
import zlib
from collections import Counter

import plain
import pytest

from tokenloom.llm.importance import chunk_features, drawn_documents, importance, resample, resampling_report

SF_DIR = "/root/testdata/sf0.001"
DOCS, TARGET = "doc_id long, text string, source string", "item_id long, text string"


def features(text, run=3):
    w = plain.plain_words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in range(1, run + 1) for i in range(len(w) - n + 1)]


def want(docs, target, percent=5, min_words=20):
    s, t = (Counter(b for x in texts for b in features(x)) for texts in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in features(text))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(features(text)), weight, score, len(plain.plain_words(text)) >= min_words))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = {}
    for place, r in enumerate(order[: percent * len(order) // 100]):
        ranks.setdefault(r[:4], []).append(place + 1)
    return sorted(((*r[:4], ranks[r[:4]].pop(0) if r[4] and ranks.get(r[:4]) else None) for r in rows), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


def test_equals_plain_version(spark):
    docs, target = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "benchmark"))
    plain_rows = [(r.doc_id, r.text) for r in docs.collect()]
    result = resampling_report(docs, target)
    assert got(result) == want(plain_rows, [r.text for r in target.collect()])
    drawn = drawn_documents(docs, resample(docs, target))
    assert drawn.columns == docs.columns and 0 < drawn.count() < docs.count() / 10


LETTERS = "a B é Ünd x1 - , \n \t . Straße z".split(" ")


def odd_rows():
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(LETTERS) for _ in range(rng.randrange(60)))) for i in range(150)]
    rows += [(None, "w " * 30), (None, "w " * 30), (200, None), (201, ""), (202, " .,\n"), (203, "y" * 200 + " tail " + "z" * 90 + " end"), (204, "long word " * 60_000)]
    return rows + rows[:20] + [(7, "again " * 40)]


@pytest.mark.parametrize("percent", [0, 20, 100])
def test_odd_texts_ties_and_repeats(spark, percent):
    rows = odd_rows()
    target = ["é ünd x1", None, "", "w w w", "z" * 90]
    docs = spark.createDataFrame([(*r, "s") for r in rows], DOCS).selectExpr("*", "1 as rank", "'a' as id__", "2 as weight", "3 as chunk").repartition(4)
    items = spark.createDataFrame(list(enumerate(target)), TARGET)
    assert got(resample(docs, items, percent=percent)) == want(rows, target, percent)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], TARGET)
    assert resample(docs, items).count() == 0
    full = spark.createDataFrame([(1, "one two", "s")], DOCS)
    assert got(resample(full, items)) == want([(1, "one two")], [])
    assert importance(docs, spark.createDataFrame([(1, "x")], TARGET)).count() == 0


def test_runs_stay_in_their_text():
    """The buckets of joined texts are those of each text alone, whatever stands at their ends."""
    texts = [t.encode() for t in ("a b", "", "c", "d e f g", "!", "h" * 70 + " i", "j " + "k" * 64)]
    first, found = chunk_features(texts)
    assert [b - a for a, b in zip(first[:-1], first[1:])] == [2, 0, 1, 4, 0, 2, 2]
    for i, text in enumerate(texts):
        mine = [b for bucket in found for b in bucket[first[i] : first[i + 1]].tolist() if b >= 0]
        assert mine == features(text.decode())
