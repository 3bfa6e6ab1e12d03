import math

import numpy as np
import plain
from pyspark.sql import functions as F
from tokenloom.llm import embedding_join
from tokenloom.llm.embedding_join import embedding_classes

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, cosine=0.93):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float64) / np.abs(v).max()
        return v / np.sqrt((v * v).sum())

    units, links = [unit(r[1]) for r in rows], []
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if None in (a[2], b[2]) or a[2] != b[2] or units[i] is None or units[j] is None or len(units[i]) != len(units[j]):
                continue
            if units[i] @ units[j] >= cosine:
                links.append((i, j))
    low = plain.components(range(len(rows)), links)
    group = {}
    for i, root in low.items():
        if rows[i][0] is not None:
            group[root] = min(group.get(root, rows[i][0]), rows[i][0])
    counts = np.bincount([k for link in links for k in link], minlength=len(rows))
    return sorted(
        (str(r[0]), int(counts[i]), str(group.get(low[i])), r[0] is not None and r[0] == group.get(low[i])) for i, r in enumerate(rows)
    )


def got(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in df.collect())


def test_equals_all_pairs_on_many_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "BLOCK", 32)
    monkeypatch.setattr(embedding_join, "LEAF", 8)
    rng = np.random.default_rng(5)
    base = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").limit(200).collect()]
    rows = list(base)
    for k in range(160):  # chains and clusters round a few vectors, some of them equal
        near = np.array(base[k % 5][1], np.float64)
        noise = rng.normal(size=64) * np.linalg.norm(near) / 8 * rng.choice([0, 0.1, 0.3, 0.37])
        rows.append((1000 + k, [float(np.float32(x)) for x in near * rng.choice([1, 1, 2.5]) + noise], base[k % 5][2]))
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(5)
    want = brute(rows)
    assert max(w[1] for w in want) > 10 and got(embedding_classes(df)) == want


CASES = [
    (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1),
    (7, [], 1), (8, [0.0, 0.0], 1), (9, [None, 1.0], 1), (10, [float("nan"), 1.0], 1), (11, [float("inf"), 1.0], 1),
    (None, [0.0, 1.0], 1), (None, [0.0, 3.0], 1), (12, [-0.0, 1.0], 1), (13, [1.0, 0.0, 0.0], 1), (14, [1e-30, 0.0], 1), (15, [1.0, 0.39], 1),
    (16, [-1.0, 0.0], 1), (None, [9.0, 9.0], 7),
]


def test_hand_cases(spark):
    df = spark.createDataFrame([(*r, "x") for r in CASES], SCHEMA)
    assert got(embedding_classes(df)) == brute(CASES)


def test_empty_table(spark):
    df = spark.createDataFrame([(*r, "x") for r in CASES], SCHEMA).where(F.lit(False))
    assert embedding_classes(df).collect() == []
