import random

import plain
from tokenloom.llm.ngram_join import ngram_jaccard_classes

SF_DIR = "/root/testdata/sf0.001"


def brute(rows, size=4, percent=85):
    """All pairs of different sets that share an item."""
    sets = [plain.shingles(t, size) for _, t, *_ in rows]
    first, where, links = {}, {}, []
    for i, s in enumerate(sets):
        if s:
            links.append((first.setdefault(s, i), i))
    for s, i in first.items():
        for j in {j for item in s for j in where.get(item, ())}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                links.append((i, j))
        for item in s:
            where.setdefault(item, []).append(i)
    low, best = plain.components(range(len(rows)), links), {}
    for i, root in low.items():
        if rows[i][0] is not None:
            best[root] = min(best.get(root, rows[i][0]), rows[i][0])
    return sorted((str(r[0]), len(s), str(best.get(low[i]) if s else r[0])) for i, (r, s) in enumerate(zip(rows, sets)))


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def altered(words, changes, rng):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**9)}"
    return " ".join(words)


SCHEMA = "doc_id long, text string, n_shingles string, component_id int, cls string"


def test_groups_of_near_copies(spark):
    rng = random.Random(3)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    for k in range(3):
        base = [f"w{rng.randrange(300)}" for _ in range(90)]
        docs += [(1000 * (k + 1) + i, altered(base, rng.choice([0, 1, 1, 2, 3, 6]), rng)) for i in range(60)]
        docs += [(1000 * (k + 1) + 100 + i, " ".join(base[: 70 + i])) for i in range(20)]
    docs += [(None, altered("w1 w2 w3 w4 w5 w6".split() * 9 + [f"v{i}" for i in range(60)], 1, rng)) for _ in range(9)]
    chain = [f"c{i}" for i in range(400)]
    docs += [(9000 - i, " ".join(chain[i * 4 : i * 4 + 90])) for i in range(40)]
    rng.shuffle(docs)
    df = spark.createDataFrame([(*d, "x", 1, "y") for d in docs], SCHEMA).repartition(5)
    want = brute(docs)
    assert len({w[2] for w in want}) < len(docs) - 100
    assert got(ngram_jaccard_classes(df)) == want


CASES = [
    (5, "a b c d e"), (3, "A b\tc  D\ne"), (7, "a b c d"), (1, None), (2, ""), (4, " \n\t"), (8, "a b"), (9, "a  B"), (10, "a b c"),
    (11, "é b"), (12, "É b"), (None, "x y z w v"), (6, "x y z w v"), (None, None), (None, "only here in this row"), (13, "t " * 80_000),
    (13, "t t t t t"), (14, "t t t t"), (14, "another text with the same id"), (14, "a b c d e"), (15, "w" * 500_000),
]


def test_hand_cases(spark):
    df = spark.createDataFrame([(*c, "x", 1, "y") for c in CASES], SCHEMA)
    assert got(ngram_jaccard_classes(df)) == brute(CASES)
    assert ngram_jaccard_classes(df.where("false")).collect() == []
