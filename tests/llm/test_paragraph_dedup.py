import random

import plain
from tokenloom.llm import paragraph_dedup
from tokenloom.llm.paragraph_dedup import repeated_passages

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, kind int, component string"


def paragraphs(rows):
    """(doc, first word, words, shingles) of every paragraph with words."""
    for doc, text, *_ in rows:
        at = 0
        for line in (text or "").split("\n"):
            w = plain.blank_words(line)
            if w:
                yield doc, at, len(w), plain.shingles(line, 5)
            at += len(w)


def brute(rows):
    units = list(paragraphs(rows))
    links = [
        (i, j) for i, a in enumerate(units) for j in range(i)
        if 100 * len(a[3] & units[j][3]) >= 80 * len(a[3] | units[j][3])
    ]
    low = plain.components(range(len(units)), links)
    groups = {}
    for i, unit in enumerate(units):
        groups.setdefault(low[i], []).append((unit[0] is None, unit[0] or 0, unit[1], unit))
    out = []
    for group in groups.values():
        if len(group) > 1:
            lead = min(g[:3] for g in group)
            out += [(str(u[0]), u[1], u[2], "None" if lead[0] else str(lead[1]), key != lead) for *key, u in ((*g[:3], g[3]) for g in group) for key in [tuple(key)]]
    return sorted(out)


def got(df, kind="paragraph"):
    return sorted((str(r.doc_id), r.first_word, r.n_words, str(r.component_id), r.removed) for r in df.collect() if r.kind == kind)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "c") for r in rows], SCHEMA).repartition(4)


def test_paragraphs(spark):
    rng = random.Random(8)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40).collect()]
    base = [f"w{k}" for k in range(80)]
    for doc in range(60):
        lines = []
        for _ in range(2):
            line = list(base[rng.randrange(3) :])
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                line[rng.randrange(len(line))] = f"n{rng.randrange(10**6)}"
            lines.append(" ".join(line))
        rows.append((1000 + doc, "\n".join(lines)))
    want, found = brute(rows), got(repeated_passages(table(spark, rows)))
    assert len(want) > 90
    assert len(set(want) & set(found)) >= 0.99 * len(want) and len(found) <= len(want)


def test_passages_inside_other_text(spark):
    rng = random.Random(9)
    word = lambda: f"v{rng.randrange(10**6)}"
    rows, planted = [], {}
    for k in range(100):
        passage = [word() for _ in range(55)]
        for copy in range(2):
            lead = rng.randrange(5, 60)
            rows.append((2 * k + copy, " ".join([*(word() for _ in range(lead)), *passage, *(word() for _ in range(40))])))
            planted[2 * k + copy] = lead
    found = [r for r in repeated_passages(table(spark, rows)).collect() if r.kind == "piece"]
    caught = {r.doc_id for r in found}
    assert len(caught) >= 190
    assert all(planted[r.doc_id] <= r.first_word <= planted[r.doc_id] + 55 - r.n_words for r in found)
    assert all(r.removed == (r.doc_id % 2 == 1) and r.component_id == r.doc_id // 2 * 2 for r in found)


CASES = [
    (1, None), (2, ""), (3, "a b c\n\n A  B C\nd e"), (None, "d e"), (4, "d e"), (5, "x" * 200_000), (6, "x" * 200_000 + "\ny"), (7, "\n \n"),
    (8, "same row twice here now"), (8, "same row twice here now"), (9, "q " * 30_000),
]


def test_hand_cases(spark):
    found = repeated_passages(table(spark, CASES))
    assert got(found) == brute(CASES)
    assert repeated_passages(table(spark, CASES).where("false")).collect() == []


def test_unlike_paragraphs_that_collide_are_not_all_verified(spark, monkeypatch):
    rng = random.Random(12)
    rows = []
    for doc in range(240):
        line = [f"w{k}" for k in range(80)]
        for _ in range(min(doc, 1) if doc < 60 else 6):
            line[rng.randrange(80)] = f"n{rng.randrange(10**6)}"
        rows.append((doc, " ".join(line)))
    pairs, plain_settle = [], paragraph_dedup.settle

    def settle(df, name):
        out = plain_settle(df, name)
        if name == "paragraph-pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(paragraph_dedup, "settle", settle)
    want, found = brute(rows), got(repeated_passages(table(spark, rows)))
    assert len(want) > 50 and set(found) <= set(want) and len(found) >= 0.99 * len(want)
    assert sum(pairs) < 5 * len(rows)
