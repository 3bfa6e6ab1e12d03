import random

from pyspark.sql import functions as F
from tokenloom.llm import line_dedup, ngram_join


def test_unlike_lines_of_a_list_are_not_paired(spark, monkeypatch):
    rng = random.Random(3)
    lines = []
    for _ in range(150):
        line = [f"w{k}" for k in range(60)]
        for _ in range(5):
            line[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
        lines.append(" ".join(line))
    # the last ones differ from the first in one word
    lines += [line + " z" for line in lines[:5]]
    kept, plain_settle = {}, line_dedup.settle

    def settle(df, name):
        kept[name] = plain_settle(df, name)  # the last table of a name
        return kept[name]

    monkeypatch.setattr(line_dedup, "settle", settle)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    gone = {r.doc_id for r in line_dedup.line_report(docs).where("n_removed > 0").collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (line.split() for line in lines)]
    similar = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    assert gone == {i for i, a in enumerate(sets) if any(similar(a, b) for b in sets[:i])} and len(gone) >= 5
    # what may reach 0.8 by its sketch is little beside what meets in lists
    assert kept["line-classes"].where(F.col("sketch").isNull()).count() == 0
    assert kept["line-pairs"].count() < 0.1 * len(lines) ** 2 / 2


def test_prefixes_are_written_once(spark, monkeypatch):
    written, plain_settle = {}, ngram_join.settle

    def settle(df, name):
        written.setdefault(name, df.columns)
        return plain_settle(df, name)

    monkeypatch.setattr(ngram_join, "settle", settle)
    texts = [" ".join(f"w{k}" for k in range(50)) + f" n{i}" for i in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.component_id for r in ngram_join.ngram_jaccard_classes(docs).collect()} == {0}
    assert "prefix" in written["ngram-sets"] and "prefix" not in written["ngram-classes"]
