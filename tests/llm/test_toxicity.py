import random
import zlib

import numpy as np
import plain
import pyarrow as pa
from tokenloom.llm import words
from tokenloom.llm.lexicon import Lexicon, Term, reach
from tokenloom.llm.toxicity import drop_toxic, toxicity_scores

INSULTS = "worthless pathetic idiot grumblefool".split()


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_lexicon_equals_plain_distances():
    rng = random.Random(6)
    terms = [Term("abcdef", False, 1.0), Term("abcabcabcabc", False, 1.0), Term("fedcba", True, 1.0), Term("bead", True, 1.0), Term("ace", False, 1.0)]
    tried = {"".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 15))) for _ in range(2000)}
    for term in terms:
        for _ in range(150):
            w = list(term.text + "abc" * (term.stem and rng.random() < 0.5))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randrange(2)] = rng.choice(["", "a", "f", "cd"])
            tried.add("".join(w) or "a")
    tried = sorted(tried)
    chunk = next(words.split(pa.array([" ".join(tried)]), words.PLAIN_WORDS))
    found, cost = Lexicon(terms).find(chunk.data, chunk.starts, chunk.ends)
    for word, term, distance in zip(tried, found.tolist(), cost.tolist()):
        best = []
        for t in terms:
            ways = [word[:k] for k in range(len(word) + 1)] if t.stem else [word]
            d = min(edits(t.text, w) for w in ways)
            if d <= reach(t.text.encode()):
                best.append(d)
        assert (term >= 0) == bool(best) and (not best or distance == min(best)), word


def corpus(rng, n=1200):
    docs, labels = [], []
    for k in range(n):
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(30, 120))]
        toxic = k % 5 == 2
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                w[rng.randrange(len(w))] = rng.choice(INSULTS)
        docs.append((k, " ".join(w), "en"))
        labels.append((k, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_edge_cases(spark):
    docs, labels = corpus(random.Random(1))
    extra = [
        (5001, None, "x"), (5002, "", "x"), (5003, " \n ", "x"), (None, "you worthless idiot, pathetic", "x"), (5004, "wortless idoit " * 3 + "patheticc worthles", "x"),
        (5005, "w1 " * 100_000 + "worthless pathetic idiot", "x"), (0, docs[0][1], "x"), (5006, "w" * 300_000, "x"),
    ]
    table = spark.createDataFrame([(*d, "1", 0) for d in docs + extra], "doc_id long, text string, lang string, score string, predicted int")
    marks = spark.createDataFrame([*labels, (None, 1), (7, None), (99999, 1), *labels[:3]], "doc_id long, toxic int")
    rows = toxicity_scores(table, marks).collect()
    assert len(rows) == len(docs) + len(extra) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 5000]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert np.mean([r.predicted == (r.doc_id % 5 == 2) for r in held]) > 0.98
    score = {r.doc_id: r.score for r in rows}
    assert max(score[5001], score[5002], score[5003], score[5006]) < 0.5 < min(score[None], score[5004], score[5005])
    kept = drop_toxic(table, marks)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} >= {0, 5001, 5002, 5003, 5006}
    assert toxicity_scores(table.where("false"), marks).collect() == []
    assert {r.predicted for r in toxicity_scores(table, marks.where("false")).collect()} == {0}


def test_quotation_counts_less(spark):
    docs, labels = corpus(random.Random(2))
    said = [(6001, "worthless idiot and so on", "x"), (6002, 'they said "worthless idiot" and so on', "x")]
    table = spark.createDataFrame(docs + said, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    score = {r.doc_id: r.score for r in toxicity_scores(table, marks).collect()}
    assert score[6002] < score[6001]
