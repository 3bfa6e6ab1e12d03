import random
import string

import pyarrow as pa
from tokenloom.llm import words
from tokenloom.llm.lexicon import Lexicon, Term
from tokenloom.llm.toxicity import train

INSULTS = "worthless pathetic idiot stupid scum moron".split()


def misspelled(word):
    """One letter dropped, doubled, replaced, or changed with its neighbour, at every position."""
    out = set()
    for i, c in enumerate(word):
        out |= {word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + "q" + word[i + 1 :]}
        if i + 1 < len(word):
            out.add(word[:i] + word[i + 1] + c + word[i + 2 :])
    return sorted(out - {word})


def labelled(rng, n=600, copies=0):
    """Texts of their own words, each fifth with insults; ``copies`` more of one toxic text."""
    vocabulary = ["".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randrange(3, 12))) for _ in range(2000)]
    docs = []
    for k in range(n):
        w = [rng.choice(vocabulary) for _ in range(60)]
        for _ in range(3 * (k % 5 == 2)):
            w[rng.randrange(60)] = rng.choice(INSULTS)
        docs.append((k, " ".join(w), int(k % 5 == 2)))
    same = " ".join(rng.choice(vocabulary) for _ in range(40)) + " worthless"
    return docs + [(n + k, same, 1) for k in range(copies)]


def learn(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return train(table.select("doc_id", "text"), table.select("doc_id", "toxic"))


def test_misspellings_in_every_position_of_learned_terms(spark):
    model = learn(spark, labelled(random.Random(3)))
    tried = [m for w in INSULTS for m in misspelled(w)] + "idoit pahtetic sutpid wrothless idoits wrothlessness".split() + INSULTS
    chunk = next(words.split(pa.array([" ".join(tried)]), words.PLAIN_WORDS))
    found, _ = model.lexicon.find(chunk.data, chunk.starts, chunk.ends)
    assert [w for w, t in zip(tried, found.tolist()) if t < 0] == []
    calm = "weather pattern summer window statement"
    rude = "you idoit how wrothless and pahtetic"
    assert model.scores(pa.array([rude]))[0] > 0.5 > model.scores(pa.array([calm]))[0]


def test_swapped_neighbours_are_one_edit():
    chunk = next(words.split(pa.array(["idoit diiot idito iidot"]), words.PLAIN_WORDS))
    for swaps, hits in ((True, 4), (False, 0)):
        found, _ = Lexicon([Term("idiot", False, 1.0)], swaps).find(chunk.data, chunk.starts, chunk.ends)
        assert (found >= 0).sum() == hits


def test_copies_do_not_raise_the_bar(spark):
    rows = labelled(random.Random(5), copies=4000)
    terms = {t.text for t in learn(spark, rows).lexicon.terms}
    assert terms >= set(INSULTS)


def test_rare_terms_are_learned_and_chance_ones_not(spark):
    rows = labelled(random.Random(7), n=5000)
    rare = 0
    for k, (id_, text, toxic) in enumerate(rows):
        if toxic and rare < 15:  # 15 of 1,000 toxic texts
            rows[k], rare = (id_, text + " nincompoop", toxic), rare + 1
    terms = {t.text for t in learn(spark, rows).lexicon.terms if not t.stem}
    assert "nincompoop" in terms and terms <= {*INSULTS, "nincompoop"}
