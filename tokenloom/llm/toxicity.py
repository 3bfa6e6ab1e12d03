"""Toxicity scores from a learned lexicon that also catches misspelled terms.

Terms are words and word stems that labelled toxic texts have and clean ones have not. Levenshtein
automata of a text's words are intersected with the lexicon's trie; each hit is weighed by
what stands around it, so that a quoted or reported insult counts apart from an abusive one.
A logistic model over the sums of a text gives the score.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tokenloom.llm import words
from tokenloom.llm.lexicon import Lexicon, Term
from tokenloom.llm.names import free_name
from tokenloom.session import settle

#: Labelled rows the model learns from at most; more are thinned by a hash of the id.
LABELLED_ROWS = 20_000
#: Terms of a lexicon at most, the weightiest first.
TERMS = 2_000
STEM_LETTERS = range(4, 9)
#: Toxic texts that have a term at least, and the probability that any term is one by chance.
SUPPORT, CHANCE = 4, 0.01
#: Words around a hit that tell quotation from abuse.
AROUND = 5

# Words that report what others said, and words that address someone.
REPORTING = (
    "said says saying wrote writes quote quoted quotes quoting called calling calls word term phrase insult slur "
    "sagte sagt schrieb zitat wort dijo dice palabra cita escribió dit mot citation écrit"
).split()
ADDRESSING = "you your youre yourself u ur du dein dich ihr tu te tú eres usted vous toi es".split()

_MINHASH = np.random.default_rng(41).integers(1, 1 << 63, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

FEATURES = ("abuse", "quoted", "misspelled", "density")
#: Weights that the model is drawn to where labels say nothing, intercept last.
PRIOR = np.array([2.0, 0.5, 1.0, 0.5, -3.0])


def _hash(text: str) -> np.uint64:
    return next(words.split(pa.array([text]), words.PLAIN_WORDS)).hashes[0]


_REPORTING = np.sort(np.array([_hash(w) for w in REPORTING], np.uint64))
_ADDRESSING = np.sort(np.array([_hash(w) for w in ADDRESSING], np.uint64))


def text_features(column: pa.Array, lexicon: Lexicon, innocent: np.ndarray) -> np.ndarray:
    """Per text: evidence of abuse, quoted evidence, its misspelled part, and hits among all words."""
    out = np.zeros((len(column), len(FEATURES)))
    for chunk in words.split(column, words.PLAIN_WORDS):
        kinds, first, which = np.unique(chunk.hashes, return_index=True, return_inverse=True)
        term, edits = lexicon.find(chunk.data, chunk.starts[first], chunk.ends[first])
        term[(edits > 0) & np.isin(kinds, innocent)] = -1
        hits = np.flatnonzero(term[which] >= 0)
        rows = np.searchsorted(chunk.first, hits, "right") - 1
        text = chunk.data.tobytes() if len(hits) else b""
        for hit, row in zip(hits.tolist(), rows.tolist()):
            lo, hi = int(chunk.first[row]), int(chunk.first[row + 1])
            found, off = int(term[which[hit]]), int(edits[which[hit]])
            around = chunk.hashes[max(lo, hit - AROUND) : min(hi, hit + AROUND + 1)]
            begin = int(chunk.starts[hit])
            line = text[max(text.rfind(b"\n", 0, begin) + 1, int(chunk.texts[row])) : begin]
            quoted = (line.count(b'"') + line.count("“".encode()) + line.count("”".encode())) % 2 == 1
            quoted |= bool(np.isin(around, _REPORTING).any())
            addressed = bool(np.isin(around, _ADDRESSING).any())
            worth = lexicon.terms[found].weight / (1 + off)
            place = chunk.rows[row]
            out[place, 1 if quoted and not addressed else 0] += worth
            out[place, 2] += worth if off else 0.0
            out[place, 3] += 1 / (hi - lo)
    out[:, :3] = np.log1p(out[:, :3])
    out[:, 3] *= 100
    out[:, 3] = np.log1p(out[:, 3])
    return out


def _mark(hashes: np.ndarray) -> int:
    """One number for the MinHash values of a text's four-word windows: the same for copies."""
    low = (words.windows(hashes, 4)[:, None] * _MINHASH).min(axis=0)
    return int(words.signed(words.mix((words.mix(low) * _MINHASH).sum(keepdims=True)))[0])


def _kinds(docs: DataFrame) -> DataFrame:
    """(toxic, mark, words) of the labelled texts that have words; copies count once."""

    def rows(batches):
        for batch in batches:
            out = []
            for chunk in words.split(batch.column(1), words.PLAIN_WORDS):
                text = chunk.data.tobytes()
                for i, row in enumerate(chunk.rows):
                    span = chunk.of(i)
                    kinds, first = np.unique(chunk.hashes[span], return_index=True)
                    mark = _mark(chunk.hashes[span]) if len(kinds) else None
                    found = [
                        text[chunk.starts[j] : chunk.ends[j]].decode("utf-8", "replace") for j in (first + span.start).tolist()
                    ]
                    out.append((mark, found, row))
            toxic = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(toxic[r]) for _, _, r in out], pa.int32()),
                    pa.array([m for m, _, _ in out], pa.int64()),
                    pa.array([f for _, f, _ in out], pa.list_(pa.string())),
                ],
                ["toxic", "mark", "words"],
            )

    kinds = docs.select("toxic", "text").mapInArrow(rows, "toxic int, mark long, words array<string>")
    return kinds.where("mark is not null").dropDuplicates(["mark", "toxic"])


def _stems(kinds: DataFrame) -> DataFrame:
    """(word, toxic, clean): texts of either kind that have the word."""
    return kinds.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    )


def _lexicon(stems: DataFrame, toxic: int, clean: int) -> list[Term]:
    """Words and stems at least twenty times as common in the ``toxic`` texts as in the ``clean``, and not by chance.

    A term is in SUPPORT toxic texts at least, and texts dealt at random would be as toxic for
    one of all words with a probability of CHANCE at most (Chernoff's bound on the binomial tail).

    Every such word is a term and takes its misspellings. Of stems that continue each other the
    first takes what words are made with it, the last also the misspellings of those words; four
    letters say too little to allow edits.
    """
    size = F.length("word")
    whole = stems.where(size >= 3).select("word", F.lit(False).alias("stem"), "toxic", "clean")
    parts = F.explode(F.array(*[F.lit(n) for n in STEM_LETTERS]))
    heads = stems.select("word", "toxic", "clean", parts.alias("n")).where(size >= F.col("n"))
    heads = heads.groupBy(F.substring("word", F.lit(1), F.col("n")).alias("word")).agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rows = whole.unionByName(heads.select("word", F.lit(True).alias("stem"), "toxic", "clean"))
    has, share = F.col("toxic") + F.col("clean"), toxic / (toxic + clean)
    surprise = F.col("toxic") * F.log(F.col("toxic") / has / share)
    surprise += F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / has / (1 - share))).otherwise(0.0)
    bound = math.log(max(1, stems.count()) / CHANCE)
    rows = rows.where((F.col("toxic") >= SUPPORT) & (surprise >= bound) & (F.col("clean") * 20 * toxic <= F.col("toxic") * clean))
    weight = F.log10(((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1)))
    rows = rows.withColumn("weight", weight).orderBy(F.desc("weight"), "word", "stem").limit(4 * TERMS).collect()
    stemmed = {r["word"] for r in rows if r["stem"]}
    continued = {word[:-1] for word in stemmed}
    terms = []
    for row in rows:
        text, size = row["word"], len(row["word"])
        first = not any(text[:n] in stemmed for n in STEM_LETTERS if n < size)
        if not row["stem"] or first or text not in continued:
            exact = row["stem"] and size == STEM_LETTERS[0]
            terms.append(Term(text, row["stem"], float(row["weight"]), 0 if exact else None))
    return sorted(terms[:TERMS])


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression, drawn to PRIOR by a ridge."""
    x = np.c_[x, np.ones(len(x))]
    weights = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + (weights - PRIOR)
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


class ToxicityModel:
    """A lexicon, words that only look misspelled, and the weights of a text's sums."""

    def __init__(self, terms: list[Term], innocent: np.ndarray, weights: np.ndarray):
        self.lexicon, self.innocent, self.weights = Lexicon(terms, swaps=True), innocent, weights

    def scores(self, column: pa.Array) -> np.ndarray:
        x = np.c_[text_features(column, self.lexicon, self.innocent), np.ones(len(column))]
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LABELLED_ROWS) -> ToxicityModel:
    """A model from at most ``limit`` labelled texts (``labels``: id and ``toxic``, 0 or 1).

    Rows without id or label are not used; of several labels of one id the highest holds.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    # at most ``limit`` rows of two numbers: the bound of this broadcast
    known = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(limit))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = settle(texts.join(known, "id").select("toxic", "text"), "labelled")
    kinds = settle(_kinds(texts), "kinds")
    toxic, total = kinds.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    stems = settle(_stems(kinds), "stems")
    terms = _lexicon(stems, max(1, toxic), max(1, total - toxic))
    shared = spark.sparkContext.broadcast(Lexicon(terms, swaps=True))

    def lookalikes(batches):
        """Clean words that a misspelled term would look like."""
        for batch in batches:
            for chunk in words.split(batch.column(0), words.PLAIN_WORDS):
                _, edits = shared.value.find(chunk.data, chunk.starts, chunk.ends)
                near = (edits > 0) & (edits < 100)
                yield pa.RecordBatch.from_arrays([pa.array(words.signed(chunk.hashes[near]))], ["hash"])

    clean = stems.where("clean > 0").select("word").mapInArrow(lookalikes, "hash long")
    innocent = np.sort(np.array([r[0] for r in clean.collect()], np.int64).view(np.uint64))

    def features(batches):
        for batch in batches:
            x = text_features(batch.column(1), shared.value, innocent)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in x.T]], ["toxic", *FEATURES])

    rows = texts.mapInArrow(features, "toxic int, " + ", ".join(f"{f} double" for f in FEATURES)).collect()
    table = np.array(rows, np.float64).reshape(-1, 1 + len(FEATURES))
    return ToxicityModel(terms, innocent, _fit(table[:, 1:], table[:, 0]))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``, 0 to 1; NULL and empty texts get the score of no evidence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c != score_col]
    at = rest.index(text_col)

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            column = column if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.cast(pa.string())
            found = pa.array(shared.value.scores(column), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, score_col])

    table = docs.select(*rest)
    return table.mapInArrow(run, T.StructType([*table.schema.fields, T.StructField(score_col, T.DoubleType())]))


def in_fold(id_col: str, fold: int):
    """Rows whose crc32 of the id as text leaves ``fold`` by five; a NULL id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == fold, F.lit(False))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted. Held-out rows teach nothing."""
    model = train(docs, labels.where(~in_fold(id_col, 0)), id_col, text_col)
    out = score(docs.select(id_col, text_col), model, text_col)
    return out.select(id_col, in_fold(id_col, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, with their own columns."""
    model = train(docs, labels.where(~in_fold(id_col, 0)), id_col, text_col)
    name = free_name(docs, "__toxicity")
    return score(docs, model, text_col, name).where(F.col(name) < 0.5).select(*docs.columns)
