"""Substring deduplication: paragraphs that repeat, found by MinHash banding.

Units of comparison are the paragraphs (lines) of a text and, as passages also repeat inside
other text, anchored pieces: a fixed number of words that starts where a rolling hash of the words is
lowest around, so the same passage has the same pieces wherever it stands. Bands of MinHash
values bring similar paragraphs together, exact Jaccard verifies them, and components of
the links decide which copies go. A piece repeats when its words do.

Bands are tuned for recall: 10 bands of 3 values miss two paragraphs of Jaccard 0.8 once in 1,300
cases, and those of 0.9 once in 400,000.

Every paragraph has a sketch of 256 bits, which bounds how much two sets differ. Paragraphs that
meet are compared by it inside the join, and only those that may link are verified; the bound
leaves no link out. A few turns with leads of the bands link most copies before that, so that
what is joined in full are paragraphs of different components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.llm import words
from tokenloom.llm.components import components
from tokenloom.llm.counting import bucket_counts
from tokenloom.session import settle

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 10, 3
#: Words of an anchored piece, and words on either side that its anchor is lowest of.
PIECE, RADIUS = 20, 5

_random = np.random.default_rng(77)
_MINHASH = _random.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Times that paragraphs are compared with leads alone before all others are.
TURNS = 3
#: Leads of a band.
LEADS = 8
#: Columns of a set's sketch, 64 bits each.
SKETCH = ("s0", "s1", "s2", "s3")
_SCHEMA = "id long, kind int, first long, n_words int, sig long"


class _Paragraphs:
    """The paragraphs of a chunk that have words, all looked at together."""

    def __init__(self, chunk: words.Words):
        hashes, breaks = chunk.hashes, np.flatnonzero(chunk.data == 10)
        edges = np.unique(np.r_[0, chunk.first, np.searchsorted(chunk.starts, breaks), len(hashes)])
        self.start, self.size = edges[:-1], np.diff(edges)
        self.row = np.searchsorted(chunk.first, self.start, "right") - 1
        self.first = self.start - chunk.first[self.row]
        # every window inside a paragraph; a short paragraph is one window
        counts = np.maximum(self.size - SHINGLE + 1, 1)
        self.offsets = np.cumsum(counts) - counts
        self.owner = np.repeat(np.arange(len(counts)), counts)
        places = np.arange(len(self.owner)) - self.offsets[self.owner] + self.start[self.owner]
        self.shingles = np.zeros(len(places), np.uint64)
        width = np.minimum(self.size, SHINGLE)
        for w in np.unique(width).tolist():
            own = (width == w)[self.owner]
            self.shingles[own] = words.windows(hashes, w)[places[own]]
        # a paragraph's set has each shingle once
        told_apart = words.mix(self.shingles + self.owner.astype(np.uint64) * words._STEPS[0])
        order = np.argsort(told_apart)
        again = order[1:][told_apart[order[1:]] == told_apart[order[:-1]]]
        self.counts = np.ones(len(places), np.uint64)
        self.counts[again] = 0
        self.n = self._each(np.add, self.counts)
        self.sig = self._each(np.add, words.mix(self.shingles) * self.counts) + self.n

    def _each(self, ufunc, values: np.ndarray) -> np.ndarray:
        return ufunc.reduceat(values, self.offsets) if len(self.offsets) else values

    def items(self, k: int) -> np.ndarray:
        """The set of the k-th paragraph, in order."""
        stop = self.offsets[k + 1] if k + 1 < len(self.offsets) else len(self.shingles)
        return words.distinct(self.shingles[self.offsets[k] : stop])

    def sketch(self, part: int) -> np.ndarray:
        """64 bits of every set's sketch: whether an odd number of its shingles fall on each."""
        bits = np.where(self.shingles % len(SKETCH) == part, np.uint64(1) << (self.shingles >> np.uint64(58)), 0)
        return self._each(np.bitwise_xor, bits * self.counts)

    def bands(self) -> np.ndarray:
        """One key for each band of the MinHash values of every set."""
        # an odd factor permutes 64-bit values, and shingles are hashes already
        low = np.array([self._each(np.minimum, self.shingles * m) for m in _MINHASH]).reshape(BANDS, ROWS, -1)
        keys = (low[:, k] * words._STEPS[k] for k in range(ROWS))
        return words.mix(sum(keys) + np.arange(BANDS, dtype=np.uint64)[:, None]).T


def _pieces(chunk: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, hash) of the anchored pieces of every row.

    An anchor is a word whose three-word window is the lowest within RADIUS, the first of equals.
    """
    none = np.zeros(0, np.int64)
    if len(chunk.hashes) < PIECE:
        return none, none, none.view(np.uint64)
    high = np.uint64(0xFFFFFFFFFFFFFFFF)
    row = np.repeat(np.arange(len(chunk.rows)), np.diff(chunk.first))
    left = chunk.first[row + 1] - np.arange(len(row))  # words from here to the end of the row
    value = np.full(len(row), high)
    value[:-2] = words.windows(chunk.hashes, 3)
    value[left < 3] = high
    at = np.arange(len(row)) + RADIUS * (row + 1)  # rows lie apart
    spaced = np.full(len(row) + RADIUS * (len(chunk.rows) + 1), high)
    spaced[at] = value
    lowest = left >= PIECE
    for k in range(1, RADIUS + 1):
        lowest &= (value < spaced[at - k]) & (value <= spaced[at + k])
    found = np.flatnonzero(lowest)
    total = np.full(len(found), PIECE, np.uint64) * words._PLACE
    for k in range(PIECE):
        total += chunk.hashes[found + k] * words._STEPS[k]
    return row[found], found - chunk.first[row[found]], words.mix(total)


def _paragraph_bands(batches):
    """(sig, n, sketch, bands) of every paragraph."""
    for batch in batches:
        for chunk in words.split(batch.column(1), words.BLANK_WORDS):
            found = _Paragraphs(chunk)
            sigs, one = np.unique(found.sig.view(np.int64), return_index=True)
            bands = words.signed(found.bands()[one])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(one) + 1) * BANDS, pa.int32()), pa.array(bands.ravel()))
            sketch = [pa.array(words.signed(found.sketch(k)[one])) for k in range(len(SKETCH))]
            yield pa.RecordBatch.from_arrays([pa.array(sigs), pa.array(found.n[one].astype(np.int32)), *sketch, lists], ["sig", "n", *SKETCH, "bands"])


def _units(batches):
    """Paragraphs (kind 0) and anchored pieces (kind 1) of every text."""
    for batch in batches:
        for chunk in words.split(batch.column(1), words.BLANK_WORDS):
            found = _Paragraphs(chunk)
            row, first, sig = _pieces(chunk)
            rows = np.r_[found.row, row] + chunk.rows.start
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)), pa.array(np.repeat(np.int32([0, 1]), [len(found.row), len(row)])),
                    pa.array(np.r_[found.first, first]), pa.array(np.r_[found.size, np.full(len(row), PIECE)].astype(np.int32)),
                    pa.array(words.signed(np.r_[found.sig, sig])),
                ],
                ["id", "kind", "first", "n_words", "sig"],
            )


def _sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sig, items) of the paragraphs in ``wanted`` (sig) and of a few others, from the texts again."""
    hashed = lambda numbers: words.mix(numbers.view(np.uint64))
    counts = bucket_counts(wanted, lambda batch: iter([hashed(batch.column(0).to_numpy())]))
    shared = texts.sparkSession.sparkContext.broadcast(counts > 0)
    shift = np.uint64(64 - int(len(counts)).bit_length() + 1)

    def rows(batches):
        for batch in batches:
            for chunk in words.split(batch.column(1), words.BLANK_WORDS):
                found = _Paragraphs(chunk)
                sig = found.sig.view(np.int64)
                known = np.flatnonzero(shared.value[(hashed(sig) >> shift).astype(np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[known]), pa.array([found.items(k).tobytes() for k in known.tolist()], pa.binary())], ["sig", "items"]
                )

    return texts.mapInArrow(rows, "sig long, items binary").dropDuplicates(["sig"])


def _differ() -> Column:
    """Fewest shingles that one of sets ``_a`` and ``_b`` has and the other has not, by their sketches and sizes.

    A bit in which two sketches differ stands for such a shingle, another one for every bit.
    """
    bits = sum(F.bit_count(F.col(f"{k}_a").bitwiseXOR(F.col(f"{k}_b"))) for k in SKETCH)
    return F.greatest(bits, F.abs(F.col("n_a") - F.col("n_b")))


def _may_link() -> Column:
    """Whether sets ``_a`` and ``_b`` can reach the threshold; holds for all that do."""
    return _differ() * (100 + PERCENT) <= (F.col("n_a") + F.col("n_b")) * (100 - PERCENT)


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) whose paragraphs reach the threshold."""

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("items_a"), batch.column("items_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda s: sets.select(F.col("sig").alias(s), F.col("items").alias(f"items_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "items_a", "items_b")
    return settle(both.mapInArrow(check, "a long, b long"), "paragraph-links")


def _side(name: str) -> list[Column]:
    return [F.col(k).alias(f"{k}_{name}") for k in ("sig", "comp", "n", *SKETCH)]


def _mixed(entries: DataFrame, links: DataFrame | None) -> DataFrame:
    """``entries`` of bands that hold several components of ``links``, with ``comp`` and the band's ``major`` one."""
    told = entries.withColumn("comp", F.col("sig"))
    if links is not None:
        labels = settle(components(links), "paragraph-labels").select(F.col("id").alias("sig"), F.col("component").alias("label"))
        told = entries.join(labels, "sig", "left").withColumn("comp", F.coalesce("label", "sig")).drop("label")
    per = told.groupBy("band", "comp").count()
    mixed = per.groupBy("band").agg(F.max_by("comp", F.struct("count", "comp")).alias("major"), F.count("*").alias("comps"))
    return settle(told.join(mixed.where("comps > 1").select("band", "major"), "band"), "paragraph-told")


def _lead_pairs(told: DataFrame, turn: int) -> DataFrame:
    """(a, b): each paragraph with the most similar one, by sketches, of its bands' leads.

    A band has a few leads. At first they are the paragraphs that meet most others: of a
    paragraph and its altered copies that is the paragraph. Later they are others every time.
    """
    best = F.struct(F.xxhash64("sig", F.lit(turn)), "sig") if turn else F.struct("weight", "sig")
    slot = F.pmod(F.xxhash64(F.lit(turn), "sig"), F.lit(LEADS))
    leads = told.groupBy("band", slot.alias("slot")).agg(F.max_by(F.struct(*_side("b")), best).alias("lead"))
    met = told.select("band", *_side("a")).join(leads.select("band", "lead.*"), "band")
    met = met.where((F.col("comp_a") != F.col("comp_b")) & _may_link())
    return met.groupBy(F.col("sig_a").alias("a")).agg(F.min_by("sig_b", F.struct(_differ(), "sig_b")).alias("b"))


def _classes(texts: DataFrame) -> DataFrame:
    """(sig, comp): the component of every paragraph that a band brings together with another."""
    columns = "sig long, n int, " + "".join(f"{k} long, " for k in SKETCH) + "bands array<long>"
    paragraphs = settle(texts.mapInArrow(_paragraph_bands, columns).dropDuplicates(["sig"]), "paragraphs")
    # most bands are met once: their rows are dealt out one time, for the counts and for the join
    bands = paragraphs.select("sig", F.explode("bands").alias("band")).repartition("band")
    sizes = bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    shared = settle(bands.join(sizes, "band"), "paragraph-bands")
    weight = settle(shared.groupBy("sig").agg(F.sum("size").alias("weight")), "paragraph-weights")
    known = weight.join(paragraphs.drop("bands"), "sig")
    entries = settle(shared.drop("size").join(known, "sig"), "paragraph-entries")
    sets = settle(_sets(texts, weight.select("sig")), "paragraph-sets")
    links = None
    for turn in range(TURNS):
        # what links with a lead needs no other witness
        pairs = settle(_lead_pairs(_mixed(entries, links), turn), "paragraph-pairs")
        found = _links(pairs, sets)
        links = found if links is None else links.union(found)
    # the rest: colliding paragraphs of different components, those of a band's largest one against the others only
    told = _mixed(entries, links)
    a = told.where("comp <> major").select("band", *_side("a"))
    b = told.select("band", *_side("b"), (F.col("comp") == F.col("major")).alias("in_major"))
    ok = (F.col("comp_a") != F.col("comp_b")) & (F.col("in_major") | (F.col("sig_a") < F.col("sig_b"))) & _may_link()
    rest = a.join(b, "band").where(ok).select(F.col("sig_a").alias("a"), F.col("sig_b").alias("b")).distinct()
    links = links.union(_links(settle(rest, "paragraph-pairs"), sets))
    found = components(settle(links, "paragraph-links"))
    return settle(found.withColumnRenamed("id", "sig").withColumnRenamed("component", "comp"), "paragraph-classes")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per repeated unit: id, kind, first_word, n_words, component, component_id, removed.

    ``kind`` is ``paragraph`` or ``piece``; ``first_word`` counts words from 0. Units of one
    ``component`` repeat each other; ``component_id`` is the smallest id among them, and every
    unit but the first of its component, by id and place, is ``removed``. Units that nothing
    repeats are not listed. A paragraph of fewer than five words is one shingle. NULL and
    empty texts have no units; units with a NULL id count as last; rows that repeat an id
    are texts of their own, of which units at the same place are all kept or all removed.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    units = settle(texts.mapInArrow(_units, _SCHEMA), "paragraph-units")
    classes = _classes(texts)
    rows = units.where("kind = 0").join(classes, "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    rows = rows.unionByName(units.where("kind = 1").withColumn("comp", F.col("sig"))).drop("sig")
    # several units make a component repeat; counting is done before anything is kept
    place = F.struct(F.col("id").isNull().alias("last"), "id", "first")
    groups = rows.groupBy("kind", "comp").agg(F.count("*").alias("many"), F.min(place).alias("lead"))
    groups = groups.where("many > 1").select("kind", "comp", "lead")
    out = rows.join(groups, ["kind", "comp"])
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("kind") == 0, "paragraph").otherwise("piece").alias("kind"),
        F.col("first").alias("first_word"),
        F.col("n_words").cast("long").alias("n_words"),
        F.col("comp").alias("component"),
        F.col("lead.id").alias("component_id"),
        (place != F.col("lead")).alias("removed"),
    )
