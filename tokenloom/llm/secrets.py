"""Secret findings, with a random forest that sorts out false ones.

Every long run of key-like characters with a digit in it is a candidate, and so are values of
eight and more characters that are assigned to a credential's name, published key formats and PEM
key blocks. Of a run like ``API_KEY=...`` the part after the name is the secret. The forest is trained
from labelled findings on what a candidate looks like and where it stands: its length, how its
characters follow each other, how much of it dictionary words cover, its path and the words
next to it. The dictionary comes from the corpus.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tokenloom.llm.toxicity import in_fold
from tokenloom.session import settle

#: Labelled findings of a class the forest learns from at most; more are thinned by a hash.
LABELLED_ROWS = 20_000
#: Most frequent words of the corpus that make the dictionary.
DICTIONARY = 2_000
#: Characters of the line that are looked at on either side of a candidate.
AROUND = 60

_CANDIDATE = re.compile(r"[A-Za-z0-9_+/=.\-]{16,}")
_SEPARATOR = re.compile("[:=]")
_VALUE = re.compile(r"""[:=>]*[ \t]*(?:(?:[Bb]earer|[Bb]asic)[ \t]+)?(?:"([^"\n]{8,})"|'([^'\n]{8,})'|`([^`\n]{8,})`|([^\s"'`,;&]{8,}))""")
_PEM = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*KEY(?: BLOCK)?)-----")
_PEM_LINES = re.compile(r"(?:\r?\n[A-Za-z0-9+/=]{16,}(?=\r?\n|$))*")
_NAME_PARTS = re.compile("[A-Z]?[a-z]+|[A-Z]+")
_CLASSES = (("lower", re.compile("[a-z]")), ("upper", re.compile("[A-Z]")), ("digit", re.compile("[0-9]")))
_VOWELS = set("aeiouAEIOU")

# Words beside a value that say what it is, and words that mark samples.
CREDENTIAL = "token secret password passwd pwd key apikey api auth bearer credential credentials private access".split()
NAMES = {*CREDENTIAL, "authorization", "pass", "passphrase"}
SAMPLE = "example sample dummy test fake placeholder your changeme redacted xxxx".split()
SAMPLE_PATH = "test tests example examples sample fixture fixtures doc docs lock".split()
# Published formats of access keys.
FORMATS = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_\-]{20,}|xox[abp]-[A-Za-z0-9\-]{10,}|eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+")

FEATURES = (
    "length entropy digits uppers lowers symbols switches repeats vowel_turns hex covered "
    "credential sample assigned quoted sample_path path_digits"
).split()
_SCHEMA = "id long, start long, value string, secret_start long, secret string, before string, after string, " + ", ".join(f"{f} double" for f in FEATURES)


def features(value: str, before: str, after: str, path: str, dictionary: frozenset[str]) -> list[float]:
    """One number for each of FEATURES."""
    n, counts = len(value), Counter(value)
    kinds = ["l" if c.islower() else "u" if c.isupper() else "d" if c.isdigit() else "s" for c in value]
    pairs = list(zip(value, value[1:]))
    low = value.lower()
    covered, at = 0, 0
    while at < n:  # longest dictionary word first, left to right
        size = next((k for k in range(min(12, n - at), 3, -1) if low[at : at + k] in dictionary), 0)
        covered += size
        at += max(size, 1)
    beside = before[-AROUND:] + " " + after[:AROUND]
    near = {*re.findall(r"[a-z]+", beside.lower()), *map(str.lower, _NAME_PARTS.findall(beside))}
    tail = before.rstrip("\"'` ")
    parts = set(re.split(r"[^a-z]+", path.lower()))
    return [
        float(n),
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        *(kinds.count(k) / n for k in "duls"),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
        sum(a == b for a, b in pairs) / max(1, n - 1),
        sum((a in _VOWELS) != (b in _VOWELS) for a, b in pairs if a.isalpha() and b.isalpha()) / max(1, n - 1),
        float(bool(re.fullmatch("[0-9a-fA-F]+", value))),
        covered / n,
        float(bool(near & set(CREDENTIAL))),
        float(bool(near & set(SAMPLE)) or any(s in low for s in SAMPLE)),
        float(tail.endswith(("=", ":"))),
        float(before.endswith(("\"", "'", "`")) and after.startswith(("\"", "'", "`"))),
        float(bool(parts & set(SAMPLE_PATH))),
        sum(c.isdigit() for c in path) / max(1, len(path)),
    ]


def _blocks(text: str) -> list[tuple[int, int]]:
    """PEM key blocks; one without its end goes as far as its lines."""
    out, marks = [], list(_PEM.finditer(text))
    for mark, then in zip(marks, [*marks[1:], None]):
        if mark[1] == "BEGIN":
            closed = then is not None and then[1] == "END" and then[2] == mark[2]
            out.append((mark.start(), then.end() if closed else _PEM_LINES.match(text, mark.end()).end()))
    return out


def _assigned(text: str) -> list[tuple[int, int]]:
    """Values of eight and more characters that are assigned to a credential's name."""
    out, done = [], 0
    for mark in _SEPARATOR.finditer(text):
        at = mark.start()
        if at < done:
            continue
        name = text[max(0, at - AROUND) : at].rstrip(" \t").rstrip("\"'`]")
        name = re.split(r"[^A-Za-z0-9_\-]", name)[-1]
        if not NAMES & {name.lower(), *re.split("[^a-z]+", name.lower()), *map(str.lower, _NAME_PARTS.findall(name))}:
            continue
        found = _VALUE.match(text, at)
        if found:
            start, done = found.span(found.lastindex)
            end = done if found.lastindex < 4 else start + len(text[start:done].rstrip(".)]}>"))
            if end - start >= 8:
                out.append((start, end))
    return out


def spots(text: str) -> list[tuple[int, int, int]]:
    """(start, end, start of the secret) of every candidate, in order; none overlaps another."""
    blocks, named = _blocks(text), _assigned(text)

    def over(spans, start, end):
        """The first of ``spans`` that shares a character with start:end."""
        k = bisect.bisect_right(spans, start, key=lambda span: span[1])
        return spans[k] if k < len(spans) and spans[k][0] < end else None

    out = []
    for found in _CANDIDATE.finditer(text):
        value = found.group().rstrip(".=-_+/") if not found.group().endswith("=") else found.group().rstrip(".")
        start, end = found.start(), found.start() + len(value)
        # name=value: the secret begins after the name; '=' at the end is padding
        inner = start + value.rstrip("=").rfind("=") + 1
        digit = any(c.isdigit() for c in value)
        if len(value) < 16 or not (digit or FORMATS.fullmatch(value, inner - start)) or over(blocks, start, end):
            continue
        whole = over(named, start, end)
        if whole and not (start <= whole[0] and whole[1] <= end):
            continue  # a part of a longer value
        out.append((start, end, whole[0] if whole and whole[1] == end else inner))
    runs = [(start, end) for start, end, _ in out]
    out += [(start, end, start) for start, end in named if not over(runs, start, end) and not over(blocks, start, end)]
    return sorted(out + [(start, end, start) for start, end in blocks])


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> frozenset[str]:
    """The ``size`` most frequent words of four to twelve letters in all texts."""
    letters = F.split(F.lower(F.col(text_col).cast("string")), r"[^a-z]+")
    counts = docs.select(F.explode_outer(letters).alias("word")).where("length(word) between 4 and 12").groupBy("word").count()
    return frozenset(r["word"] for r in counts.orderBy(F.desc("count"), "word").limit(size).collect())


def candidates(docs: DataFrame, known: frozenset[str], id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(id, start, value, secret_start, secret, before, after, FEATURES) of every candidate; starts count characters.

    ``secret`` is ``value`` without the name that it is fused to, and what FEATURES look at.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))

    def rows(batches):
        for batch in batches:
            out = []
            for id_, path, text in zip(*(batch.column(k) for k in range(3))):
                text = text.as_py() or ""
                for start, end, inner in spots(text):
                    secret = text[inner:end]
                    before = text[max(0, inner - AROUND) : inner].rpartition("\n")[2]
                    after = text[end : end + AROUND].partition("\n")[0]
                    told = features(secret, before, after, path.as_py() or "", known)
                    out.append((id_.as_py(), start, text[start:end], inner, secret, before, after, *told))
            columns = list(zip(*out)) if out else [()] * (7 + len(FEATURES))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.float64()] * len(FEATURES)
            names = ["id", "start", "value", "secret_start", "secret", "before", "after", *FEATURES]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return texts.mapInArrow(rows, _SCHEMA)


def label_by_rule(found: DataFrame) -> DataFrame:
    """``found`` with ``label``: 1 where a credential is assigned, 0 for what is plainly something else, else NULL.

    Stands in for reviewed findings where there are none: hex strings of 32 and more that are
    assigned to a credential's name, quoted values of letters with digits that are, published key
    formats and private PEM keys are real; numbers, hosts, dates, public keys and sample values are not.
    """
    value = F.col("secret")
    host = value.rlike(r"^([A-Za-z0-9\-]+\.)+[A-Za-z]{2,}$")
    letters = F.col("lowers") + F.col("uppers") > 0
    real = (F.col("credential") == 1) & (F.col("assigned") == 1) & (F.col("sample") == 0) & ((F.col("hex") == 1) & (F.col("length") >= 32) & letters)
    real |= (F.col("credential") == 1) & (F.col("assigned") == 1) & (F.col("quoted") == 1) & (F.col("sample") == 0) & letters & (F.col("digits") > 0) & ~host & ~value.rlike(r"\s")
    real |= value.rlike("^-----BEGIN [A-Z0-9 ]*PRIVATE KEY") & (F.col("sample") == 0)
    real |= value.rlike(f"^({FORMATS.pattern})$") & (F.col("sample") == 0)
    other = value.rlike(r"^[0-9.+/_=\-]+$") | host | value.rlike("^-----BEGIN [A-Z0-9 ]*PUBLIC KEY") | (F.col("sample") == 1)
    return found.withColumn("label", F.when(real, 1).when(other, 0).cast("double"))


def train_forest(found: DataFrame, limit: int = LABELLED_ROWS):
    """A forest from at most ``limit`` labelled findings of each class; None if a class is missing.

    Findings of a thinned class weigh as much more as fewer of them are left, so the shares of the
    classes are those of all labelled findings, whatever their number.
    """
    rows = found.where("label is not null")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    parts = []
    for label, count in sorted(counts.items()):
        part = rows.where(F.col("label") == label).orderBy(F.xxhash64("id", "start", "value"), "id", "start").limit(limit)
        parts.append(part.select("label", *FEATURES).withColumn("weight", F.lit(max(1.0, count / limit))))
    rows = settle(reduce(DataFrame.unionByName, parts), "labelled-findings")
    forest = RandomForestClassifier(numTrees=40, maxDepth=8, seed=7, featuresCol="features", labelCol="label", weightCol="weight")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))


def score_findings(found: DataFrame, model) -> DataFrame:
    """``found`` with ``score``, the forest's share of trees for a real secret.

    Without a forest the rule decides: 1 for what ``label_by_rule`` calls real, else 0.
    """
    if model is None:
        ruled = label_by_rule(found.withColumnRenamed("label", "reviewed")).withColumn("score", F.coalesce("label", F.lit(0.0)))
        return ruled.drop("label").withColumnRenamed("reviewed", "label")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    rows = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return rows.select(*found.columns, "score")


def scan_secrets(
    docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source"
) -> DataFrame:
    """One row per candidate: id, start, length, sha256, secret_start, secret_length, secret_sha256, held_out, label, score, is_secret.

    ``secret_`` columns are those of the candidate without the name that it is fused to.
    ``labelled`` holds reviewed findings (id, start, label); without it labels come from
    ``label_by_rule``. Candidates whose crc32 of the id leaves 0 by five are held out of training. NULL
    and empty texts have no candidates; rows that repeat an id are scanned each.
    """
    found = settle(candidates(docs, dictionary(docs, text_col), id_col, text_col, path_col), "candidates")
    if labelled is None:
        found = label_by_rule(found)
    else:
        marks = labelled.groupBy("id", "start").agg(F.max(F.col("label").cast("double")).alias("label"))
        found = found.join(marks, ["id", "start"], "left")
    out = score_findings(found, train_forest(found.where(~in_fold("id", 0))))
    return out.select(
        F.col("id").alias(id_col),
        "start",
        F.length("value").cast("long").alias("length"),
        F.sha2("value", 256).alias("sha256"),
        "secret_start",
        F.length("secret").cast("long").alias("secret_length"),
        F.sha2("secret", 256).alias("secret_sha256"),
        in_fold("id", 0).alias("held_out"),
        F.col("label").cast("int").alias("label"),
        "score",
        (F.col("score") >= 0.5).alias("is_secret"),
    )
