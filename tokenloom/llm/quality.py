"""Quality rules, line first: lines that are no prose go, then documents that lost too much.

Every line of a text is judged alone, by punctuation, navigation and boilerplate rules; the
first rule that a line breaks removes it. A document whose remaining words are too small a
share of its words is rejected, as are those that break the base rules on the whole text
(too few words, too many of them in repeated windows). A good document keeps its text without
a few stray lines instead of being judged by averages over it.

One pass over the texts, without an exchange; a task holds a batch of texts and the words of one.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tokenloom.llm.names import free_name

#: Base rules: a text has so many words, at most this percentage of them in repeated windows.
MIN_WORDS = 50
REPEAT_PERCENT = 50
WINDOW = 3
#: A document is rejected if less than this percentage of its words is in lines that stay.
KEEP_PERCENT = 50

SYMBOLS = "#*$%&|<>"
#: Marks that prose has few of; a line with more than one to so many other characters breaks the rule.
MARKS = "#*$%&<>!?=~^_+@\\{}[]"
CHARS_PER_MARK = 10
#: Menu items stand between bars, this many at least and one to so many words; or alone, without an end of a sentence.
BAR = "|"
MIN_BARS = 3
WORDS_PER_BAR = 4
MENU_WORDS = 3
SENTENCE_ENDS = ".!?:;,\"')…»”。！？"
#: Phrases make a line boilerplate if it has fewer words than this.
PHRASE_WORDS = 20
PHRASES = (
    "all rights reserved", "alle rechte vorbehalten", "tous droits réservés", "todos los derechos reservados",
    "cookie policy", "accept cookies", "use cookies", "privacy policy", "datenschutzerklärung", "terms of use", "terms of service",
    "enable javascript", "lorem ipsum", "click here", "read more", "skip to content", "share this", "subscribe to", "sign up", "log in",
)

RULES = ("punctuation", "navigation", "boilerplate")

_SYMBOLS, _MARKS, _ENDS = SYMBOLS.encode(), MARKS.encode(), tuple(c.encode() for c in SENTENCE_ENDS)
_PHRASES = tuple(p.encode() for p in PHRASES)


class Judged(NamedTuple):
    """What is known of a text; the cleaned text last."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    broken: tuple[int, int, int]  # lines that broke each rule
    kept_words: int
    clean: bytes


def broken_rule(line: bytes, words: list[bytes], chars: int, again: bool) -> int | None:
    """Which of RULES a line with words breaks first. ``chars``: code points of its words; ``again``: it stood before."""
    if CHARS_PER_MARK * (len(line) - len(line.translate(None, _MARKS))) > chars:
        return 0
    bars = line.count(BAR.encode())
    if bars >= MIN_BARS and WORDS_PER_BAR * bars >= len(words):
        return 1
    if len(words) <= MENU_WORDS and not words[-1].endswith(_ENDS):
        return 1
    if again:
        return 2
    if len(words) < PHRASE_WORDS:
        lower = line.lower()  # bytes: A-Z alone
        if any(p in lower for p in _PHRASES):
            return 2
    return None


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that the text holds twice or more. Windows are told apart exactly."""
    count = len(words) - window + 1
    if count < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    same = ids[:count]
    for more in range(1, window):
        _, same, times = np.unique(same * len(number) + ids[more : more + count], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[same] > 1)
    covered = np.zeros(len(words), bool)
    for more in range(window):
        covered[starts + more] = True
    return int(covered.sum())


def judge(text: bytes) -> Judged:
    """Counts over a whole text, and its lines by the rules. Words stand between ASCII blanks."""
    seen: set[bytes] = set()
    words, kept, broken, chars, kept_words, repeats = [], [], [0] * len(RULES), 0, 0, 0
    for line in text.split(b"\n"):
        own = line.split()  # bytes: space, \t, \n, \v, \f, \r
        if not own:
            kept.append(line)
            continue
        own_chars = len(b"".join(own).decode())
        again = line in seen
        seen.add(line)
        rule = broken_rule(line, own, own_chars, again)
        if rule is None:
            kept.append(line)
            kept_words += len(own)
        else:
            broken[rule] += 1
        words += own
        chars, repeats = chars + own_chars, repeats + again
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    return Judged(len(words), chars, symbols, repeats, repeated_words(words), tuple(broken), kept_words, b"\n".join(kept))


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *(f"{r}_lines" for r in RULES), "kept_words")


def _found_type(with_text: bool) -> T.StructType:
    counts = [T.StructField(name, T.LongType()) for name in _COUNTS]
    return T.StructType(counts + [T.StructField("clean", T.StringType())] * with_text)


def judged(docs: DataFrame, text_col: str = "text", found: str = "__judged", with_text: bool = False) -> DataFrame:
    """``docs`` with a struct ``found`` of counts, and of the cleaned text if asked for. NULL texts are empty."""
    place = docs.columns.index(text_col)
    kind = _found_type(with_text)
    names = [f.name for f in kind]

    def run(batches):
        for batch in batches:
            texts = batch.column(place).cast(pa.large_binary())
            rows = [judge(t.as_py() or b"") for t in texts]
            columns = [pa.array([(*r[:5], *r[5], r[6])[i] for r in rows], pa.int64()) for i in range(len(_COUNTS))]
            if with_text:
                columns.append(pa.array([r.clean.decode() for r in rows], pa.string()))
            struct = pa.StructArray.from_arrays(columns, names)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*batch.schema.names, found])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(found, kind)]))


def base_failed(found: str = "__judged", min_words: int = MIN_WORDS, repeat_percent: int = REPEAT_PERCENT):
    words = F.col(f"{found}.n_words")
    return (words < min_words) | (100 * F.col(f"{found}.n_repeat_words") > repeat_percent * words)


def is_kept(found: str = "__judged", keep_percent: int = KEEP_PERCENT):
    """No base rule is broken, and enough words are in lines that stay."""
    return ~base_failed(found) & (100 * F.col(f"{found}.kept_words") >= keep_percent * F.col(f"{found}.n_words"))


def clean_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept, with their own columns, their text without the lines that broke a rule.

    NULL and empty texts break a base rule. Repeated rows are documents of their own; all
    other columns stay as they are, whatever their names.
    """
    found = free_name(docs, "__judged")
    rows = judged(docs.withColumn(text_col, F.col(text_col).cast("string")), text_col, found, with_text=True).where(is_kept(found))
    return rows.withColumn(text_col, F.col(f"{found}.clean")).select(*docs.columns)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the base counts, lines by broken rule, words kept, the verdicts."""
    found = judged(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")))
    counts = [F.col(f"__judged.{name}").alias(name) for name in _COUNTS]
    return found.select(id_col, *counts, base_failed().alias("base_failed"), is_kept().alias("kept"))


def _sql() -> str:
    """The report in SQL: lines and windows as rows of their own, judged by expressions."""
    blanks = r"[\x20\x09-\x0D]"
    word = r"[^\x20\x09-\x0D]+"

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def chars_of(column: str, kinds: str) -> str:
        return f"(length({column}) - length(translate({column}, {quoted(kinds)}, '')))"

    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    phrases = " OR ".join(f"contains(lowered, {quoted(p)})" for p in PHRASES)
    ends = ", ".join(quoted(c) for c in SENTENCE_ENDS)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT row_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM docs),
measured AS (
  SELECT *, len(regexp_extract_all(line, '{word}')) AS n, length(regexp_replace(line, '{blanks}', '', 'g')) AS chars,
         {chars_of('line', MARKS)} AS marks, {chars_of('line', SYMBOLS)} AS symbols, {chars_of('line', BAR)} AS bars,
         row_number() OVER (PARTITION BY row_id, line ORDER BY place) > 1 AS again,
         right(regexp_replace(line, '{blanks}+$', ''), 1) AS last, translate(line, '{upper}', '{lower}') AS lowered
  FROM lines),
ruled AS (
  SELECT *, CASE WHEN {CHARS_PER_MARK} * marks > chars THEN 'punctuation'
                 WHEN bars >= {MIN_BARS} AND {WORDS_PER_BAR} * bars >= n THEN 'navigation'
                 WHEN n <= {MENU_WORDS} AND last NOT IN ({ends}) THEN 'navigation'
                 WHEN again OR (n < {PHRASE_WORDS} AND ({phrases})) THEN 'boilerplate' END AS rule
  FROM measured WHERE n > 0),
by_line AS (
  SELECT row_id, sum(n)::BIGINT AS n_words, sum(chars)::BIGINT AS word_chars, sum(symbols)::BIGINT AS n_symbols,
         count(*) FILTER (again) AS n_dup_lines, {', '.join(f"count(*) FILTER (rule = '{r}') AS {r}_lines" for r in RULES)},
         coalesce(sum(n) FILTER (rule IS NULL), 0)::BIGINT AS kept_words
  FROM ruled GROUP BY row_id),
words AS (
  SELECT row_id, unnest(regexp_extract_all(text, '{word}')) AS w, generate_subscripts(regexp_extract_all(text, '{word}'), 1) AS place FROM docs),
triples AS (
  SELECT row_id, place, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY row_id ORDER BY place)),
counted AS (
  SELECT row_id, place, count(*) OVER (PARTITION BY row_id, w, w2, w3) AS times FROM triples WHERE w3 IS NOT NULL),
repeated AS (
  SELECT row_id, count(DISTINCT place + step) AS n_repeat_words
  FROM counted, (SELECT unnest([0, 1, 2]) AS step) WHERE times > 1 GROUP BY row_id),
joined AS (
  SELECT doc_id, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _COUNTS)}
  FROM docs LEFT JOIN by_line USING (row_id) LEFT JOIN repeated USING (row_id)),
failed AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM joined)
SELECT *, NOT base_failed AND 100 * kept_words >= {KEEP_PERCENT} * n_words AS kept FROM failed"""


SQL = _sql()
