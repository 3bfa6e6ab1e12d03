import random
from collections import Counter

import check
import pytest
from plain import BLANK

from tokenloom.llm import quality
from tokenloom.llm.quality import clean_documents, judge, quality_report, repeated_words

SF_DIR = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, source string"


def counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) by a plain walk over characters."""
    text = text or ""
    w = BLANK.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + o for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for o in range(3)}
    lines = [line for line in text.split("\n") if BLANK.search(line)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


PROSE = "The river runs past the old mill, and nobody has counted its stones since {}."
LONG = PROSE.format("spring") + " Then " + " ".join(f"word{i}" for i in range(50)) + "."
LINES = {
    "Home | News | Sport | About": "navigation",
    "Contact us": "navigation",
    "It rained.": None,
    "WIN!! NOW!! BIG!! SUM!!": "punctuation",
    "a### b&&& c$$$": "punctuation",
    "Copyright 2020. All rights reserved.": "boilerplate",
    PROSE.format("then"): None,
    "He asked the clerk what the privacy policy of the old house on the hill might say, and got no answer from them at all.": None,
    "price = 3 | tax = 1, as was agreed upon by the two of them long before the first snow of that year.": None,
}


@pytest.mark.parametrize("line", LINES)
def test_line_rules(line):
    got = judge(f"{LONG}\n{line}\n".encode())
    assert [r for r, n in zip(quality.RULES, got.broken) if n] == [LINES[line]] * (LINES[line] is not None)
    assert got.clean.decode() == (f"{LONG}\n" if LINES[line] else f"{LONG}\n{line}\n")


CASES = [
    (1, None), (2, ""), (3, " \n\t\x0b \n"), (4, LONG), (5, f"{LONG}\n{LONG}"), (6, "\n".join(["Menu item"] * 40) + "\n" + LONG), (7, "a b c " * 60),
    (8, "é" * 5 + " ü  x\x1cy " + LONG), (9, "word " * 200_000), (10, "x" * 500_000 + " " + LONG), (None, LONG), (4, LONG), (4, LONG),
    (11, "\r\n".join(PROSE.format(i) for i in range(9))), (12, "Home | News | Sport | About\n" * 30 + LONG), (13, "no end of a sentence " * 11),
]


def test_counts_match_a_plain_version(spark):
    rng = random.Random(1)
    cases = CASES + [(100 + i, "".join(rng.choice(["a", "b ", "é\n", " ", "| ", "#", "c.\n", "\t"]) for _ in range(rng.randrange(400)))) for i in range(60)]
    df = spark.createDataFrame([(*c, "s") for c in cases], DOCS).repartition(5).selectExpr("*", "1 as n_words", "'x' as __judged")
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_report(df).collect())
    want = Counter()
    for i, text in cases:
        n = counts(text)
        want[(i, *n, n[0] < 50 or 100 * n[4] > 50 * n[0])] += 1
    assert got == want
    assert repeated_words([b"a"] * 3) == 0 and repeated_words([b"a"] * 4) == 4 and repeated_words([]) == 0


def test_matches_sql_on_odd_rows(spark):
    con = check.connect(SF_DIR)
    con.execute("CREATE OR REPLACE TABLE odd (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO odd VALUES (?, ?)", [c for c in CASES if c[0] not in (9, 10)])
    want = con.execute(quality.SQL.replace("FROM documents", "FROM odd"))
    columns = [c[0] for c in want.description]
    df = spark.createDataFrame([(*c, "s") for c in CASES if c[0] not in (9, 10)], DOCS)
    got = quality_report(df)
    assert check.rows_of(got.columns, got.collect()) == check.rows_of(columns, want.fetchall())


def test_matches_sql(spark):
    con = check.connect(SF_DIR)
    query = lambda session, folder: quality_report(session.read.parquet(f"{folder}/documents.parquet"))
    assert check.compare(spark, con, query, quality.SQL, SF_DIR) == ""


def test_verdicts(spark):
    rows = [(1, LONG, "s"), (2, LONG + "\n" + "WIN!! NOW!! BIG!! SUM!!\n" * 40, "s"), (3, LONG + "\nHome | News | Sport | About", "s"), (4, None, "s"), (3, LONG + "\nHome | News | Sport | About", "s")]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "'q' as __judged", "2 as kept_words")
    assert {r.doc_id: r.kept for r in quality_report(df).collect()} == {1: True, 2: False, 3: True, 4: False}
    cleaned = clean_documents(df)
    assert cleaned.columns == df.columns
    assert sorted((r.doc_id, r.text, r.source, r["__judged"], r.kept_words) for r in cleaned.collect()) == [(i, LONG, "s", "q", 2) for i in (1, 3, 3)]
    assert clean_documents(df.limit(0)).count() == 0 and quality_report(df.limit(0)).count() == 0


def test_junk_goes_and_good_text_stays(spark):
    """Against the labels, which no rule has seen: of what the base rules leave."""
    path = SF_DIR.replace("0.01", "0.1")
    labels = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "quality")
    rows = quality_report(spark.read.parquet(f"{path}/documents.parquet")).where("not base_failed").join(labels, "doc_id")
    kept = {r.quality: r.share for r in rows.groupBy("quality").agg({"*": "count", "kept_words": "sum"}).join(
        rows.selectExpr("quality", "cast(kept as int) as k").groupBy("quality").agg({"k": "avg"}).withColumnRenamed("avg(k)", "share"), "quality").collect()}
    assert kept[1] >= 0.99 and kept[0] <= 0.05
