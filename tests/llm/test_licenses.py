import check
import plain
from tokenloom.llm import queries
from tokenloom.llm.licenses import CONTAINMENT, PHRASES, TEMPLATES, scan_licenses

SF_DIR = "/root/testdata/sf0.01"


def brute(text):
    w = plain.plain_words(text)
    places, base = [], set()
    for label, phrase in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        if at:
            base.add(label)
    labels, held = set(base), 0.0
    for line in (text or "").split("\n"):
        have = set(plain.plain_words(line))
        for label, template in TEMPLATES.items():
            want = set(plain.plain_words(template))
            if 100 * len(have & want) >= CONTAINMENT * len(want):
                labels.add(label)
                held = max(held, len(have & want) / len(want))
    ends = (min(places), max(places)) if places else (None, None)
    return (len(w), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else held)


def test_equals_sql(spark):
    name = "op8_license_scan"
    assert check.compare(spark, check.connect(SF_DIR), queries.QUERIES[name], queries.ORACLES[name], SF_DIR) == ""


CASES = [
    (1, None), (2, ""), (3, "Released under the MIT License. Under the MIT license!"), (4, "under the mit\nlicense version"),
    (5, "All rights\nreserved"), (6, "ALL Rights é reserved"), (7, "CC BY-NC-SA, cc by nc cc_by_nc"), (None, "All rights reserved"),
    (8, "this work is licensed under the general public license"), (8, "apache license, VERSION 2"), (8, "apache license, VERSION 2"),
    (9, "x " * 100_000 + "under the mit license " + "y" * 100_000), (10, "gnu general public license version 3 is this work's"), (11, "under"),
    (12, " ".join(TEMPLATES.values()).replace("k", "\u212a")), (13, "under the mit l\u0130cense"),
]


def test_hand_cases(spark):
    docs = spark.createDataFrame([(*c, "x", "y") for c in CASES], "doc_id long, text string, labels string, block string")
    key = lambda rows: sorted(rows, key=repr)
    got = [tuple(r) for r in scan_licenses(docs).collect()]
    assert key(got) == key([(d, *brute(t)) for d, t in CASES])
    assert scan_licenses(docs.where("false")).collect() == []
