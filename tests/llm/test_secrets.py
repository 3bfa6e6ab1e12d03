import hashlib
import random

from pyspark.sql import functions as F
from tokenloom.llm.secrets import candidates, scan_secrets

SF_DIR = "/root/testdata/sf0.001"
KEY = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
SCHEMA = "doc_id long, text string, source string, start int, value string, label string, score double"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "v", "l", 0.5) for r in rows], SCHEMA)


def test_held_out_findings(spark):
    rng = random.Random(2)
    rows, real = [], set()
    for k in range(600):
        value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        kind = k % 4
        if kind == 0:
            rows.append((k, f'some words here token = "{value}" and more', f"src{k % 7}"))
            real.add(hashlib.sha256(value.encode()).hexdigest())
        elif kind == 1:
            rows.append((k, f"the number {rng.randrange(10**17, 10**18)} in a row", f"src{k % 7}"))
        elif kind == 2:
            rows.append((k, f"see mail{k}.some.example.com for it", f"src{k % 7}"))
        else:
            rows.append((k, f'dummy token = "{value}" for a test', f"src{k % 7}"))
    found = scan_secrets(docs(spark, rows)).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 600 and len(held) > 60
    assert sum(r.is_secret == (r.sha256 in real) for r in held) / len(held) > 0.95


def test_reviewed_labels_decide(spark):
    rows = [(k, f"token: {k:04d}abcdef{k:04d}abcdef{k:04d} end", "a") for k in range(200)]
    rows += [(k, f"build-{k:04d}-release-{k:04d}-final end", "a") for k in range(200, 400)]
    table = docs(spark, rows)
    labelled = candidates(table, frozenset()).select("id", "start", F.expr("id < 200").cast("int").alias("label"))
    found = scan_secrets(table, labelled).collect()
    assert len(found) == 400 and all(r.is_secret == (r.doc_id < 200) for r in found)


CASES = [
    (1, None, None), (2, "", ""), (3, f'token = "{KEY}"', "a/b"), (3, f'token = "{KEY}"', "a/b"), (None, f"key: {KEY}.", "x"),
    (4, "é" * 30 + f" password={KEY}\n" + "w " * 100_000, "x"), (5, "1" * 200_000, "x"), (6, "abcdefghijklmnopqrstuvwxyz", "x"),
]


def test_hand_cases(spark):
    found = scan_secrets(docs(spark, CASES)).collect()
    digest = hashlib.sha256(KEY.encode()).hexdigest()
    assert sorted((str(r.doc_id), r.start, r.length) for r in found) == [("3", 9, 40), ("3", 9, 40), ("4", 31, 49), ("5", 0, 200_000), ("None", 5, 40)]
    assert sum(r.sha256 == digest for r in found) == 3
    assert scan_secrets(docs(spark, CASES).where("false")).collect() == []


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    found = scan_secrets(table).collect()
    assert found
    for r in found:
        assert hashlib.sha256(texts[r.doc_id][r.start : r.start + r.length].encode()).hexdigest() == r.sha256
