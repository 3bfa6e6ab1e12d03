import corpus_pipeline
import plain
import pytest
import test_line_dedup
import test_ngram_join
from tokenloom.functions.tokens import HashTokenizer
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    frames = list(stages.values())
    assert all(after.columns == before.columns for before, after in frames[:-1])


def test_toxicity_keeps_clean_documents(stages, spark):
    before, after = stages["toxicity"]
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 1").collect()}
    gone = set(texts(before)) - set(texts(after))
    labelled = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert gone and len(gone & labelled - toxic) <= 2


def test_lines(stages):
    before, after = stages["line_dedup"]
    gone = test_line_dedup.brute([(r.doc_id, r.text) for r in before.collect()])
    want = {}
    for r in before.collect():
        drop = set(gone.get((r.doc_id, r.text), ()))
        text = "\n".join(line for no, line in enumerate(r.text.split("\n")) if no not in drop)
        if not drop or text.strip():
            want[r.doc_id] = text
    assert texts(after) == want
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_duplicates(stages):
    before, after = stages["ngram_jaccard_join"]
    rows = test_ngram_join.brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert set(texts(after)) == {int(doc) for doc, _, component in rows if doc == component}


def test_decontamination(stages, spark):
    before, after = stages["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = plain.contamination([(r.doc_id, r.text) for r in before.collect()], items)
    assert texts(after) == {d: t for d, t in texts(before).items() if not want[d][4]}


def test_packing_places_every_token(stages):
    before, after = stages["best_fit_packing"]
    sizes = {r.doc_id: r.n for r in before.select("doc_id", HashTokenizer().count(F.col("text")).alias("n")).collect()}
    assert {r.doc_id: r.n for r in after.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()} == sizes


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.collect() == []
