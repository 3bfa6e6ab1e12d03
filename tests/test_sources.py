import pytest
from pyspark.sql import functions as F

from tokenloom.functions.tokens import HashTokenizer
from tokenloom.operators.ordering import chunk_by_key, running_totals
from tokenloom.plans import jobs, prepare
from tokenloom.sources import corpus, ledger, token_table
from workload import corpora

DOCS = "doc_id bigint, text string"


def docs(spark, n=40):
    return spark.createDataFrame([(i, f"doc {i} " + "word " * (i % 7)) for i in range(n)], DOCS)


def test_parquet_wins_over_jsonl(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        corpus.read_corpus(spark, path, "text")
    (tmp_path / "x.jsonl").write_text('{"doc_id": 1, "text": "from json"}\n')
    with pytest.raises(ValueError, match="schema"):
        corpus.read_corpus(spark, path, "text")
    assert corpus.read_corpus(spark, path, "text", schema=DOCS).first().text == "from json"
    docs(spark, 3).coalesce(1).write.mode("append").parquet(path)
    assert corpus.read_corpus(spark, path, "doc_id").count() == 3


def test_only_named_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "c")
    docs(spark).write.parquet(path)
    plan = corpus.read_corpus(spark, path, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_file_order_spans_files(spark, tmp_path):
    path = str(tmp_path / "c")
    docs(spark).repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    rows = corpus.with_file_order(spark.read.parquet(path), rows_per_chunk=4)
    placed = running_totals(
        rows, group=[], chunk=["chunk_hi", "chunk"], order=["row"], totals={"position": F.lit(1)}
    ).collect()
    assert sorted(r.position for r in placed) == list(range(40))
    ordered = [r.file for r in sorted(placed, key=lambda r: r.position)]
    assert ordered == sorted(ordered)
    for name in set(ordered):
        inside = [r.row for r in sorted(placed, key=lambda r: r.position) if r.file == name]
        assert inside == list(range(len(inside)))


def test_shards_exceed_the_target_by_one_row_at_most(spark):
    df = chunk_by_key(docs(spark).withColumn("dataset", F.lit("d")), "doc_id", 4, 2)
    size = corpus.string_bytes(docs(spark))
    rows = corpus.assign_shards(df, order=["doc_id"], size=size, target_bytes=100).collect()
    by_shard = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        by_shard.setdefault(r.shard, []).append(r.bytes)
    assert list(by_shard) == sorted(by_shard)
    assert all(sum(sizes[:-1]) < 100 for sizes in by_shard.values())
    assert sum(map(len, by_shard.values())) == 40


def test_even_shards_with_fewer_rows_than_shards(spark):
    df = chunk_by_key(docs(spark, 3).withColumn("dataset", F.lit("d")), "doc_id", 4, 2)
    rows = corpus.assign_even_shards(df, order=["doc_id"], size=F.lit(1000), target_bytes=500)
    assert sorted(r.shard for r in rows.collect()) == [0, 1, 2]


def test_cap_none_keeps_all(spark):
    df = docs(spark)
    assert corpus.cap_samples(df, None, order=["doc_id"]) is df


def test_token_table_round_trip_and_errors(spark, tmp_path):
    path, log = str(tmp_path / "tokens"), str(tmp_path / "ledger")
    stats = prepare.prepare_corpus(docs(spark), name="a", key="doc_id", target=path, ledger=log, max_samples=11).first()
    assert (stats.num_sequences, stats.width, stats.add_eos) == (11, 2, True)
    prepare.prepare_corpus(docs(spark, 5), name="b b", key="doc_id", target=path, ledger=log)
    tokens = token_table.read_tokens(spark, path, ["a", "b b"])
    assert {r.dataset: r.n for r in tokens.groupBy("dataset").agg(F.count("*").alias("n")).collect()} == {"a": 11, "b b": 5}
    want = [r.ids for r in docs(spark, 5).orderBy("doc_id").select(HashTokenizer().ids(F.col("text")).alias("ids")).collect()]
    assert [r.tokens for r in tokens.where("dataset = 'b b'").orderBy("seq_id").collect()] == want
    assert sorted(r["name"] for r in ledger.read_ledger(spark, log).collect()) == ["a", "b b"]
    with pytest.raises(FileNotFoundError, match="zzz"):
        token_table.read_tokens(spark, path, ["a", "zzz"])
    docs(spark).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="no column"):
        token_table.read_tokens(spark, str(tmp_path / "other"))


def test_token_table_prunes_to_its_dataset(spark, tmp_path):
    path, log = str(tmp_path / "tokens"), str(tmp_path / "ledger")
    for name in ("a", "b"):
        prepare.prepare_corpus(docs(spark), name=name, key="doc_id", target=path, ledger=log)
    one = token_table.read_tokens(spark, path, ["a"]).where("seq_id = 3")
    assert one.inputFiles() and all("/dataset=a/" in f for f in one.inputFiles())
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(seq_id,3)" in plan
    plan = token_table.read_tokens(spark, path).where("dataset = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan


SETTINGS = {
    "tokenizer": "hash",
    "datasets": [
        {"dataset": "Org/Data One", "subset": "Part", "max_samples": 5},
        {"dataset": "Org/Two", "name": "two", "split": "test", "streaming": False},
        {"dataset": "Org/Three", "preprocess": "flatten_messages", "text_column": "messages"},
    ],
}


def test_plan_fills_defaults_and_skips_what_is_done(spark, tmp_path):
    entries = jobs.fill_defaults(jobs.job_entries(spark, SETTINGS), SETTINGS, {"add_bos": True})
    log = str(tmp_path / "ledger")
    todo = {r["name"]: r for r in jobs.plan(entries, ledger.read_ledger(spark, log), jobs.DOWNLOAD).collect()}
    assert sorted(todo) == ["data-one-part", "three", "two"]
    one = todo["data-one-part"]
    assert (one.split, one.text_column, one.limit, one["mode"], one.raw_dir) == (
        "train", "text", "max=5", "streaming", "Org__Data One__Part__train"
    )
    assert (todo["two"].split, todo["two"]["mode"], todo["two"].limit) == ("test", "full", "all")
    assert todo["three"].preprocess == "flatten_messages" and one.add_bos and one.add_eos

    assert jobs.plan(entries, ledger.read_ledger(spark, log), jobs.TOKENIZE).count() == 0
    ledger.mark_done(spark.createDataFrame([("two", "p")], "name string, path string"), log, jobs.DOWNLOAD)
    marks = ledger.read_ledger(spark, log)
    assert sorted(r["name"] for r in jobs.plan(entries, marks, jobs.DOWNLOAD).collect()) == ["data-one-part", "three"]
    assert [r["name"] for r in jobs.plan(entries, marks, jobs.TOKENIZE).collect()] == ["two"]


def test_selecting_unknown_names_lists_the_known(spark):
    entries = jobs.fill_defaults(jobs.job_entries(spark, SETTINGS))
    assert [r["name"] for r in jobs.select_datasets(entries, ["two"]).collect()] == ["two"]
    with pytest.raises(ValueError, match="unknown names: nope; available: data-one-part, three, two"):
        jobs.select_datasets(entries, ["two", "nope"])


def test_job_settings_are_checked(spark):
    for broken in ({}, {"datasets": []}, {"datasets": [{"split": "train"}]}):
        with pytest.raises(ValueError):
            jobs.job_entries(spark, broken)


def test_a_job_that_died_before_its_mark_can_run_again(spark, tmp_path):
    from tokenloom.plans.prepare import prepare_corpus

    target, ledger_path = str(tmp_path / "tokens"), str(tmp_path / "ledger")
    for name, text in (("a", "x y"), ("b", "z"), ("a", "x y")):  # the second "a" is the re-run
        raw = spark.createDataFrame([(i, text) for i in range(5)], "id long, text string")
        prepare_corpus(raw, name=name, target=target, ledger=ledger_path, key="id")
    counts = token_table.read_tokens(spark, target).groupBy("dataset").count().collect()
    assert {r["dataset"]: r["count"] for r in counts} == {"a": 5, "b": 5}


def test_lines_of_split_files_keep_their_order(spark, tmp_path):
    """Files cut into many splits: the order is file by file, line by line."""
    want = []
    for name in ("a", "b", "c"):
        lines = [f'{{"doc_id": {len(want) + i}, "text": "{name}{i} {"x" * (i % 37)}"}}' for i in range(400)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
        want += [f"{name}{i}" for i in range(400)]
    (tmp_path / "other.json").write_text('{"doc_id": -1, "text": "no lines"}\n')
    for setting, value in (("spark.sql.files.maxPartitionBytes", "3000"), ("spark.sql.files.openCostInBytes", "0")):
        spark.conf.set(setting, value)
    try:
        rows = corpus.read_corpus(spark, str(tmp_path), schema=DOCS)
        assert rows.rdd.getNumPartitions() > 15
        placed = corpus.with_line_order(rows)
    finally:
        for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.unset(setting)
    got = sorted((r.row, r.doc_id, r.text.split()[0]) for r in placed.collect())
    assert got == [(i, i, w) for i, w in enumerate(want)]
    capped = corpus.cap_samples(placed, 450, order=["row"], group=[])
    assert sorted(r.doc_id for r in capped.collect()) == list(range(450))


def test_a_jsonl_dataset_goes_through_both_jobs(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    for name in ("b", "a"):
        (source / f"{name}.jsonl").write_text("".join(f'{{"text": "{name} {"w " * i}", "n": {i}}}\n' for i in range(20)))
    log = str(tmp_path / "ledger")
    prepare.ingest_corpus(spark, str(source), str(tmp_path / "raw"), name="x", ledger=log, max_samples=30, target_bytes=100)
    for raw, wanted in ((tmp_path / "raw", 30), (source, 40)):
        target = str(tmp_path / f"tokens{wanted}")
        prepare.prepare_corpus(prepare.read_ordered(spark, str(raw)), name="x", target=target, ledger=log)
        sizes = [r.num_tokens for r in token_table.read_tokens(spark, target).orderBy("seq_id").collect()]
        assert sizes == [i + 2 for _ in "ab" for i in range(20)][:wanted]


def test_shards_can_be_written_again_after_a_crash(spark, tmp_path):
    path = str(tmp_path / "shards")
    df = docs(spark, 12).withColumn("shard", F.col("doc_id") % 3)
    corpus.write_shards(df, path, order=["doc_id"], columns=["doc_id"], group=[])
    with pytest.raises(Exception, match="exists"):
        corpus.write_shards(df, path, order=["doc_id"], columns=["doc_id"], group=[])
    corpus.write_shards(df.where("shard < 2"), path, order=["doc_id"], columns=["doc_id"], group=[], mode="overwrite")
    assert sorted(r.doc_id for r in spark.read.parquet(path).collect()) == [i for i in range(12) if i % 3 < 2]


class Killed(Exception):
    pass


def killed(*args, **kwargs):
    raise Killed


@pytest.mark.parametrize("at", ["write", "publish", "mark"])
def test_a_killed_tokenize_leaves_the_old_table_or_the_new(spark, tmp_path, monkeypatch, at):
    target, log = str(tmp_path / "tokens"), str(tmp_path / "ledger")
    job = dict(key="doc_id", target=target, ledger=log)
    for name in ("x", "y"):
        prepare.prepare_corpus(docs(spark, 5), name=name, **job)

    def rows():
        return {r.dataset: r.n for r in token_table.read_tokens(spark, target).groupBy("dataset").agg(F.count("*").alias("n")).collect()}

    where = {"write": (token_table, "write_tokens"), "publish": (token_table, "publish"), "mark": (prepare, "mark_done")}[at]
    with monkeypatch.context() as patch:
        patch.setattr(*where, killed)
        with pytest.raises(Killed):
            prepare.prepare_corpus(docs(spark, 9), name="x", **job)
    assert rows() == {"x": 9 if at == "mark" else 5, "y": 5}
    prepare.prepare_corpus(docs(spark, 9), name="x", **job)
    assert rows() == {"x": 9, "y": 5}


@pytest.mark.parametrize("at", ["write_shards", "publish", "mark_done"])
def test_a_killed_ingest_leaves_the_old_shards_or_the_new(spark, tmp_path, monkeypatch, at):
    source, target, log = (str(tmp_path / n) for n in ("in", "raw", "ledger"))
    docs(spark, 6).coalesce(1).write.parquet(source)
    job = dict(name="x", ledger=log, streaming=False, target_bytes=30)
    prepare.ingest_corpus(spark, source, target, **job)
    docs(spark, 10).where("doc_id >= 6").coalesce(1).write.mode("append").parquet(source)
    with monkeypatch.context() as patch:
        patch.setattr(prepare, at, killed)
        with pytest.raises(Killed):
            prepare.ingest_corpus(spark, source, target, **job)
    assert prepare.read_ordered(spark, target).count() == (10 if at == "mark_done" else 6)
    prepare.ingest_corpus(spark, source, target, **job)
    assert sorted(r.doc_id for r in prepare.read_ordered(spark, target).collect()) == list(range(10))


def test_tasks_of_a_spread_table_follow_its_size(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    docs(spark, 400).coalesce(1).write.parquet(path)
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert corpus.spread(table, "doc_id").rdd.getNumPartitions() == cores
    monkeypatch.setattr(corpus, "SPREAD_BYTES", max(1, corpus.scan_bytes(table) // (3 * cores)))
    spread = corpus.spread(table, "doc_id")
    assert spread.rdd.getNumPartitions() >= 3 * cores
    assert sorted(spread.collect()) == sorted(table.collect())


def test_files_of_a_delivery_follow_its_size(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    size = corpus.scan_bytes(table)
    assert corpora._delivered(table, size).rdd.getNumPartitions() == corpora.FILES
    usual = sorted(corpora.jsonl_line_order(spark, folder).collect())
    monkeypatch.setattr(corpora, "FILE_BYTES", size // 12)
    assert corpora._delivered(table, size).rdd.getNumPartitions() >= 12
    assert sorted(corpora.jsonl_line_order(spark, folder).collect()) == usual
