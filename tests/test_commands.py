import pytest
from pyspark.sql import functions as F

from tokenloom import __main__ as commands
from tokenloom.plans import prepare, sweep
from tokenloom.plans.jobs import DOWNLOAD, TOKENIZE
from tokenloom.sources.ledger import read_ledger
from tokenloom.sources.token_table import read_tokens


@pytest.fixture
def home(spark, tmp_path):
    rows = [(f"doc {i} " + "word " * (i % 5), [("user", f" hi {i} "), ("bot", "")]) for i in range(60)]
    df = spark.createDataFrame(rows, "text string, messages array<struct<role: string, content: string>>")
    df.coalesce(1).write.parquet(f"{tmp_path}/source/org/texts/train")
    df.coalesce(1).write.parquet(f"{tmp_path}/source/org/chats/train")
    return tmp_path


def settings(home):
    return {
        "source_dir": f"{home}/source",
        "input_dir": f"{home}/raw",
        "output_dir": f"{home}/tokens",
        "ledger": f"{home}/ledger",
        "datasets": [
            {"dataset": "org/texts", "name": "texts", "max_samples": 25},
            {"dataset": "org/chats", "name": "chats", "text_column": "messages", "preprocess": "flatten_messages"},
            {"dataset": "org/texts", "name": "all", "raw_dir": "all_texts", "streaming": False},
        ],
    }


def test_download_tokenize_and_mix(spark, home, capsys):
    import yaml

    jobs = home / "jobs.yaml"
    jobs.write_text(yaml.safe_dump(settings(home)))
    commands.main(["tokenize", "--config", str(jobs)])
    assert not (home / "tokens").exists()

    commands.main(["download", "--config", str(jobs), "--dry-run"])
    assert not (home / "raw").exists() and "max=25" in capsys.readouterr().out
    commands.main(["download", "--config", str(jobs)])
    commands.main(["tokenize", "--config", str(jobs)])
    tokens = read_tokens(spark, f"{home}/tokens", ["texts", "chats", "all"])
    counts = {r.dataset: r.n for r in tokens.groupBy("dataset").agg(F.count("*").alias("n")).collect()}
    assert counts == {"texts": 25, "chats": 60, "all": 60}
    first = {r.dataset: r.num_tokens for r in tokens.where("seq_id = 7").collect()}
    assert first == {"texts": 5, "chats": 3, "all": 5}
    again = prepare.run_jobs(spark, settings(home), TOKENIZE)
    assert again.count() == 0 and prepare.run_jobs(spark, settings(home), DOWNLOAD).count() == 0

    mix = home / "mix.yaml"
    entries = [{"path": f"{home}/tokens/texts", "weight": 3}, {"path": f"{home}/tokens/chats"}]
    mix.write_text(yaml.safe_dump({"seq_len": 6, "datasets": entries}))
    capsys.readouterr()
    commands.main(["validate-mix", str(mix), "--tokens", f"{home}/tokens"])
    assert "TOTAL" in capsys.readouterr().out
    feed = ["feed", str(mix), "--tokens", f"{home}/tokens", "--output", f"{home}/feed"]
    commands.main([*feed, "--draws", "20", "--workers", "2", "--skip", "3", "--batch-size", "4"])
    samples = spark.read.parquet(f"{home}/feed")
    assert samples.count() == 2 * 16
    assert samples.where((F.size("input_ids") != 6) | (F.size("labels") != 6)).count() == 0


def test_capped_rows_keep_file_order(spark, home):
    prepare.ingest_corpus(
        spark, f"{home}/source/org/texts/train", f"{home}/raw/x", name="x", ledger=f"{home}/ledger",
        max_samples=31, target_bytes=90,
    )
    raw = spark.read.parquet(f"{home}/raw/x")
    assert raw.columns == ["text", "messages", "batch", "shard"] and raw.select("shard").distinct().count() > 3
    prepare.prepare_corpus(raw, name="x", target=f"{home}/tokens", ledger=f"{home}/ledger")
    got = [r.num_tokens for r in read_tokens(spark, f"{home}/tokens").orderBy("seq_id").collect()]
    assert got == [i % 5 + 3 for i in range(31)]


def test_download_goes_on_to_tokenize_unless_told_not_to(spark, home):
    import yaml

    jobs = home / "jobs.yaml"
    jobs.write_text(yaml.safe_dump(settings(home)))
    folders = ["--output-dir", f"{home}/elsewhere", "--tokenized-dir", f"{home}/ids"]
    commands.main(["download", "--config", str(jobs), "--only", "all", "--no-tokenize", "--streaming", *folders])
    assert spark.read.parquet(f"{home}/elsewhere/all_texts").count() == 60
    assert (home / "elsewhere" / "all_texts" / "_progress").exists() and not (home / "ids").exists()
    commands.main(["tokenize", "--config", str(jobs), "--input-dir", f"{home}/elsewhere", "--output-dir", f"{home}/ids", "--max-seq-length", "4"])
    assert {r.num_tokens for r in read_tokens(spark, f"{home}/ids", ["all"]).collect()} == {3, 4, 5}
    commands.main(["download", "--config", str(jobs), "--only", "texts", "--max-samples", "7", "--no-streaming", *folders])
    assert read_tokens(spark, f"{home}/ids", ["texts"]).count() == 7
    assert not (home / "raw").exists()


def test_a_failing_dataset_does_not_stop_the_others(spark, home):
    broken = settings(home)
    broken["datasets"].insert(0, {"dataset": "org/none", "name": "none"})
    with pytest.raises(Exception, match="(?i)path.*does not exist|path_not_found"):
        prepare.run_jobs(spark, broken, DOWNLOAD)
    done = {(r.stage, r["name"]) for r in read_ledger(spark, f"{home}/ledger").collect()}
    assert done == {(DOWNLOAD, n) for n in ("texts", "chats", "all")}
    prepare.run_jobs(spark, settings(home), TOKENIZE, parallel=1)
    assert read_tokens(spark, f"{home}/tokens", ["texts", "chats", "all"]).count() == 25 + 60 + 60


def test_which_checkpoints_to_evaluate(spark, home):
    for name in ("step_1", "step_2", "checkpoint-10", "notes"):
        (home / "runs" / name).mkdir(parents=True)
    (home / "runs" / "step_99").write_text("a plain file")
    (home / "evals" / "step_2").mkdir(parents=True)
    (home / "evals" / "step_2" / "results_1.json").write_text("{}")
    output = f"{home}/evals"

    def pending(settings, **more):
        return [(r.name, r.results.removeprefix(f"{home}/")) for r in sweep.pending_checkpoints(spark, {"output_dir": output} | settings, **more).collect()]

    folder = {"checkpoint_dir": f"{home}/runs"}
    assert pending(folder) == [("step_1", "evals/step_1"), ("checkpoint-10", "evals/checkpoint-10")]
    assert pending(folder | {"last": 2}) == [("checkpoint-10", "evals/checkpoint-10")]
    assert [n for n, _ in pending(folder, force=True)] == ["step_1", "step_2", "checkpoint-10"]
    assert pending(folder | {"checkpoints": ["x/b", "x/step_2", "x/a/"]}) == [("b", "evals/b"), ("a", "evals/a")]
    assert pending({"model": "org/m"}) == [("m", "evals")]
    assert pending({"model": "org/m"}, model="org/other") == [("other", "evals")]
    assert pending(folder, model="org/other") == [("other", "evals/other")]
    (home / "evals" / "results_2.json").write_text("{}")
    assert pending({"model": "org/m"}) == []
    with pytest.raises(ValueError, match="name no model"):
        pending({})
    with pytest.raises(ValueError, match="no step_N"):
        pending({"checkpoint_dir": f"{home}/evals/step_2"})


def test_pending_evals_command(home, capsys):
    for name in ("step_1", "step_2", "step_10"):
        (home / "runs" / name).mkdir(parents=True)
    (home / "evals" / "step_10").mkdir(parents=True)
    (home / "evals" / "step_10" / "results_1.json").write_text("{}")
    commands.main(["pending-evals", f"{home}/runs", "--results", f"{home}/evals", "--last", "2"])
    out = capsys.readouterr().out
    assert "step_2" in out and "step_1 " not in out and "step_10" not in out
