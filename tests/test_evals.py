import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tokenloom.functions import scoring as score, tasks
from tokenloom.operators import evalsets, runs, scoring
from tokenloom.plans import sweep


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def text(s):
    return F.lit(s).cast("string")


@pytest.mark.parametrize(
    "rule, answer, want",
    [
        ("digit_or_letter", "1", 0), ("digit_or_letter", "3", 2), ("digit_or_letter", "B", 1),
        ("letter", "C", 2), ("label", " B ", 1), ("index", "2", 2), ("one_based", "2", 1),
        ("boolean", "true", 0), ("boolean", "false", 1),
    ],
)
def test_answer_rules(spark, rule, answer, want):
    labels = F.array(F.lit("A"), F.lit("B"), F.lit("C"))
    assert value(spark, evalsets.ANSWER_RULES[rule](text(answer), labels)) == want


@pytest.mark.parametrize("answer", ["5", "Z", None])
def test_an_answer_that_is_no_choice_fails(spark, answer):
    df = spark.createDataFrame([("q", (["w", "x"], ["A", "B"]), answer)],
                               "question string, choices struct<text: array<string>, label: array<string>>, answerKey string")
    with pytest.raises(Exception, match="arc: answer out of range"):
        evalsets.normalize_mcq(df, evalsets.MCQ_SPECS["arc"]).collect()


def test_prompts(spark):
    assert value(spark, evalsets.bbh_prompt(F.lit("why?"))) == "Question: why?\nAnswer: "
    prompt = value(spark, evalsets.math_prompt(F.lit("1+1?")))
    assert "$\\boxed{ANSWER}$" in prompt and prompt.endswith("before answering.\n\n1+1?")


def test_scorable_rows_keep_null_kinds(spark):
    df = spark.createDataFrame([("critical thinking",), (None,), ("rewording",)], "perturbation_type string")
    assert sorted(str(r[0]) for r in evalsets.keep_scorable(df).collect()) == ["None", "rewording"]


def test_few_shot(spark):
    pool = spark.createDataFrame([(t, i, f"{t}{i}") for t in "xy" for i in range(9)], "task string, id int, e string")
    fixed = evalsets.few_shot(pool, 2, group=["task"], order=["id"], example=F.col("e"))
    assert {r.task: r.shots for r in fixed.collect()} == {"x": ["x0", "x1"], "y": ["y0", "y1"]}
    def seeded(seed):
        rows = evalsets.few_shot(pool, 3, group=["task"], order=["id"], example=F.col("e"), seed=seed).collect()
        return {r.task: r.shots for r in rows}

    assert seeded(1) == seeded(1) != seeded(2)
    asked = spark.createDataFrame([("x", "q1"), ("z", "q2")], "task string, q string")
    shown = evalsets.with_few_shot(asked, fixed, ["task"]).select(
        evalsets.few_shot_prompt(F.col("shots"), F.col("q")).alias("p")
    )
    assert sorted(r.p for r in shown.collect()) == ["q2", "x0\n\nx1\n\nq1"]


def test_few_shot_limits_before_the_exchange(spark):
    pool = spark.range(100).select((F.col("id") % 2).alias("task"), "id", F.col("id").cast("string").alias("e"))
    plan = evalsets.few_shot(pool, 2, group=["task"], order=["id"], example=F.col("e"))
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_registry(spark):
    registry = tasks.task_registry(spark)
    rows = {r.task: r for r in registry.collect()}
    assert len(rows) == registry.count() == 240
    assert rows["arc_cf:easy"].subset == "ARC-Easy" and rows["mmlu_hybrid:virology"].few_shot_split == "dev"
    assert rows["boolq_cf"].generation_size == 5 and rows["gsm8k"].stop == ["Question:"]
    asked = spark.createDataFrame([("custom|mmlu_cf|0|1",), ("custom|arc_cf:easy|5|1",)], "request string")
    found = tasks.requested_tasks(asked, registry).collect()
    assert len(found) == 58 and {r.num_shots for r in found} == {0, 5}


def test_pmi_metrics_go(spark):
    metrics = F.array(
        F.struct(F.lit("a").alias("name"), F.lit("MULTICHOICE_PMI").alias("category")),
        F.struct(F.lit("b").alias("name"), F.lit("GENERATIVE").alias("category")),
    )
    assert [m.name for m in value(spark, tasks.drop_pmi_metrics(metrics))] == ["b"]


def test_best_choice(spark):
    logprobs, lengths = F.array(*map(F.lit, (-4.0, -3.0, -9.0))), F.array(*map(F.lit, (4.0, 1.0, 9.0)))
    assert value(spark, score.best_choice(logprobs)) == 1
    assert value(spark, score.best_choice(logprobs, lengths)) == 0


@pytest.mark.parametrize(
    "prediction, gold, exact, quasi",
    [(" x\n", "x", 1, 1), ("The  Cat!", "a cat", 0, 1), ("the", "", 0, 1), ("cat", "dog", 0, 0), ("a theory", "theory", 0, 1)],
)
def test_matches(spark, prediction, gold, exact, quasi):
    assert value(spark, score.exact_match(text(prediction), text(gold))) == exact
    assert value(spark, score.quasi_exact_match(text(prediction), text(gold))) == quasi


def test_numbers_and_boxes(spark):
    assert value(spark, score.last_number(text("from 3 to 1,234.50!"))) == 1234.5
    assert value(spark, score.last_number(text("none"))) is None
    assert value(spark, score.numeric_match(text("so -7."), text("#### -7"))) == 1
    assert value(spark, score.numeric_match(text("no idea"), text("7"))) == 0
    assert value(spark, score.boxed_answer(text(r"\boxed{1} then \boxed{ x+1 }"))) == " x+1 "
    assert value(spark, score.boxed_match(text(r"is \boxed{2.0}"), text("2"))) == 1
    assert value(spark, score.boxed_match(text(r"is \boxed{x}"), text(" x"))) == 1
    assert value(spark, score.boxed_match(text("is 2"), text("2"))) == 0


def plain_box(t):
    """Every box by walking to its brace; the one that closes last."""
    found = []
    for i in range(len(t)):
        depth = 1
        for j in range(i + 7, len(t) if t.startswith("\\boxed{", i) else 0):
            depth += (t[j] == "{") - (t[j] == "}")
            if not depth:
                found.append((j, t[i + 7 : j]))
                break
    return max(found)[1] if found else None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["{", "}", "\\boxed{", "a", "é ", "}"]), max_size=12).map("".join), min_size=20, max_size=40))
def test_boxes_match_a_plain_walk(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.b for r in rows.select(score.boxed_answer(F.col("t")).alias("b")).collect()] == [plain_box(t) for t in texts]


def test_long_and_deep_answers(spark):
    """Bad output may be long: nothing here may recurse or take more than linear time."""
    deep = "{" * 50 + "x" + "}" * 50
    cases = {
        "long": ("\\boxed{" + "b" * 100_000 + "} rest" + " c" * 50_000, "b" * 100_000),
        "deep": ("\\boxed{" + deep + "}", deep),
        "pairs": ("\\boxed{" + "{}" * 50_000 + "}", "{}" * 50_000),
        "open": ("\\boxed{" * 1_000, None),
        "second open": ("\\boxed{1} and \\boxed{2", "1"),
        "missing": (None, None),
    }
    rows = spark.createDataFrame([(k, t) for k, (t, _) in cases.items()], "k string, t string")
    assert {r.k: r.b for r in rows.select("k", score.boxed_answer(F.col("t")).alias("b")).collect()} == {k: w for k, (_, w) in cases.items()}
    articles = spark.createDataFrame([("the a " * 50_000 + "Cat, a\n",), ("an" + " a" * 100_000,)], "t string")
    assert [r.n for r in articles.select(score.normalize_answer(F.col("t")).alias("n")).collect()] == ["cat", ""]


def test_clean_prediction(spark):
    response = "<think>a\nb</think>  hello <think>c</think>\n"
    assert value(spark, score.clean_prediction(text(response), F.lit(10))) == "hello"
    long = "é" * 9000 + "end"
    assert value(spark, score.clean_prediction(text(long), F.lit(2049))) == long[-8192:]
    assert value(spark, score.clean_prediction(text(long), F.lit(2048))) == long


def softmax(xs, t=1.0):
    top = max(xs) / t
    total = sum(math.exp(x / t - top) for x in xs)
    return [x / t - top - math.log(total) for x in xs]


def test_logits(spark):
    student, teacher, t = [1.0, 900.0, 2.0], [3.0, 890.0, 1.0], 2.0
    s, q = (F.array(*map(F.lit, xs)) for xs in (student, teacher))
    assert value(spark, score.log_softmax(s, t)) == pytest.approx(softmax(student, t))
    want = sum(math.exp(a) * (a - b) for a, b in zip(softmax(student, t), softmax(teacher, t)))
    assert value(spark, score.row_reverse_kl(score.log_softmax(s, t), score.log_softmax(q, t))) == pytest.approx(want)
    assert value(spark, score.row_cross_entropy(score.log_softmax(s), F.lit(0))) == pytest.approx(899.0)
    assert value(spark, score.row_cross_entropy(score.log_softmax(s), F.lit(-100))) is None


def test_distill_losses(spark):
    rows = [(0, 0, [1.0, 2.0], [2.0, 1.0], 0), (0, 0, [0.0, 1.0], [0.0, 0.0], -100), (0, 1, [3.0, 1.0], [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "step int, micro int, s array<double>, t array<double>, label int")
    got = scoring.distill_losses(
        df, student="s", teacher="t", label="label", temperature=2.0, alpha=0.25, step="step", micro_step="micro"
    ).first()

    def kl(s, q):
        return 4 * sum(math.exp(a) * (a - b) for a, b in zip(softmax(s, 2.0), softmax(q, 2.0)))

    ce = [-softmax(rows[0][2])[0], -softmax(rows[2][2])[1]]
    distill = [(kl(*rows[0][2:4]) + kl(*rows[1][2:4])) / 2, kl(*rows[2][2:4])]
    assert (got.ce, got.distill) == (pytest.approx(sum(ce) / 2), pytest.approx(sum(distill) / 2))
    assert got.loss == pytest.approx(0.25 * got.ce + 0.75 * got.distill)
    with pytest.raises(ValueError, match="reverse_kl"):
        scoring.distill_losses(df, student="s", teacher="t", label="label", temperature=1.0, alpha=1.0,
                               step="step", micro_step="micro", loss="forward")


def test_log_softmax_works_once_per_row(spark):
    """A shift computed inside the element lambda would make this quadratic."""
    wide = spark.range(200).select(F.transform(F.sequence(F.lit(1), F.lit(5000)), lambda x: x * 1.0).alias("x"))
    total = wide.select(F.aggregate(score.log_softmax(F.col("x")), F.lit(0.0), lambda a, v: a + F.exp(v)).alias("m"))
    assert total.agg(F.avg("m")).first()[0] == pytest.approx(1.0)


def test_judge_scores(spark):
    df = spark.createDataFrame([("a", 5, True), ("a", 1, True), ("b", 1, False)], "t string, s int, free boolean")
    got = {r.t: r.judge_score for r in scoring.judge_score_mean(df, ["t"], score="s", freeform=F.col("free")).collect()}
    assert got == {"a": pytest.approx(0.6), "b": 1.0}


def test_checkpoints_in_numeric_order(spark):
    names = ["step_9", "step_10", "checkpoint-2", "tmp", "step_", "xstep_3", "step_7.bak"]
    df = spark.createDataFrame([(n, f"r/{n}") for n in names], "name string, path string")
    assert [r.step for r in runs.list_checkpoints(df, 2).collect()] == [10, 9]
    assert sorted(r.step for r in runs.list_checkpoints(df).collect()) == [2, 9, 10]
    results = spark.createDataFrame([("r/step_10",)], "path string")
    assert [r.name for r in sweep.plan_sweep(df, results, last=2).collect()] == ["step_9"]
    assert [r.name for r in sweep.plan_sweep(df, results, last=2, force=True).collect()] == ["step_9", "step_10"]
    exits = spark.createDataFrame([("r/step_9", 0), ("r/checkpoint-2", 1)], "path string, exit_code int")
    row = sweep.report_sweep(runs.list_checkpoints(df), exits).first()
    assert (row.num_checkpoints, row.num_done, row.num_failed, row.failed) == (3, 2, 1, ["r/checkpoint-2"])


def test_folder_listing(spark, tmp_path):
    for name in ("step_3", "step_20", "logs"):
        (tmp_path / name).mkdir()
    listing = sweep.folder_listing(spark, str(tmp_path))
    assert [r.step for r in runs.list_checkpoints(listing, 5).collect()] == [20, 3]


def test_bad_answers_and_missing_outputs(spark):
    from pyspark.sql import functions as F
    from tokenloom.functions import scoring, tasks
    from tokenloom.operators.evalsets import ANSWER_RULES

    letters = spark.createDataFrame([("B",), ("AB",), ("",), ("5",)], "a string")
    got = letters.select(ANSWER_RULES["letter"](F.col("a"), None).alias("i")).collect()
    assert [r.i for r in got] == [1, -1, -1, -1]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "a boolean").select(ANSWER_RULES["boolean"](F.col("a"), None).alias("i"))
    assert [r.i for r in flags.collect()] == [0, 1, None]
    pairs = spark.createDataFrame([("x", "x"), (None, "x")], "p string, g string")
    assert [tuple(r) for r in pairs.select(scoring.exact_match(F.col("p"), F.col("g")), scoring.quasi_exact_match(F.col("p"), F.col("g"))).collect()] == [(1.0, 1.0), (0.0, 0.0)]
    boxed = spark.createDataFrame([(r"so \boxed{\frac{1}{2}} and \boxed{a_{b^{c}}}",)], "t string").select(scoring.boxed_answer(F.col("t")).alias("b"))
    assert boxed.first().b == r"a_{b^{c}}"
    metrics = spark.createDataFrame([([("a", None), ("b", tasks.PMI_CATEGORY)],)], "m array<struct<name: string, category: string>>")
    assert [m.name for m in metrics.select(tasks.drop_pmi_metrics(F.col("m")).alias("m")).first().m] == ["a"]


def test_negative_label_fails(spark):
    import pytest
    from pyspark.sql import functions as F
    from tokenloom.functions.scoring import row_cross_entropy

    rows = spark.createDataFrame([([-1.0, -2.0], -2)], "lp array<double>, label int")
    with pytest.raises(Exception, match="label out of range"):
        rows.select(row_cross_entropy(F.col("lp"), F.col("label"))).collect()
