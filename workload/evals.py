"""Queries over evaluation sets and logged outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.functions import scoring as score, tasks
from tokenloom.functions.text import WHITESPACE
from tokenloom.functions.tokens import word_count
from tokenloom.operators import evalsets, runs, scoring
from workload.base import SEED, WORDS_SQL, documents as _documents, rounded, table

SHOTS = 3
LAST = 5
DONE_VALUE = 20
FAILED_VALUE = 5


def _option(i: int):
    return F.concat_ws(" ", F.lit(f"option {i} of"), "source")


def normalize_mcq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a row of every multiple-choice source, in that source's own shape."""
    docs = _documents(spark, sf_dir)
    four = F.array(*[_option(i) for i in range(4)])
    labels = F.array(*[F.lit(x) for x in "ABCD"])
    fourth, third, half = F.col("doc_id") % 4, F.col("doc_id") % 3, F.col("doc_id") % 2
    letter = F.substring(F.lit("ABCD"), (fourth + 1).cast("int"), F.lit(1))
    listed = F.struct(four.alias("text"), labels.alias("label"))
    shaped = {
        "arc": {
            "question": F.col("text"),
            "choices": listed,
            "answerKey": F.when(half == 0, (fourth + 1).cast("string")).otherwise(letter),
        },
        "boolq": {"question": F.col("text"), "passage": F.col("source"), "answer": half == 0},
        "hellaswag": {
            "activity_label": F.col("lang"), "ctx_a": F.col("text"), "ctx_b": F.col("source"),
            "endings": four, "label": fourth.cast("string"),
        },
        "commonsenseqa": {
            "question": F.col("text"), "choices": listed, "answerKey": F.concat(F.lit(" "), letter, F.lit(" ")),
        },
        "openbookqa": {"question_stem": F.col("text"), "choices": listed, "answerKey": letter},
        "winogrande": {
            "sentence": F.col("text"), "option1": _option(0), "option2": _option(1), "answer": (half + 1).cast("string"),
        },
        "piqa": {"goal": F.col("text"), "sol1": _option(0), "sol2": _option(1), "label": half.cast("int")},
        "siqa": {
            "question": F.col("text"), "context": F.col("lang"), "answerA": _option(0), "answerB": _option(1),
            "answerC": _option(2), "label": (third + 1).cast("string"),
        },
        "mmlu": {"question": F.col("text"), "choices": four, "answer": fourth.cast("int")},
        "mmlu_pro": {"question": F.col("text"), "options": four, "answer_index": fourth.cast("int")},
    }
    parts = [
        evalsets.normalize_mcq(
            docs.select("doc_id", *[c.alias(n) for n, c in columns.items()]), evalsets.MCQ_SPECS[name], ["doc_id"]
        )
        for name, columns in shaped.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts).select(
        "doc_id",
        "task",
        F.md5("question").alias("question_md5"),
        "context",
        F.size("choices").alias("num_choices"),
        F.col("gold_idx").cast("bigint").alias("gold_idx"),
        F.get("choices", F.col("gold_idx").cast("int")).alias("gold"),
    )


def _perturbed(spark, sf_dir):
    kind = F.when(F.col("source") == "src3", "critical thinking").when(F.col("source") != "src4", F.col("source"))
    return _documents(spark, sf_dir).withColumn("perturbation_type", kind)


def build_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both open-answer formats over all documents."""
    docs = _documents(spark, sf_dir)
    parts = [
        evalsets.build_prompts(docs, query(F.col("text")), "lang", ["doc_id"]).withColumn("format", F.lit(name))
        for name, query in (("bbh", evalsets.bbh_prompt), ("math", evalsets.math_prompt))
    ]
    return parts[0].unionByName(parts[1]).select(
        "doc_id", "format", F.md5("query").alias("query_md5"), F.element_at("choices", 1).alias("gold"), "gold_idx"
    )


def keep_scorable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evalsets.keep_scorable(_perturbed(spark, sf_dir)).select("doc_id", "perturbation_type")


def _shot_text():
    return F.concat_ws(" ", "source", F.col("doc_id").cast("string"), F.md5("text"))


def few_shot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded and fixed examples of every language, from the documents labelled good."""
    docs = _documents(spark, sf_dir)
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    pool = docs.join(good, "doc_id", "left_semi")
    seeded, fixed = (
        evalsets.few_shot(pool, SHOTS, group=["lang"], order=["doc_id"], example=_shot_text(), seed=seed)
        for seed in (SEED, None)
    )
    return seeded.select("lang", F.array_join("shots", ";").alias("seeded")).join(
        fixed.select("lang", F.array_join("shots", ";").alias("fixed")), "lang"
    )


def few_shot_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a query behind its source's examples."""
    docs = _documents(spark, sf_dir)
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    pool = docs.join(toxic, "doc_id", "left_semi")
    shots = evalsets.few_shot(pool, SHOTS, group=["source"], order=["doc_id"], example=_shot_text(), seed=SEED)
    shown = evalsets.with_few_shot(docs, shots, ["source"])
    return shown.select(
        "doc_id",
        F.size("shots").alias("num_shots"),
        F.md5(evalsets.few_shot_prompt(F.col("shots"), evalsets.bbh_prompt(F.col("text")))).alias("prompt_md5"),
    )


def task_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents logged under every task by turns: tasks, examples and characters per benchmark."""
    registry = tasks.task_registry(spark)
    logged = _documents(spark, sf_dir).select((F.col("doc_id") % registry.count()).cast("int").alias("task_idx"), "n_chars")
    counted = logged.groupBy("task_idx").agg(F.count("*").alias("examples"), F.sum("n_chars").alias("chars"))
    return (
        registry.join(counted, "task_idx", "left")
        .groupBy("family", "formulation", "repo", "eval_split", "few_shot_split")
        .agg(
            F.count("*").alias("tasks"),
            F.sum("examples").alias("examples"),
            F.sum("chars").alias("chars"),
            F.min("task").alias("first_task"),
            F.max("subset").alias("last_subset"),
        )
    )


def requested_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task requests made of the documents' languages and sources, resolved in the registry."""
    name = (
        F.when(F.col("lang") == "en", "mmlu_cf")
        .when(F.col("lang") == "de", "arc_mcf:easy")
        .when(F.col("lang") == "fr", "bbh")
        .otherwise("winogrande_hybrid")
    )
    requests = (
        _documents(spark, sf_dir)
        .groupBy("lang", "source")
        .agg(F.count("*").alias("documents"))
        .select("source", F.concat_ws("|", F.lit("custom"), name, F.col("documents").cast("string"), F.lit("1")).alias("request"))
    )
    found = tasks.requested_tasks(requests, tasks.task_registry(spark))
    return found.groupBy("task", "repo").agg(F.count("*").alias("requests"), F.sum("num_shots").alias("shots"))


def drop_pmi_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics logged for documents, some of them in the category that is dropped."""
    kind = F.when(F.col("n_chars") % 2 == 0, "MULTICHOICE_PMI").otherwise("GENERATIVE")
    logged = F.array(
        F.struct(F.lit("acc_norm").alias("name"), F.lit("MULTICHOICE").alias("category")),
        F.struct(F.col("source").alias("name"), kind.alias("category")),
    )
    kept = _documents(spark, sf_dir).select("doc_id", tasks.drop_pmi_metrics(logged).alias("kept"))
    return kept.select("doc_id", F.size("kept").alias("num_metrics"), F.array_join("kept.name", ",").alias("names"))


def loglik_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding values as choice log-probabilities, the label as gold choice."""
    rows = table(spark, sf_dir, "embeddings").select(
        "label",
        F.transform("embedding", lambda x: -F.abs(x.cast("double"))).alias("logprobs"),
        F.transform("embedding", lambda x, i: (i % 5 + 1).cast("double")).alias("tokens"),
        F.transform("embedding", lambda x, i: (i * 7 % 11 + 3).cast("double")).alias("chars"),
    )
    return rounded(
        scoring.loglik_accuracy(
            rows, ["label"], logprobs="logprobs", gold="label", token_lengths="tokens", char_lengths="chars"
        )
    )


def _answered(spark, sf_dir, good, bad):
    """Documents with a good or bad answer, as their label says."""
    labelled = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return _documents(spark, sf_dir).join(labelled, "doc_id", "left").withColumn(
        "prediction", F.when(F.col("quality") == 1, good).otherwise(bad)
    )


def exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts compared, padded or reworded: exact and normalized matches per language."""
    reworded = F.concat(F.lit("The  "), F.replace("text", F.lit(","), F.lit(" ;")), F.lit("!"))
    rows = _answered(spark, sf_dir, F.concat(F.lit(" "), "text", F.lit("\n")), reworded)
    exact = score.exact_match(F.col("prediction"), F.col("text"))
    quasi = score.quasi_exact_match(F.col("prediction"), F.col("text"))
    both = rows.select("lang", exact.alias("em"), quasi.alias("qem"))
    return rounded(
        both.groupBy("lang").agg(F.count("*").alias("num_examples"), F.avg("em").alias("em"), F.avg("qem").alias("qem"))
    )


def numeric_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last number, and the boxed answer, of whole texts against the character count.

    Boxes are flat, nested, left open behind a closed one, only open, or the prediction is missing.
    """
    gold = F.col("n_chars").cast("string")
    kinds = [" so $\\boxed{ #.0}$", " so \\boxed{\\frac{\\boxed{#}}{{2}}} {x}", " so {\\boxed{#}} or \\boxed{1", " so \\boxed{#", None]
    form = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("doc_id") % len(kinds) + 1).cast("int"))
    boxed = F.concat("text", F.replace(form, F.lit("#"), gold))
    rows = _answered(spark, sf_dir, boxed, F.concat(F.col("text"), F.lit(" makes "), gold))
    return rows.select(
        "doc_id",
        score.last_number(F.col("text")).alias("last_number"),
        score.boxed_answer(F.col("prediction")).alias("boxed"),
        score.numeric_match(F.col("prediction"), gold).alias("number_ok"),
        score.boxed_match(F.col("prediction"), gold).alias("boxed_ok"),
    )


def clean_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts behind a reasoning block; long ones are cut to the judge's budget."""
    thought = F.concat(F.lit("<think>"), "source", F.lit("\n\n"), "lang", F.lit("</think>\n "), "text", F.lit(" <think>x</think>"))
    rows = _answered(spark, sf_dir, thought, F.concat(F.lit("\t"), "text"))
    generated = word_count(F.col("prediction"))
    cleaned = score.clean_prediction(F.col("prediction"), generated)
    return rows.select(
        "doc_id",
        F.length(cleaned).cast("bigint").alias("chars"),
        F.md5(cleaned).alias("clean_md5"),
        (generated > score.MAX_JUDGE_TOKENS).alias("over_budget"),
    )


def judge_score_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").withColumn(
        "points", F.col("quality") + 4 * F.col("toxic")
    )
    return rounded(
        scoring.judge_score_mean(
            judged, ["lang", "source"], score="points", freeform=F.col("lang").isin("en", "de")
        )
    )


def _listing(spark, sf_dir):
    """Run folders named after events: two kinds of checkpoints and other things."""
    number = F.col("event_id").cast("string")
    name = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("step_"), number))
        .when(F.col("event_type") == "view", F.concat(F.lit("checkpoint-"), number))
        .when(F.col("event_type") == "error", F.concat(F.lit("step_"), number, F.lit(".tmp")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("my_step_"), number))
        .otherwise(F.lit("logs"))
    )
    listed = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", name.alias("name"))
    return listed.withColumn("path", F.concat_ws("/", F.lit("runs"), F.col("user_id").cast("string"), "name"))


def latest_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.list_checkpoints(_listing(spark, sf_dir), LAST).select("name", "step", "path")


def pending_evals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints of a high value have results already."""
    checkpoints = runs.list_checkpoints(_listing(spark, sf_dir))
    return runs.pending_evals(checkpoints, checkpoints.where(F.col("value") > DONE_VALUE)).select("path", "step")


def sweep_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Done and failed checkpoints per kind of folder; the high ones were not started again."""
    checkpoints = runs.list_checkpoints(_listing(spark, sf_dir))
    exit_code = F.when(F.col("value") < FAILED_VALUE, 1).otherwise(0)
    exits = checkpoints.where(F.col("value") <= DONE_VALUE).select("path", exit_code.alias("exit_code"))
    return runs.sweep_summary(checkpoints, exits, ["event_type"])


QUERIES = {
    f.__name__: f
    for f in (
        normalize_mcq,
        build_prompts,
        keep_scorable,
        few_shot,
        few_shot_prompts,
        task_registry,
        requested_tasks,
        drop_pmi_metrics,
        loglik_accuracy,
        exact_match,
        numeric_match,
        clean_prediction,
        judge_score_mean,
        latest_checkpoints,
        pending_evals,
        sweep_summary,
    )
}

BLANKS_SQL = "'" + WHITESPACE + "'"
MATH_SQL = "'" + evalsets.MATH_PROMPT.replace("'", "''") + "'"
SHOT_SQL = "source || ' ' || doc_id || ' ' || md5(text)"


def normalized_sql(text: str) -> str:
    """Punctuation by a character class, articles by rejoining the words between blanks."""
    bare = f"regexp_replace(lower({text}), '[!-/:-@\\[-`{{-~]', '', 'g')"
    words = f"string_split(translate({bare}, chr(10) || chr(9), '  '), ' ')"
    return f"array_to_string(list_filter({words}, lambda w: w NOT IN ('', 'the', 'an', 'a')), ' ')"


def last_number_sql(text: str) -> str:
    return f"TRY_CAST(replace(regexp_extract_all({text}, '-?[0-9][0-9,]*(?:\\.[0-9]+)?')[-1], ',', '') AS DOUBLE)"


def _registry_sql() -> str:
    """The registry spelled as families with their lists unfolded in SQL."""

    def listed(values):
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    def text(value):
        return "NULL" if value is None else f"'{value}'"

    rows = ",\n    ".join(
        f"({i}, '{f.name}', '{f.repo}', '{f.hf_subset}', '{f.eval_split}', {text(f.few_shot_split)}, "
        f"{listed(f.subsets)}, {listed(f.formulations)})"
        for i, f in enumerate(tasks.FAMILIES)
    )
    return f"""
families(f, pattern, repo, hf_subset, eval_split, few_shot_split, subsets, forms) AS (VALUES
    {rows}),
by_subset AS (
  SELECT f, pattern, repo, hf_subset, eval_split, few_shot_split, forms, unnest(subsets) AS s,
         generate_subscripts(subsets, 1) AS si FROM families),
by_form AS (SELECT *, unnest(forms) AS form, generate_subscripts(forms, 1) AS fi FROM by_subset),
registry AS (
  SELECT row_number() OVER (ORDER BY f, si, fi) - 1 AS task_idx,
         replace(replace(pattern, '{{form}}', form), '{{subset}}', CASE WHEN pattern LIKE 'arc%' THEN lower(s) ELSE s END) AS task,
         rtrim(split_part(pattern, '{{', 1), '_:') AS family, nullif(form, '') AS formulation, repo,
         replace(hf_subset, '{{subset}}', s) AS subset, eval_split, few_shot_split
  FROM by_form)"""


LISTING_SQL = """
listing AS (
  SELECT event_id, user_id, event_type, value,
         CASE event_type WHEN 'click' THEN 'step_' || event_id WHEN 'view' THEN 'checkpoint-' || event_id END AS name,
         event_id AS step
  FROM events WHERE event_type IN ('click', 'view')),
checkpoints AS (SELECT *, 'runs/' || user_id || '/' || name AS path FROM listing)"""

_MCQ_SQL = [
    # task, question, context, choices, gold
    ("arc", "text", "NULL", 4, "doc_id % 4"),
    ("boolq", "text", "source", 0, "doc_id % 2"),
    ("hellaswag", "text || ' ' || source", "lang", 4, "doc_id % 4"),
    ("commonsenseqa", "text", "NULL", 4, "doc_id % 4"),
    ("openbookqa", "text", "NULL", 4, "doc_id % 4"),
    ("winogrande", "text", "NULL", 2, "doc_id % 2"),
    ("piqa", "text", "NULL", 2, "doc_id % 2"),
    ("siqa", "text", "lang", 3, "doc_id % 3"),
    ("mmlu", "text", "NULL", 4, "doc_id % 4"),
    ("mmlu_pro", "text", "NULL", 4, "doc_id % 4"),
]

ORACLES = {
    "normalize_mcq": " UNION ALL ".join(
        f"""SELECT doc_id, '{task}' AS task, md5({question}) AS question_md5, {context}::VARCHAR AS context,
                   {choices or 2} AS num_choices, {gold} AS gold_idx,
                   {f"'option ' || ({gold}) || ' of ' || source" if choices else f"CASE {gold} WHEN 0 THEN 'yes' ELSE 'no' END"} AS gold
            FROM documents"""
        for task, question, context, choices, gold in _MCQ_SQL
    ),
    "build_prompts": f"""
        SELECT doc_id, 'bbh' AS format, md5('Question: ' || text || chr(10) || 'Answer: ') AS query_md5, lang AS gold,
               0 AS gold_idx FROM documents
        UNION ALL SELECT doc_id, 'math', md5({MATH_SQL} || text), lang, 0 FROM documents""",
    "keep_scorable": """
        SELECT doc_id, CASE WHEN source <> 'src4' THEN source END AS perturbation_type
        FROM documents WHERE source <> 'src3'""",
    "few_shot": f"""
        WITH pool AS (SELECT lang, doc_id, {SHOT_SQL} AS shot,
                        row_number() OVER (PARTITION BY lang ORDER BY md5('{SEED}:' || doc_id), doc_id) AS r1,
                        row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r2
                      FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))
        SELECT lang, string_agg(shot, ';' ORDER BY r1) FILTER (WHERE r1 <= {SHOTS}) AS seeded,
               string_agg(shot, ';' ORDER BY r2) FILTER (WHERE r2 <= {SHOTS}) AS fixed
        FROM pool GROUP BY lang""",
    "few_shot_prompts": f"""
        WITH pool AS (SELECT source, {SHOT_SQL} AS shot,
                        row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}:' || doc_id), doc_id) AS r
                      FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)),
        shots AS (SELECT source, count(*) AS n, string_agg(shot, chr(10) || chr(10) ORDER BY r) AS shown
                  FROM pool WHERE r <= {SHOTS} GROUP BY source)
        SELECT doc_id, coalesce(n, 0)::INTEGER AS num_shots,
               md5(coalesce(shown || chr(10) || chr(10), '') || 'Question: ' || text || chr(10) || 'Answer: ') AS prompt_md5
        FROM documents LEFT JOIN shots USING (source)""",
    "task_registry": f"""
        WITH {_registry_sql()},
        counted AS (SELECT doc_id % 240 AS task_idx, count(*) AS examples, sum(n_chars)::BIGINT AS chars
                    FROM documents GROUP BY 1)
        SELECT family, formulation, repo, eval_split, few_shot_split, count(*) AS tasks,
               sum(examples)::BIGINT AS examples, sum(chars)::BIGINT AS chars, min(task) AS first_task,
               max(subset) AS last_subset
        FROM registry LEFT JOIN counted USING (task_idx) GROUP BY ALL""",
    "requested_tasks": f"""
        WITH {_registry_sql()},
        asked AS (SELECT CASE lang WHEN 'en' THEN 'mmlu_cf' WHEN 'de' THEN 'arc_mcf:easy' WHEN 'fr' THEN 'bbh'
                              ELSE 'winogrande_hybrid' END AS asked, count(*) AS shots
                  FROM documents GROUP BY lang, source)
        SELECT task, repo, count(*) AS requests, sum(shots)::BIGINT AS shots
        FROM asked JOIN registry ON task = asked OR (contains(task, ':') AND split_part(task, ':', 1) = asked)
        GROUP BY ALL""",
    "drop_pmi_metrics": """
        SELECT doc_id, CASE WHEN n_chars % 2 = 0 THEN 1 ELSE 2 END AS num_metrics,
               CASE WHEN n_chars % 2 = 0 THEN 'acc_norm' ELSE 'acc_norm,' || source END AS names
        FROM documents""",
    "loglik_accuracy": """
        WITH choices AS (
          SELECT vec_id, label, i - 1 AS i, -abs(embedding[i]::DOUBLE) AS p
          FROM embeddings, (SELECT unnest(range(1, 65)) AS i)),
        best AS (SELECT vec_id, label, arg_max(i, (p, -i)) AS plain, arg_max(i, (p / (i % 5 + 1), -i)) AS by_token,
                        arg_max(i, (p / (i * 7 % 11 + 3), -i)) AS by_char
                 FROM choices GROUP BY vec_id, label)
        SELECT label, count(*) AS num_examples, round(avg((plain = label)::INT), 6) AS acc,
               round(avg((by_token = label)::INT), 6) AS acc_norm_token, round(avg((by_char = label)::INT), 6) AS acc_norm
        FROM best GROUP BY label""",
    "exact_match": f"""
        WITH p AS (SELECT lang, text, CASE WHEN quality = 1 THEN ' ' || text || chr(10)
                          ELSE 'The  ' || replace(text, ',', ' ;') || '!' END AS prediction
                   FROM documents LEFT JOIN labels USING (doc_id))
        SELECT lang, count(*) AS num_examples,
               round(avg((trim(prediction, {BLANKS_SQL}) = trim(text, {BLANKS_SQL}))::INT), 6) AS em,
               round(avg(({normalized_sql('prediction')} = {normalized_sql('text')})::INT), 6) AS qem
        FROM p GROUP BY lang""",
    "numeric_match": f"""
        WITH p AS (SELECT doc_id, text, n_chars, text || CASE WHEN quality = 1 THEN
                            CASE doc_id % 5 WHEN 0 THEN ' so $\\boxed{{ ' || n_chars || '.0}}$'
                                 WHEN 1 THEN ' so \\boxed{{\\frac{{\\boxed{{' || n_chars || '}}}}{{{{2}}}}}} {{x}}'
                                 WHEN 2 THEN ' so {{\\boxed{{' || n_chars || '}}}} or \\boxed{{1'
                                 WHEN 3 THEN ' so \\boxed{{' || n_chars END
                          ELSE ' makes ' || n_chars END AS prediction
                   FROM documents LEFT JOIN labels USING (doc_id)),
        letters AS (SELECT doc_id, unnest(string_split(prediction, '')) AS c,
                           generate_subscripts(string_split(prediction, ''), 1) AS place FROM p),
        braces AS (SELECT *, sum(CASE c WHEN '{{' THEN 1 ELSE -1 END) OVER (PARTITION BY doc_id ORDER BY place) AS depth
                   FROM letters WHERE c IN ('{{', '}}')),
        boxes AS (SELECT o.doc_id, o.place, min(e.place) AS shut FROM braces o JOIN p USING (doc_id)
                  JOIN braces e ON e.doc_id = o.doc_id AND e.place > o.place AND e.depth < o.depth
                  WHERE o.c = '{{' AND o.place > 6 AND substr(prediction, o.place - 6, 6) = '\\boxed' GROUP BY ALL),
        last_box AS (SELECT doc_id, arg_max(substr(prediction, place + 1, shut - place - 1), shut) AS boxed
                     FROM boxes JOIN p USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, {last_number_sql('text')} AS last_number, boxed,
               coalesce(({last_number_sql('prediction')} = n_chars)::INT::DOUBLE, 0.0) AS number_ok,
               coalesce((TRY_CAST(trim(boxed) AS DOUBLE) = n_chars)::INT::DOUBLE, 0.0) AS boxed_ok
        FROM p LEFT JOIN last_box USING (doc_id)""",
    "clean_prediction": f"""
        WITH p AS (SELECT doc_id, CASE WHEN quality = 1 THEN '<think>' || source || chr(10) || chr(10) || lang || '</think>'
                            || chr(10) || ' ' || text || ' <think>x</think>' ELSE chr(9) || text END AS prediction
                   FROM documents LEFT JOIN labels USING (doc_id)),
        c AS (SELECT doc_id, len({WORDS_SQL.format(text='prediction')}) > 2048 AS over_budget,
                     trim(regexp_replace(prediction, '(?s)<think>.*?</think>', '', 'g'), {BLANKS_SQL}) AS cleaned FROM p),
        cut AS (SELECT doc_id, over_budget, CASE WHEN over_budget THEN right(cleaned, 8192) ELSE cleaned END AS cleaned FROM c)
        SELECT doc_id, length(cleaned) AS chars, md5(cleaned) AS clean_md5, over_budget FROM cut""",
    "judge_score_mean": """
        SELECT lang, source, count(*) AS num_examples,
               round(avg((quality + 4 * toxic) / CASE WHEN lang IN ('en', 'de') THEN 5.0 ELSE 1.0 END), 6) AS judge_score
        FROM documents JOIN labels USING (doc_id) GROUP BY lang, source""",
    "latest_checkpoints": f"""
        WITH {LISTING_SQL} SELECT name, step, path FROM checkpoints ORDER BY step DESC LIMIT {LAST}""",
    "pending_evals": f"WITH {LISTING_SQL} SELECT path, step FROM checkpoints WHERE value <= {DONE_VALUE}",
    "sweep_summary": f"""
        WITH {LISTING_SQL}
        SELECT event_type, count(*) AS num_checkpoints,
               count(*) FILTER (WHERE value >= {FAILED_VALUE}) AS num_done,
               count(*) FILTER (WHERE value < {FAILED_VALUE}) AS num_failed
        FROM checkpoints GROUP BY event_type""",
}
