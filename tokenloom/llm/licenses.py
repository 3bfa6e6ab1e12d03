"""License notices found by an exact set-similarity join with license templates.

The words of a template and of a block of text (a line) are sets, ordered by how common their
words are in the whole corpus, rarest first. A block that contains a template to the threshold
shares one of the template's first words; positions and sizes rule further pairs out before
the words themselves are compared. Everything is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.session import settle

# Phrases that name a license outright, by label.
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

# Notices to look for, by label.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2": "Licensed under the Apache License, Version 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "gpl-3": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "public-domain": "This is free and unencumbered software released into the public domain.",
}

#: Share of a template's words that a block must hold, in percent.
CONTAINMENT = 80

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """Runs of letters, digits and characters beyond ASCII; A-Z alone is lower-cased."""
    return F.array_remove(F.split(F.translate(text, ascii_uppercase, ascii_lowercase), _SEPARATORS), "")


def phrase_places(words: Column, phrase: str) -> Column:
    """Places, from 0, where the words of ``phrase`` stand one after the other."""
    parts = phrase.split()
    there = reduce(lambda a, b: a & b, (F.array_contains(words, p) for p in dict.fromkeys(sorted(parts, key=len))))
    starts = F.sequence(F.lit(0), F.size(words) - 1)
    same = lambda i: reduce(lambda a, b: a & b, (F.get(words, i + k).eqNullSafe(p) for k, p in enumerate(parts)))
    return F.when(there, F.filter(starts, same)).otherwise(F.array().cast("array<int>"))


def _template_words(spark, templates: dict[str, str]) -> DataFrame:
    rows = spark.createDataFrame(list(templates.items()), "label string, text string")
    return rows.select("label", F.explode(F.array_distinct(plain_words(F.col("text")))).alias("word"))


def template_matches(blocks: DataFrame, templates: dict[str, str] = TEMPLATES, percent: int = CONTAINMENT) -> DataFrame:
    """(block, label, containment) of all blocks that hold at least ``percent`` of a template's words.

    ``blocks`` has ``block``, which names a row, and ``words``, its distinct words. What is
    broadcast are words of the templates, never of the corpus.
    """
    spark = blocks.sparkSession
    words = _template_words(spark, templates)
    known = [r["word"] for r in words.select("word").distinct().orderBy("word").collect()]
    mine = F.filter("words", lambda w: w.isin(known))
    # the templates' words in the order of the corpus: rarest first
    counts = blocks.select(F.explode(mine).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in counts.collect()}
    order = {w: k for k, w in enumerate(sorted(known, key=lambda w: (counts.get(w, 0), w)))}
    rank = F.create_map(*[x for w, k in order.items() for x in (F.lit(w), F.lit(k))])

    items = {label: sorted(order[w] for (w,) in rows) for label, rows in _by_label(words).items()}
    need = {label: -(-percent * len(ranks) // 100) for label, ranks in items.items()}
    index = [
        (label, ranks, need[label], place, item)
        for label, ranks in items.items()
        for place, item in enumerate(ranks[: len(ranks) - need[label] + 1])
    ]
    index = spark.createDataFrame(index, "label string, template array<int>, need int, at int, item int")
    leads = sorted({r["item"] for r in index.select("item").collect()})

    held = blocks.select("block", F.sort_array(F.transform(mine, lambda w: rank[w])).alias("ranks"))
    held = held.where(F.arrays_overlap("ranks", F.array(*map(F.lit, leads))))
    entries = held.select("block", "ranks", F.posexplode("ranks").alias("place", "item"))
    pairs = entries.join(F.broadcast(index), "item")
    left = F.least(F.size("ranks") - F.col("place"), F.size("template") - F.col("at"))
    pairs = pairs.where((F.size("ranks") >= F.col("need")) & (left >= F.col("need")))
    shared = F.size(F.array_intersect("ranks", "template"))
    found = pairs.select("block", "label", shared.alias("shared"), "need", F.size("template").alias("size")).where("shared >= need")
    return found.groupBy("block", "label").agg(F.max(F.col("shared") / F.col("size")).alias("containment"))


def _by_label(words: DataFrame) -> dict[str, list]:
    out: dict[str, list] = {}
    for row in words.collect():
        out.setdefault(row["label"], []).append((row["word"],))
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts the places of PHRASES, ``first_word`` and ``last_word`` are the smallest
    and largest of them (NULL without one). ``labels`` adds the templates that a line of the
    text holds. ``score`` is 1 with a phrase, else the largest containment found, else 0. NULL
    texts are empty; a NULL id is kept; rows that repeat id and text get the same result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("block"))
    lines = rows.select("block", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.select("block", F.array_distinct(plain_words(F.col("line"))).alias("words"))
    found = template_matches(lines, templates).groupBy("block")
    found = settle(found.agg(F.collect_set("label").alias("found"), F.max("containment").alias("containment")), "license-matches")

    words = rows.select("id", "block", plain_words(F.col("text")).alias("words"))
    places = [phrase_places(F.col("words"), p).alias(f"p{k}") for k, p in enumerate(PHRASES.values())]
    words = words.select("id", "block", F.size("words").cast("long").alias("n_words"), *places)
    every = F.concat(*[F.col(f"p{k}") for k in range(len(PHRASES))])
    base = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES)]))
    words = words.select("id", "block", "n_words", every.alias("places"), base.alias("base"))
    out = words.join(found, "block", "left")
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


def _sql_words(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


def sql() -> str:
    """The same result over ``documents`` in SQL, comparing every line with every template."""
    places = []
    for label, phrase in PHRASES.items():
        same = " AND ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(phrase.split()))
        places.append(f"SELECT rid, '{label}' AS label, unnest(list_filter(range(0, len(w)), lambda i: {same})) AS place FROM docs")
    templates = ", ".join("('{}', '{}')".format(label, text.replace("'", "''")) for label, text in TEMPLATES.items())
    return f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS rid, text, {_sql_words("text")} AS w FROM documents),
templates AS (SELECT label, list_distinct({_sql_words("t")}) AS tw FROM (VALUES {templates}) AS v(label, t)),
places AS ({" UNION ALL ".join(places)}),
base AS (SELECT rid, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS labels FROM places GROUP BY rid),
lines AS (SELECT rid, list_distinct({_sql_words("line")}) AS lw
          FROM (SELECT rid, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM docs)),
found AS (SELECT rid, label, max(len(list_intersect(lw, tw)) / len(tw)) AS held
          FROM lines, templates WHERE 100 * len(list_intersect(lw, tw)) >= {CONTAINMENT} * len(tw) GROUP BY ALL),
matched AS (SELECT rid, list(label) AS labels, max(held) AS held FROM found GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(matched.labels, [])))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(held, 0.0) END::DOUBLE AS score
FROM docs LEFT JOIN base USING (rid) LEFT JOIN matched USING (rid)"""
