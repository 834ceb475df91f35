"""License scan by diagonal voting, in DataFrame functions only.

Every rolling word k-gram of every text is joined by its hash to the positions it has in the
templates (a fixed table, broadcast). A hit votes for (template, diagonal), the diagonal being text
position minus template position. Votes are counted per diagonal before anything is shuffled, so a
text sends one row per diagonal hit. Diagonals at most ``GAP`` words apart are one band: inserted or
lost words move the rest of a passage to a near diagonal. A band is verified by the words
themselves: a hit counts only where gram and template have the same words, and a band stands when
its distinct template positions cover ``COVERAGE`` of the template.

Base phrases are templates that must be whole on one diagonal; their starts are the phrase's places.

Defined cases: a null or empty text has no words, no places and score 0; repeated rows give a row
each; an empty table gives no rows; other columns are left alone. Only A-Z are lower-cased; other
letters never become ASCII.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

K = 4
GAP = 3
COVERAGE = 0.5

# Phrases and labels, and openings of public license notices.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
]
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: (template, label, is a base phrase, number of grams)
TEMPLATES = [(p, label, True, len(p.split()) - 1) for p, label in PHRASES.items()] + [
    (t, label, False, len(t.split()) - K + 1) for label, t in NOTICES
]


def template_grams() -> list[tuple[str, int, int]]:
    """(gram, template number, position) of every template; a gram of two words in phrases, else K.

    At most 63 positions each, so that the positions hit fit the bits of one number.
    """
    rows = []
    for number, (text, _, base, grams) in enumerate(TEMPLATES):
        k, words = 2 if base else K, text.split()
        if not 0 < grams <= 63:
            raise ValueError(f"template {text!r} has {grams} grams")
        rows += [(" ".join(words[i : i + k]), number, i) for i in range(grams)]
    return rows


def word_array(text: str) -> Column:
    """The words of a text. Two letters outside ASCII would become ASCII ones when lower-cased; they
    are put out of the way first."""
    kept = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("é")), F.lit("İ"), F.lit("é"))
    return F.array_remove(F.split(F.lower(kept), SEPARATORS), "")


def _grams(words: Column, n: Column, k: int) -> Column:
    at = F.sequence(F.lit(1), n - F.lit(k - 1))
    made = F.transform(at, lambda i: F.concat_ws(" ", *(F.element_at(words, i + j) for j in range(k))))
    return F.when(n >= k, made).otherwise(F.array().cast("array<string>"))


def _values(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A small fixed table, as literals of the plan."""
    return spark.sql("SELECT * FROM VALUES " + ", ".join(str(row) for row in rows) + f" AS t({columns})")


#: Number of the row that stands for the text itself, so texts without a hit are kept.
TEXT = -1


def votes(docs: DataFrame) -> DataFrame:
    """Hits of every text, counted by template and diagonal; and a row for the text."""
    table = _values(docs.sparkSession, "template_gram, template, pos", [("", TEXT, 0), *template_grams()])
    table = table.withColumn("hash", F.xxhash64("template_gram"))
    words = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), word_array("text").alias("words")
    ).withColumn("n_words", F.size("words"))
    pairs, runs = (_grams(F.col("words"), F.col("n_words"), k) for k in (2, K))
    grams = words.select("row", "doc_id", "n_words", F.posexplode(F.concat(F.array(F.lit("")), pairs, runs)).alias("slot", "gram"))
    first_run = F.greatest(F.col("n_words"), F.lit(1))  # slot 0 is the text, then n-1 pairs, then runs of K
    place = F.when(F.col("slot") < first_run, F.col("slot") - 1).otherwise(F.col("slot") - first_run)
    hits = grams.withColumn("hash", F.xxhash64("gram")).join(F.broadcast(table), "hash").where("gram = template_gram")
    hits = hits.withColumn("diagonal", F.when(F.col("template") == TEXT, 0).otherwise(place - F.col("pos")))
    bit = F.expr("shiftleft(1L, pos)")
    return hits.groupBy("row", "doc_id", "n_words", "template", "diagonal").agg(F.bit_or(bit).alias("covered"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every text."""
    rows = [(i, label, base, grams) for i, (_, label, base, grams) in enumerate(TEMPLATES)]
    names = _values(docs.sparkSession, "template, label, base, grams", rows)
    found = votes(docs).join(F.broadcast(names), "template", "left")
    by_template = Window.partitionBy("row", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(by_template)
    starts = F.when(F.col("base") | (step > GAP), 1).otherwise(0)
    bands = found.withColumn("starts", starts).withColumn("band", F.sum("starts").over(by_template))
    bands = bands.groupBy("row", "doc_id", "n_words", "template", "label", "base", "grams", "band").agg(
        F.bit_or("covered").alias("covered"), F.min("diagonal").cast("long").alias("start")
    )
    share = F.bit_count("covered") / F.col("grams")
    whole, passage = F.col("base") & (share == 1), ~F.col("base") & (share >= COVERAGE)
    verified = bands.withColumns({"share": share, "whole": whole, "holds": whole | passage})
    labels = lambda holds: F.concat_ws(",", F.array_sort(F.collect_set(F.when(F.col(holds), F.col("label")))))
    out = verified.groupBy("row", "doc_id", F.col("n_words").cast("long").alias("n_words")).agg(
        F.count(F.when(F.col("whole"), 1)).alias("n_base"),
        F.min(F.when(F.col("whole"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("whole"), F.col("start"))).alias("last_word"),
        labels("whole").alias("base_labels"),
        labels("holds").alias("labels"),
        F.coalesce(F.max(F.when(F.col("holds"), F.col("share"))), F.lit(0.0)).alias("score"),
    )
    return out.drop("row")


def oracle() -> str:
    """The same over ``documents`` in DuckDB, word list by word list."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    values = ", ".join(f"('{g}', {t}, {a})" for g, t, a in template_grams())
    names = ", ".join(f"({i}, '{label}', {base}, {grams})" for i, (_, label, base, grams) in enumerate(TEMPLATES))
    word = re.sub(r"\+$", "", SEPARATORS).replace("[", "[^") + "+"
    return f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{word}') AS words FROM documents),
p AS (SELECT r, doc_id, words, len(words) AS n, unnest(range(len(words))) AS i FROM w),
g AS (SELECT r, i, array_to_string(words[i + 1:i + k], ' ') AS gram FROM p, (VALUES (2), ({K})) ks(k) WHERE i + k <= n),
t(gram, template, pos) AS (VALUES {values}),
names(template, label, base, grams) AS (VALUES {names}),
d AS (SELECT r, template, i - pos AS diagonal, list(DISTINCT pos) AS hit FROM g JOIN t USING (gram) GROUP BY ALL),
s AS (SELECT *, CASE WHEN base OR diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {GAP} THEN 1 ELSE 0 END AS starts FROM d JOIN names USING (template)),
b AS (SELECT *, sum(starts) OVER (PARTITION BY r, template ORDER BY diagonal) AS band FROM s),
v AS (SELECT r, label, base, min(diagonal) AS start, len(list_distinct(flatten(list(hit)))) / grams AS share FROM b GROUP BY r, template, label, base, grams, band),
f AS (SELECT r, count(*) FILTER (base AND share = 1) AS n_base, min(start) FILTER (base AND share = 1) AS first_word, max(start) FILTER (base AND share = 1) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND share = 1), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (CASE WHEN base THEN share = 1 ELSE share >= {COVERAGE} END), '') AS labels,
  max(share) FILTER (CASE WHEN base THEN share = 1 ELSE share >= {COVERAGE} END) AS score FROM v GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN f USING (r)"""
