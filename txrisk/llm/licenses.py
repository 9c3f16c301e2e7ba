"""License scan (operator 2), with DataFrame functions only.

Two sources of labels: places where a license phrase's words stand side by
side, and text blocks (lines) that contain a license template to a threshold.
The second is an exact set-similarity join. The tokens of templates are ordered
by their frequency in the whole corpus, rarest first. A block that holds at
least ``need`` of a template's ``size`` tokens must share a token of the
template's prefix (its first ``size - need + 1`` tokens) within the prefix of
its own template tokens; blocks meet templates by joining on those tokens. The
length filter drops blocks with fewer than ``need`` template tokens, the
positional filter those whose tokens after the meeting place are too few; what
is left is counted exactly.

With ``passages`` blocks are windows of consecutive words in place of lines, so
that a license text wrapped over lines is met, and one-line notices count too.

Scale: only blocks holding a template-prefix token leave the scan. The template
side of the join is a fixed table of a few dozen rows. Document results are
put together by row, never by label or license.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_PATTERN, beside, folded, quoted, stored

# The phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Opening terms of public licenses, as published.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
               "in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or "
                    "transmitted in any form or by any means without the prior written permission of the publisher"),
]
THRESHOLD = 0.8

# One-line notices as patterns over words side by side, and their labels.
NOTICES = {
    " all rights reserved ": "proprietary",
    " cc by(?: nc| sa| nd)*(?: nc| sa| nd| [1-4]) ": "cc",
    " (?:under|license|licence) cc (?:by|0) ": "cc",
    " cc0(?: 1)? ": "cc",
    " creative commons (?:attribution|zero|license|licence) ": "cc",
}


#: What stands between words; splitting is far cheaper than extracting each match.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: F.Column) -> F.Column:
    return F.array_remove(F.split(text, BETWEEN), "")


def template_tokens(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, label, token): distinct tokens of each template that has any."""
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)],
                                 "template int, label string, text string")
    return rows.select("template", "label", F.explode(F.array_distinct(words_of(folded(F.col("text"))))).alias("token"))


def token_order(src: DataFrame, vocab: list[str]) -> list[str]:
    """``vocab`` by the number of texts that hold each token, rarest first (ties by token)."""
    if not vocab:
        return []
    found = F.array_intersect(words_of(F.col("low")), F.array(*map(F.lit, vocab)))
    # At most one row for each template token comes back.
    counts = dict(map(tuple, src.select(F.explode(found).alias("token")).groupBy("token").count().collect()))
    return sorted(vocab, key=lambda w: (counts.get(w, 0), w))


def prefix_table(rows: list, order: list[str], threshold: float) -> list[tuple]:
    """(token, label, place, size, need, tokens) for every token of every template's prefix."""
    rank = {w: i for i, w in enumerate(order)}
    by: dict[int, tuple[str, list[str]]] = {}
    for t, label, token in rows:
        by.setdefault(t, (label, []))[1].append(token)
    out = []
    for label, tokens in by.values():
        tokens.sort(key=rank.__getitem__)
        need = math.ceil(threshold * len(tokens) - 1e-9)
        for i, token in enumerate(tokens[:len(tokens) - need + 1]):
            out.append((token, label, i, len(tokens), need, tokens))
    return out


def span_of(template: str) -> int:
    """The least power of two that is not below the template's words."""
    return 1 << (len(re.findall(WORD_PATTERN, template.lower())) - 1).bit_length()


def windows(words: F.Column, spans: list[int], vocab: F.Column) -> F.Column:
    """Windows of twice each span from every span-th word on: any passage of a span's words lies in one."""
    def of(k: int) -> F.Column:
        first = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(k))
        return F.transform(first, lambda i: F.struct(
            i.alias("line"), F.array_intersect(vocab, F.slice(words, i + 1, F.lit(2 * k))).alias("held"),
            F.lit(k).alias("span")))
    return F.flatten(F.array(*map(of, spans)))


def scan(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
         templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
         passages: bool = False) -> DataFrame:
    """Columns ``keep`` (default: all) of each document with the licenses found.

    New columns: n_words, n_base (places of all phrases), first_word and
    last_word (smallest and largest such place, words from 0; null without any),
    base_labels, labels (distinct, sorted, comma-joined; labels also has those of
    templates), score (1 with a phrase, else the greatest containment of a
    template in a line that meets the threshold, else 0), and blocks
    array<struct<line:int,label:string,score:double>>, the lines that meet it.

    With ``passages``, blocks are windows of up to four times a template's words,
    across lines, and ``line`` is a window's first word; labels also has those of
    ``NOTICES``, and score is 1 with one.

    A null or empty text has no words and no labels; an empty table gives no rows.
    Equal scores of a line keep the labels of all their templates. One row for each input row,
    repeated rows too; lines of any length are read whole. Input columns named
    like new ones give way.
    """
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    src = docs.select(F.struct(*[quoted(c) for c in keep]).alias("doc"),
                      F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    # lower() folds more than A-Z, so it serves where more hits do no harm: it leaves
    # word borders as they are and finds every word that folding A-Z would find.
    src = src.withColumn("low", F.lower("text"))
    rows = template_tokens(spark, TEMPLATES if templates is None else templates).collect()
    order = token_order(src, sorted({r[2] for r in rows}))
    spans = [span_of(x) if passages else 0 for _, x in (TEMPLATES if templates is None else templates)]
    prefixes = [(*p, k) for k in sorted(set(spans))
                for p in prefix_table([tuple(r) for r in rows if spans[r[0]] == k], order, threshold)]

    out = with_phrases(src.withColumn("words", words_of(F.col("low"))))
    rare = F.array(*map(F.lit, sorted({p[0] for p in prefixes}))).cast("array<string>")
    vocab = F.array(*map(F.lit, order)).cast("array<string>")
    # The result of an intersection follows the first array: corpus order.
    if passages:
        whole = words_of(folded(F.col("text")))
        lines = windows(whole, sorted(set(spans)), vocab) if spans else F.array().cast(
            "array<struct<line:int,held:array<string>,span:int>>")
        side = F.concat(F.lit(" "), F.array_join(whole, " "), F.lit(" "))
        out = out.withColumn("notices", F.array_compact(F.array(
            *[F.when(F.rlike(side, F.lit(pattern)), F.lit(x)) for pattern, x in NOTICES.items()])))
    else:
        lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(
            i.alias("line"), F.array_intersect(vocab, words_of(folded(x))).alias("held"), F.lit(0).alias("span")))
        out = out.withColumn("notices", F.array().cast("array<string>"))
    lines = F.filter(lines, lambda x: F.arrays_overlap(x["held"], rare))
    out = out.withColumn("lines", F.when(F.arrays_overlap("words", rare), lines))
    base = stored(out.drop("text", "low", "words", "joined").withColumn("rid", F.monotonically_increasing_id()), "licenses")

    sides = spark.createDataFrame(
        prefixes, "token string, label string, i int, size int, need int, tokens array<string>, span int")
    held = base.select("rid", F.explode("lines").alias("x")).select(
        "rid", "x.line", "x.span", "x.held", F.posexplode("x.held").alias("j", "token"))
    n = F.size("held")
    common = F.array_intersect("held", "tokens")
    met = held.join(sides, ["token", "span"]) \
        .where(n >= F.col("need")) \
        .where(F.col("j") <= n - F.col("need")) \
        .where(F.least(F.col("size") - F.col("i"), n - F.col("j")) >= F.col("need")) \
        .withColumn("common", common) \
        .where((F.size("common") >= F.col("need")) & (F.col("common")[0] == F.col("token")))
    blocks = met.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(
        "line", "label", (F.size("common") / F.col("size")).alias("score")))).alias("blocks"))

    out = base.join(blocks, "rid", "left").withColumn(
        "blocks", F.coalesce("blocks", F.array().cast("array<struct<line:int,label:string,score:double>>")))
    best = F.aggregate("blocks", F.lit(0.0), lambda a, b: F.greatest(a, b["score"]))
    labels = F.array_sort(F.array_distinct(F.concat("base_list", "notices", F.transform("blocks", lambda b: b["label"]))))
    new = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"]
    return out.withColumn("score", F.when((F.col("n_base") > 0) | (F.size("notices") > 0), 1.0).otherwise(best)) \
        .withColumn("labels", F.array_join(labels, ",")) \
        .withColumn("base_labels", F.array_join("base_list", ",")) \
        .select(*beside("doc", keep, new))


def with_phrases(df: DataFrame) -> DataFrame:
    """n_words, n_base, first_word, last_word and base_list from the words."""
    may = F.lit(False)
    for last in sorted({p.split()[-1] for p in PHRASES}):
        may = may | F.contains("low", F.lit(last))
    text = F.concat(F.lit(" "), F.array_join(words_of(folded(F.col("text"))), " "), F.lit(" "))
    pattern = " (?:" + "|".join(PHRASES) + ")(?= )"
    df = df.withColumn("n_words", F.size("words").cast("long")) \
        .withColumn("joined", F.when(may, text).otherwise(F.lit(""))) \
        .withColumn("n_base", F.regexp_count("joined", F.lit(pattern)).cast("long"))
    # As many words stand before a place as spaces.
    head = F.regexp_extract("joined", f"(?s)^(.*?){pattern}", 1)
    body = F.regexp_extract("joined", f"(?s)^(.*){pattern}", 1)

    def spaces(c):
        return (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))).cast("long")
    found = F.col("n_base") > 0
    labels = F.array(*[F.when(F.contains("joined", F.lit(f" {p} ")), F.lit(x)) for p, x in PHRASES.items()])
    return df.withColumn("first_word", F.when(found, spaces(head))) \
        .withColumn("last_word", F.when(found, spaces(body))) \
        .withColumn("base_list", F.array_sort(F.array_distinct(F.array_compact(labels))))


def oracle() -> str:
    """The result by its definition: every line against every template."""
    word, upper = WORD_PATTERN, "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

    def words(x):
        return f"regexp_extract_all(translate(coalesce({x}, ''), {upper}), '{word}')"
    texts = ", ".join("({}, '{}', '{}')".format(i, x, t.replace("'", "''")) for i, (x, t) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{p}', '{x}', {len(p.split())})" for p, x in PHRASES.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {words('text')} AS w FROM documents),
t AS (SELECT i, label, list_distinct({words('txt')}) AS tok FROM (VALUES {texts}) AS v(i, label, txt)),
p AS (SELECT * FROM (VALUES {phrases}) AS v(phrase, label, n)),
place AS (SELECT r, q, label FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS q FROM d), p
          WHERE array_to_string(w[q:q + n - 1], ' ') = phrase),
base AS (SELECT r, count(*) AS n_base, min(q) - 1 AS first_word, max(q) - 1 AS last_word,
                list_distinct(list(label)) AS ls FROM place GROUP BY r),
line AS (SELECT r, list_distinct({words('x')}) AS lw FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM d)),
blk AS (SELECT r, label, len(list_intersect(lw, tok)) AS k, len(tok) AS n FROM line, t
        WHERE len(list_intersect(lw, tok)) >= ceil({THRESHOLD} * len(tok) - 1e-9)),
m AS (SELECT r, max(k / n) AS best, list_distinct(list(label)) AS ls FROM blk GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(base.ls), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(m.ls, [])))), ','), '')
         AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN m USING (r)
"""
