"""License scans: phrases word by word, and notices by an exact set-similarity join of text blocks with templates."""

from __future__ import annotations

import math
import string
from collections import Counter
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.session import ensure_checkpoint_dir

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# The opening words of well-known license notices, and the label of each.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
# The share of a template's different words that a block must hold.
CONTAINMENT = Fraction(4, 5)
# Words: runs of digits, lower-case letters and everything beyond ASCII, once A-Z are lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"


def lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"{WORD}+"), F.lit(0))


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def places(words: Column, held: Column, phrase: str) -> Column:
    """The places (from 0) where a phrase starts. Places are only looked at in texts that hold all of its words."""
    parts = phrase.split()
    last = F.greatest(F.size(words) - len(parts), F.lit(0))

    def here(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found &= F.get(words, i + k).eqNullSafe(F.lit(part))
        return found

    none = F.array().cast("array<int>")
    possible = F.size(F.array_intersect(held, _strings(parts))) == len(parts)
    return F.when(possible, F.filter(F.sequence(F.lit(0), last), here)).otherwise(none)


def template_index(docs: DataFrame, templates: list[tuple[str, str]], least: Fraction) -> list[tuple]:
    """(token, position, label, tokens, needed, span) of every prefix token of every template.

    Tokens of a template are ordered by the number of documents that hold them, over all documents, rarest first. A block
    with ``needed`` of a template's n tokens lacks at most n - needed, so it holds one of the first n - needed + 1: the
    template's prefix. ``span`` is the number of words of a block that goes over line ends: as large a share of it may be
    words that are not the template's as a block may lack of the template. The counts that reach the driver are one row per different word of the templates.
    """
    vocabulary = sorted({w for _, text in templates for w in text.split()})
    held = F.array_intersect(words_of(lower(F.col("text"))), _strings(vocabulary))
    found = docs.select(F.explode(held).alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()
    count = Counter({r["token"]: r["n"] for r in found})
    index = []
    for label, text in templates:
        tokens = sorted(set(text.split()), key=lambda w: (count[w], w))
        needed = math.ceil(least * len(tokens))
        span = math.ceil(len(text.split()) / least)
        index += [(t, p, label, tokens, needed, span) for p, t in enumerate(tokens[: len(tokens) - needed + 1])]
    return index


def similar_blocks(texts: DataFrame, index: list[tuple]) -> DataFrame:
    """key, label, score of every text of ``texts`` (key, text in lower case, its words) with a block that holds enough of a
    template. Blocks are the lines and, since notices are wrapped, all stretches of ``span`` words, whatever lines they are on.

    An exact join of texts and templates on prefix tokens, since a block holds no more than its text. A text has to have
    enough words (length filter). A pair counts once, at the first template token it shares, and goes on if that many tokens
    before it can be missing (positional filter). Only texts that hold enough of a template are looked at block by block:
    line by line, and in a stretch from each word of the template on, as another one holds no more than the next of these.
    The template side is a fixed list and is broadcast.
    """
    spark = texts.sparkSession
    schema = "token string, position int, label string, tokens array<string>, needed int, span int"
    templates = F.broadcast(spark.createDataFrame(index, schema))
    prefixes = sorted({row[0] for row in index})
    vocabulary = sorted({token for row in index for token in row[3]})
    held = texts.withColumn("held", F.array_intersect("words", _strings(vocabulary)))
    held = held.filter(F.size("held") >= min(row[4] for row in index))
    probes = held.select("key", "text", "words", "held", F.explode(F.array_intersect("held", _strings(prefixes))).alias("token"))
    size, words = F.size("tokens"), F.col("words")
    pairs = probes.join(templates, "token").filter(
        (F.size("held") >= F.col("needed"))
        & (size - F.col("position") >= F.col("needed"))
        & ~F.arrays_overlap(F.slice("tokens", F.lit(1), F.col("position")), F.col("held"))
        & (F.size(F.array_intersect("tokens", "held")) >= F.col("needed"))
    )
    common = lambda block: F.size(F.array_intersect("tokens", block))
    starts = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_contains("tokens", F.get(words, i - 1)))
    in_lines = F.array_max(F.transform(F.split("text", "\n"), lambda line: common(words_of(line))))
    in_stretches = F.array_max(F.transform(starts, lambda i: common(F.slice(words, i, F.col("span")))))
    found = pairs.select("key", "label", "needed", size.alias("size"), F.greatest(in_lines, in_stretches).alias("common"))
    return found.filter(F.col("common") >= F.col("needed")).select("key", "label", (F.col("common") / F.col("size")).alias("score"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, least: Fraction = CONTAINMENT) -> DataFrame:
    """Per document: its words, the places of the base phrases, base labels, all labels, the score.

    The score is the largest share of a template found in one block, a line or a stretch over line ends, from ``least`` on, 1
    where a phrase stands, else 0. Null text is empty. Labels are a matter of the text alone: they are found once per different text (by SHA-256) that holds a
    prefix token, and joined back to slim rows without text.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    index = template_index(docs, TEMPLATES if templates is None else templates, least)
    words, text = F.col("words"), F.col("lowered")
    prefixes = _strings(sorted({row[0] for row in index}))
    rows = docs.withColumn("lowered", lower(F.col("text"))).withColumn("words", words_of(text))
    parts = sorted({w for phrase in PHRASES for w in phrase.split()})
    rows = rows.withColumn("held", F.array_intersect(words, _strings(parts)))
    found = {label: F.col(f"places_{i}") for i, label in enumerate(PHRASES.values())}
    rows = rows.withColumns({f"places_{i}": places(words, F.col("held"), phrase) for i, phrase in enumerate(PHRASES)})
    every = F.concat(*found.values())
    key = F.when(F.arrays_overlap(words, prefixes), F.sha2("text", 256))
    slim = rows.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        every.alias("every"),
        F.array_compact(F.array(*[F.when(F.size(p) > 0, label) for label, p in found.items()])).alias("base"),
        # Texts without a prefix token match nothing, each under a key of its own.
        F.coalesce(key, F.concat(F.lit("-"), F.col("doc_id").cast("string")), F.lit("-")).alias("key"),
    )
    texts = rows.select(key.alias("key"), F.col("lowered").alias("text"), "words").filter("key IS NOT NULL")
    matches = (
        similar_blocks(texts, index)
        .groupBy("key", "label").agg(F.max("score").alias("score"))
        .groupBy("key").agg(F.sort_array(F.collect_list("label")).alias("more"), F.max("score").alias("found"))
        .withColumnRenamed("key", "its_key")
        .checkpoint()  # a table of its own, so that a text with very many copies can be split in the join
    )
    joined = slim.join(matches, F.col("key") == F.col("its_key"), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        "n_words",
        F.size("every").cast("long").alias("n_base"),
        F.array_min("every").cast("long").alias("first_word"),
        F.array_max("every").cast("long").alias("last_word"),
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("every") > 0, F.lit(1.0)).otherwise(F.coalesce("found", F.lit(0.0))).alias("score"),
    )


def oracle(templates: list[tuple[str, str]] = TEMPLATES, least: Fraction = CONTAINMENT) -> str:
    """The same as SQL for texts whose notices are not wrapped: every line against every template."""
    pattern = f"'{WORD}+'"
    low = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    phrases = ", ".join(f"({p.split()!r}, '{label}')" for p, label in PHRASES.items())
    known = ", ".join(
        f"('{label}', {sorted(set(t.split()))!r}, {math.ceil(least * len(set(t.split())))})" for label, t in templates
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {low} AS low FROM documents),
w AS (SELECT r, doc_id, low, regexp_extract_all(low, {pattern}) AS words FROM d),
phrases(parts, label) AS (VALUES {phrases}),
starts AS (
    SELECT r, label, unnest(list_filter(range(0, len(words)), lambda i: words[i + 1 : i + len(parts)] = parts)) AS place
    FROM w, phrases WHERE list_has_all(words, parts)
),
base AS (
    SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
    FROM starts GROUP BY r
),
known(label, tokens, needed) AS (VALUES {known}),
lines AS (SELECT r, list_distinct(regexp_extract_all(unnest(string_split(low, chr(10))), {pattern})) AS block FROM w),
hits AS (
    SELECT r, label, len(list_intersect(tokens, block)) / len(tokens) AS score
    FROM lines, known WHERE len(list_intersect(tokens, block)) >= needed
),
more AS (SELECT r, list(DISTINCT label) AS labels, max(score) AS score FROM hits GROUP BY r)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
    first_word, last_word,
    coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ','), '') AS labels,
    CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(more.score, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN base ON w.r = base.r LEFT JOIN more ON w.r = more.r
"""
