"""License notices in texts, by an exact set-similarity join of text blocks with notice templates."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialis.llm.common import written

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
STEP = 32
MATCH = "array<struct<start:bigint,label:string,template:int,phrase:boolean,end:bigint,containment:double,places:array<bigint>>>"


@dataclass(frozen=True)
class Template:
    """A notice: its label, its words, and the least share of its distinct words that a block has to hold, in percent.

    A phrase counts only where its words stand one after another.
    """

    label: str
    text: str
    percent: int = 80
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(SEPARATORS, self.text.lower()) if w]

    @property
    def need(self) -> int:
        """Distinct words that a block needs."""
        return -(-self.percent * len(set(self.words)) // 100)


# The phrases and the opening words of published licenses.
TEMPLATES = (
    Template("mit", "mit license", 100, True),
    Template("apache", "apache license", 100, True),
    Template("gpl", "general public license", 100, True),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                    "and associated documentation files"),
    Template("mit", "SPDX-License-Identifier: MIT", 100),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("apache", "SPDX-License-Identifier: Apache-2.0", 100),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                    "General Public License as published by the Free Software Foundation", 90),
    Template("lgpl", "Lesser General Public License", 100),
    Template("agpl", "Affero General Public License", 100),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                    "that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                    "is hereby granted"),
    Template("mpl", "Mozilla Public License", 100),
    Template("epl", "Eclipse Public License", 100),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
    Template("cc-by", "Creative Commons Attribution", 100),
    Template("cc-by-nc", "CC BY-NC 4.0", 100),
    Template("cc-by-sa", "CC BY-SA 4.0", 100),
)


def words_of(text: Column) -> Column:
    """Words of ASCII letters and digits and of all characters beyond ASCII, as they are written; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def _one_of(word: Column, known: Sequence[str]) -> Column:
    """Whether a word, its ASCII letters lower-cased, is one of some ASCII words."""
    return F.lower(word).isin(list(known)) & (F.octet_length(word) == F.char_length(word))


def word_ranks(texts: DataFrame, text: str, templates: Sequence[Template]) -> dict[str, int]:
    """Place of each template word, rarest first, by its count over all texts.

    Only words of templates are counted: others cannot be common to a block and
    a template, so their place does not matter. The driver gets one number per template word.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    found = texts.select(F.explode(words_of(texts[text])).alias("w")).filter(_one_of(F.col("w"), vocabulary))
    counts = dict(found.groupBy(F.lower("w").alias("w")).count().collect())
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def _template_rows(docs: DataFrame, templates: Sequence[Template], ranks: dict[str, int]) -> DataFrame:
    """A row for each prefix token of each template: with all but ``need - 1`` of its rarest words it cannot be missed."""
    rows = []
    for number, t in enumerate(templates):
        tokens = sorted({ranks[w] for w in t.words})
        line = [ranks[w] for w in t.words]
        for place, token in enumerate(tokens[:len(tokens) - t.need + 1]):
            rows.append((token, place, number, t.label, t.phrase, t.need, tokens, line))
    return docs.sparkSession.createDataFrame(
        rows, "token int, place int, template int, label string, phrase boolean, need int, wanted array<int>, line array<int>")


def _blocks(docs: DataFrame, doc_id: str, text: str, templates: Sequence[Template], ranks: dict[str, int], step: int) -> DataFrame:
    """(row, doc_id, n_words, blocks): every document with those of its blocks that hold a prefix token of a template.

    Block k holds the words from ``k * step`` on, ``2 * step`` of them, as
    ranks, null for words of no template.
    """
    by_rank = sorted(ranks, key=ranks.get)
    prefixes = {by_rank[r] for t in templates
                for r in sorted({ranks[w] for w in t.words})[:len(set(t.words)) - t.need + 1]}
    number = F.create_map(*[F.lit(x) for w, r in ranks.items() for x in (w, r)])
    rank = lambda w: F.when(_one_of(w, by_rank), F.try_element_at(number, F.lower(w)))
    split = docs.select(docs[doc_id].alias("doc_id"), words_of(docs[text]).alias("words"))
    block = lambda k: F.slice("words", k * step + 1, F.lit(2 * step))
    numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("words") / step).cast("int") - 1))
    hit = F.filter(numbers, lambda k: F.exists(block(k), lambda w: _one_of(w, sorted(prefixes))))
    blocks = F.transform(hit, lambda k: F.struct(k.alias("k"), F.transform(block(k), rank).alias("codes")))
    rows = split.select("doc_id", F.size("words").cast("bigint").alias("n_words"), blocks.alias("blocks"))
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "license-blocks")


def _found(rows: DataFrame, templates: DataFrame, least: int, step: int) -> DataFrame:
    """(row, matches): blocks joined with templates by prefix tokens, filtered by length and position, verified on whole sets."""
    blocks = rows.select("row", F.explode("blocks").alias("b")).select("row", "b.k", "b.codes")
    blocks = blocks.withColumn("tokens", F.array_sort(F.array_distinct(F.array_compact("codes"))))
    size = F.size("tokens")
    probes = blocks.filter(size >= least).select(
        "row", "k", "codes", "tokens", F.posexplode(F.slice("tokens", F.lit(1), size - least + 1)).alias("q", "token"))
    met = probes.join(F.broadcast(templates), "token").filter(
        F.least(F.size("tokens") - F.col("q"), F.size("wanted") - F.col("place")) >= F.col("need"))
    met = met.withColumn("common", F.array_intersect("tokens", "wanted")).filter(
        (F.size("common") >= F.col("need")) & (F.array_min("common") == F.col("token")))
    here = F.filter(F.sequence(F.lit(0), F.least(F.lit(step), F.size("codes")) - 1),
                    lambda i: F.slice("codes", i + 1, F.size("line")) == F.col("line"))
    first = F.col("k").cast("bigint") * step
    places = F.when(F.col("phrase"), F.transform(here, lambda i: first + i)).otherwise(F.array().cast("array<bigint>"))
    met = met.withColumn("places", places).filter(~F.col("phrase") | (F.size("places") > 0))
    match = F.struct(
        first.alias("start"), "label", "template", "phrase", (first + F.size("codes")).alias("end"),
        (F.size("common") / F.size("wanted")).alias("containment"), "places")
    return met.groupBy("row").agg(F.array_sort(F.collect_list(match)).alias("matches"))


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: Sequence[Template] = TEMPLATES, step: int = STEP,
) -> DataFrame:
    """(doc_id, n_words, matches) of every row; a match is a block of words that holds enough of a template.

    A text's blocks overlap: each has ``2 * step`` words and starts ``step``
    after the one before, so a passage of up to ``step`` words lies whole in one of
    them. Words are compared with ASCII letters lower-cased. Block and template are sets
    of words in one order, rarest first over all texts. A block that holds ``need`` of a template's
    words shares one of the template's first ``m - need + 1`` with it (prefix
    filter), has ``need`` words of templates (length filter) and has enough of them from the common
    one on (positional filter); what is left is verified on the whole sets. A phrase counts
    only where its words stand in a row; ``places`` are their word numbers, from 0,
    and each place is given by the one block whose first half it starts in.

    The templates are a parameter and few, so their prefix tokens are broadcast;
    texts never move, only the rows of blocks that matched.

    A null or empty text has no words and no matches; ids may be null or repeat:
    each row is judged by itself; an empty table gives no rows. Other columns are not used.
    """
    longest = max(len(t.words) for t in templates)
    if longest > step:
        raise ValueError(f"step has to be {longest} at least, the words of the longest template")
    ranks = word_ranks(docs, text, templates)
    rows = _blocks(docs, doc_id, text, templates, ranks, step)
    found = _found(rows, _template_rows(docs, templates, ranks), min(t.need for t in templates), step)
    joined = rows.select("row", "doc_id", "n_words").join(found, "row", "left")
    return joined.select("doc_id", "n_words", F.coalesce("matches", F.array().cast(MATCH)).alias("matches"))


def _labels(matches: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts, first and last place, labels and the best containment of each row of ``scan``."""
    phrases = F.filter("matches", lambda m: m["phrase"])
    places = F.flatten(F.transform(phrases, lambda m: m["places"]))
    rows = found.select("doc_id", "n_words", "matches", phrases.alias("phrases"), places.alias("places"))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        _labels(F.col("phrases")).alias("base_labels"), _labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("score"))


def as_sql(templates: Sequence[Template] = TEMPLATES, step: int = STEP) -> str:
    """The same digest of ``documents`` in DuckDB's SQL: every block against every template."""
    listed = lambda t: "[" + ", ".join(f"'{w}'" for w in t.words) + "]"
    values = ",\n  ".join(f"({i}, '{t.label}', {str(t.phrase).lower()}, {t.need}, {listed(t)})" for i, t in enumerate(templates))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH t(template, label, phrase, need, line) AS (VALUES
  {values}),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT r, k, list_slice(ws, k * {step} + 1, k * {step} + {2 * step}) AS ws
  FROM (SELECT r, ws, unnest(range(0, greatest(1, (len(ws) + {step} - 1) // {step}))) AS k FROM d)),
m AS (
  SELECT r, k, ws, t.*, len(list_intersect(list_distinct(ws), line)) / len(list_distinct(line)) AS containment
  FROM b JOIN t ON len(list_intersect(list_distinct(ws), list_distinct(line))) >= need),
p AS (
  SELECT *, CASE WHEN phrase THEN list_transform(list_filter(range(0, least({step}, len(ws))),
    lambda i: list_slice(ws, i + 1, i + len(line)) = line), lambda i: k * {step} + i) ELSE [] END AS places FROM m),
a AS (
  SELECT r, sum(len(places)) AS n_base, min(list_min(places)) AS first_word, max(list_max(places)) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(containment) AS score
  FROM p WHERE NOT phrase OR len(places) > 0 GROUP BY r)
SELECT doc_id, len(ws) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0) AS score
FROM d LEFT JOIN a USING (r)"""
