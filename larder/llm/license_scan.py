"""Licences in texts, by diagonal voting between the words of texts and of templates.

Only DataFrame functions run on the rows. The method:

1. A text's words give rolling runs of four words, each hashed with its place. The
   templates (notices and clauses of licences, by their labels) give the same, but for
   runs of common words alone.
2. Texts and templates are joined on the hashes. A text that holds a passage of a
   template has many hits on one diagonal, the place in the text less that in the template.
3. Hits are counted by text, template and diagonal. Where words were put in or left out, the
   passage goes on along a neighbouring diagonal: diagonals at most eight words apart are
   merged, and the hits of a merged group give a span of the text.
4. A span is verified word by word: hits count where the four words are the template's own.
   The share of the template's words under such hits is the span's score. A label is
   given where the share reaches what its template asks for: all words of a short notice, as
   versions differ in one word, four fifths of a long one.

Besides, three phrases are base labels wherever their words follow each other.

The templates are few and their number is checked, so their hashes are also a literal
table: a text none of whose runs is in it leaves before the join, in the scan and without a
shuffle. Most texts are told by their words alone, as a shared run holds an uncommon
word of a template. What is left is stored with its words; diagonals, spans and the verification
move only such texts, by a row number, so copies of a text don't meet in one task.

Score: 1 where a base phrase or a whole template stands, else the largest verified share.

Defined results: a null text is empty and has no words, labels or places (score 0); rows that
repeat, also with the same id, each get their own result; null ids stay; an empty table
gives an empty result; other columns, whatever their names, are not touched.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import stored, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Templates: label and passage. Several passages may have one label.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                   "implied. See the License for the specific language governing permissions and limitations under the License."),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
            "for more details."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0"),
)
# Words too common to tell texts apart: runs of these alone have no vote.
COMMON = frozenset((
    "a all an and any are as at be by can do even for from if in into is it may must not of on one or so that the this to "
    "under was with you your").split())
RUN = 4
APART = 8
SHORT_NOTICE = 20
LONG_SHARE = 0.8
MOST_TEMPLATE_RUNS = 100_000
LITERAL_CELLS = 1 << 12


# --- words and templates --------------------------------------------------

def words_of(text: str) -> list[str]:
    """The words of a template, as `worded` cuts a text."""
    lowered = "".join(c.lower() if c in UPPER else c for c in text)
    return [w for w in re.split(BETWEEN, lowered) if w]


def worded(text: Column) -> Column:
    """The words of a text in an array, A-Z in lower case; empty if there are none."""
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def _hash(words: Column, i: Column, run: int) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(run)])


def voting_runs(passage: str, run: int = RUN) -> list[tuple[int, list[str]]]:
    """The runs of a passage with their places; runs of common words alone have no vote."""
    words = words_of(passage)
    runs = [(at, words[at:at + run]) for at in range(len(words) - run + 1)]
    return [(at, r) for at, r in runs if not COMMON.issuperset(r)]


def template_runs(spark: SparkSession, templates=TEMPLATES, run: int = RUN) -> DataFrame:
    """Every voting run of every template: hash, template, at. Templates shorter than a run have none.

    An Arrow table becomes a local relation, so executors start no Python for it.
    """
    rows = [
        {"template": i, "at": at, "words": words}
        for i, (_, passage) in enumerate(templates) for at, words in voting_runs(passage, run)]
    if len(rows) > MOST_TEMPLATE_RUNS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_RUNS} runs are not to be broadcast")
    kinds = pa.schema([("template", pa.int32()), ("at", pa.int32()), ("words", pa.list_(pa.string()))])
    frame = spark.createDataFrame(pa.Table.from_pylist(rows, schema=kinds))
    return frame.select(_hash(F.col("words"), F.lit(0), run).alias("hash"), "template", "at")


def words_asked(passage: str, run: int = RUN) -> int:
    """The number of a passage's words that stand in a voting run."""
    return len({at + k for at, _ in voting_runs(passage, run) for k in range(run)})


def anchors(templates=TEMPLATES, run: int = RUN) -> list[str]:
    """The longest uncommon word of every voting run: a text that shares a run holds one of these."""
    return sorted({
        min(words, key=lambda w: (w in COMMON, -len(w), w))
        for _, passage in templates for _, words in voting_runs(passage, run)})


def _literal(value: str, kind: str) -> Column:
    """A constant array from JSON; the optimizer folds it."""
    return F.from_json(F.lit(value), kind)


def _lookup(hashes: list[int]) -> Column:
    """Cells of the known hashes as a literal: a hash is known if its cell holds it."""
    cells: list[list[int]] = [[] for _ in range(LITERAL_CELLS)]
    for h in sorted(set(hashes)):
        cells[h % LITERAL_CELLS].append(h)
    return _literal(json.dumps(cells), "array<array<bigint>>")


# --- base labels ----------------------------------------------------------

def phrase_places(words: Column, spaced: Column, phrase: str) -> Column:
    """Places where a phrase's words follow each other, looked for only in texts that may hold it."""
    first, *rest = phrase.split()

    def stands(i: Column) -> Column:
        return F.reduce(F.array(*[F.get(words, i + k) == w for k, w in enumerate(rest, start=1)]), F.lit(True),
                        lambda a, b: a & F.coalesce(b, F.lit(False)))

    places = F.filter(F.transform(words, lambda w, i: F.when((w == first) & stands(i), i)), lambda i: i.isNotNull())
    return F.when(spaced, places).otherwise(F.array().cast("array<int>"))


# --- diagonals ------------------------------------------------------------

def hits(texts: DataFrame, runs: DataFrame, run: int = RUN) -> DataFrame:
    """All pairs of equal runs of a text and a template: uid, template, place, at."""
    places = F.sequence(F.lit(0), F.size("words") - run)
    rolling = F.transform(places, lambda i: F.struct(i.alias("place"), _hash(F.col("words"), i, run).alias("hash")))
    return texts.where(F.size("words") >= run).select("uid", F.explode(rolling).alias("r")).select("uid", "r.*").join(
        F.broadcast(runs), "hash").select("uid", "template", "place", "at")


def merged_diagonals(found: DataFrame, apart: int = APART) -> DataFrame:
    """Hits voted by diagonal, and neighbouring diagonals merged: votes and where each group lies.

    What is ordered is one row per diagonal of a text and a template.
    """
    votes = found.groupBy("uid", "template", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.collect_list("at").alias("at"))
    along = Window.partitionBy("uid", "template").orderBy("diagonal")
    is_new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > apart, F.lit(True))
    placed = votes.withColumn("is_new", is_new.cast("int"))
    grouped = placed.withColumn("island", F.sum("is_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("uid", "template", "island").agg(
        F.sum("votes").alias("votes"), F.collect_list(F.struct("diagonal", "at")).alias("diagonals"))


def verified(groups: DataFrame, texts: DataFrame, templates=TEMPLATES, run: int = RUN) -> DataFrame:
    """Each group with its span in the text and the share of the template's words that stand there."""
    words = _literal(json.dumps([words_of(passage) for _, passage in templates]), "array<array<string>>")
    asked = _literal(json.dumps([words_asked(passage, run) for _, passage in templates]), "array<int>")
    pairs = F.flatten(F.transform("diagonals", lambda d: F.transform(
        d["at"], lambda at: F.struct((d["diagonal"] + at).alias("place"), at.alias("at")))))
    own = groups.join(texts.select("uid", "words"), "uid").select(
        "uid", "template", "votes", "words", F.get(words, F.col("template")).alias("passage"),
        F.get(asked, F.col("template")).alias("asked"), pairs.alias("pairs"))
    equal = F.filter("pairs", lambda p: F.slice("words", p["place"] + 1, run) == F.slice("passage", p["at"] + 1, run))
    met = own.select("uid", "template", "votes", "asked", equal.alias("equal")).where(F.size("equal") > 0)
    under = F.size(F.array_distinct(F.flatten(F.transform(
        "equal", lambda p: F.sequence(p["at"], p["at"] + run - 1)))))
    return met.select(
        "uid", "template", "votes", "asked",
        F.array_min(F.transform("equal", lambda p: p["place"])).alias("start"),
        (F.array_max(F.transform("equal", lambda p: p["place"])) + run).alias("end"),
        (under / F.col("asked")).alias("share"))


def is_accepted(share: Column, asked: Column) -> Column:
    return share >= F.when(asked <= SHORT_NOTICE, F.lit(1.0)).otherwise(F.lit(LONG_SHARE))


# --- scan -----------------------------------------------------------------

def candidates(
    docs: DataFrame, runs: DataFrame, id_column: str, text_column: str, templates=TEMPLATES, run: int = RUN,
) -> DataFrame:
    """Every text with its base results; those that share a run with a template keep their words.

    The words are looked through for anchors first, which is far cheaper than hashing runs.
    """
    words = F.col("words")
    known = _lookup([r["hash"] for r in runs.select("hash").collect()])

    def is_known(h: Column) -> Column:
        return F.array_contains(F.get(known, F.pmod(h, F.lit(LITERAL_CELLS)).cast("int")), h)

    places = F.sequence(F.lit(0), F.greatest(F.size(words) - run, F.lit(0)))
    shares = F.exists(F.transform(places, lambda i: _hash(words, i, run)), is_known)
    anchored = F.arrays_overlap(words, _literal(json.dumps(anchors(templates, run)), "array<string>"))
    meets = F.when((F.size(words) >= run) & anchored, shares)
    cut = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_column).alias("id"),
        *[F.lower(text_of(text_column)).rlike("(?s)" + r"[^a-z]+".join(p.split())).alias(f"may_{i}")
          for i, p in enumerate(PHRASES)],
        worded(text_of(text_column)).alias("words"))
    return cut.select(
        "uid", "id", F.size(words).cast("long").alias("n_words"),
        *[phrase_places(words, F.col(f"may_{i}"), p).alias(f"places_{i}") for i, p in enumerate(PHRASES)],
        F.when(meets, words).alias("words"))


def scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates=TEMPLATES, run: int = RUN,
) -> DataFrame:
    """Licences of every text: words, places and labels of the base phrases, all labels, score."""
    runs = template_runs(docs.sparkSession, templates, run)
    texts = stored(candidates(docs, runs, id_column, text_column, templates, run))
    shared = texts.where("words IS NOT NULL").select("uid", "words")
    spans = verified(merged_diagonals(hits(shared, runs, run)), shared, templates, run)
    labels = F.get(_literal(json.dumps([label for label, _ in templates]), "array<string>"), F.col("template"))
    voted = spans.groupBy("uid").agg(
        F.collect_set(F.when(is_accepted(F.col("share"), F.col("asked")), labels)).alias("own"),
        F.max("share").alias("share"))

    places = [F.col(f"places_{i}") for i in range(len(PHRASES))]
    every = F.concat(*places)
    base = F.array_sort(F.filter(F.array(*[
        F.when(F.size(p) > 0, F.lit(label)) for p, label in zip(places, PHRASES.values())]), lambda x: x.isNotNull()))
    none = F.array().cast("array<string>")
    narrow = texts.select(
        "uid", "id", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"), base.alias("base"))
    return narrow.join(voted, "uid", "left").select(
        F.col("id").alias(id_column), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.coalesce("own", none)))), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
