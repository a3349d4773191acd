"""License scan by diagonal voting, with DataFrame functions only.

Every rolling group of K words of every text is joined with the positions of the
same words in the notice templates. A match votes for the diagonal `position in
the text - position in the template`. Neighbouring diagonals, which differ by
words put in or left out, are merged to a span, and a span counts if enough of the
template's groups were really found in it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import staged

# Phrases that count wherever they stand, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Sentences of public license notices, with the label each stands for. Versions
# are left out where the label has none, so that any version may follow.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "licensed under the apache license"),
    ("apache-2.0", "apache license version 2.0"),
    ("apache-2.0", "under the apache license 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("mit", "under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "under the terms of the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "under the gnu gpl"),
    ("gpl", "gnu gpl v2"),
    ("gpl", "gnu gpl v3"),
    ("gpl", "gnu gpl version"),
    ("lgpl", "under the gnu lesser general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("lgpl", "under the gnu lgpl"),
    ("agpl", "gnu affero general public license"),
    ("agpl", "under the gnu agpl"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "under the bsd license"),
    ("bsd", "3 clause bsd license"),
    ("bsd", "2 clause bsd license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("mpl-2.0", "mozilla public license 2.0"),
    ("mpl-2.0", "mozilla public license version 2.0"),
    ("epl", "under the eclipse public license"),
    ("cc-by", "licensed under cc by"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-nc-sa", "cc by nc sa"),
    ("cc-by-nc-nd", "cc by nc nd"),
    ("cc-by", "creative commons attribution"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by-sa", "creative commons attribution share alike"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-nc", "creative commons attribution non commercial"),
    ("cc-by-nd", "creative commons attribution noderivatives"),
    ("cc-by-nd", "creative commons attribution noderivs"),
    ("cc-by-nc-sa", "creative commons attribution noncommercial sharealike"),
    ("cc-by-nc-nd", "creative commons attribution noncommercial noderivatives"),
    ("cc-by-nc-nd", "creative commons attribution noncommercial noderivs"),
    ("cc0", "creative commons zero"),
    ("cc0", "creative commons cc0"),
    ("cc0", "dedicated to the public domain under the creative commons zero license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

# Identifiers in `SPDX-License-Identifier:` lines, without their versions where the label has none.
SPDX = [
    ("apache-2.0", "Apache-2.0"), ("mit", "MIT"), ("isc", "ISC"), ("gpl", "GPL"), ("lgpl", "LGPL"), ("agpl", "AGPL"),
    ("bsd", "BSD"), ("mpl-2.0", "MPL-2.0"), ("epl", "EPL"), ("cc-by", "CC-BY"), ("cc-by-sa", "CC-BY-SA"),
    ("cc-by-nc", "CC-BY-NC"), ("cc-by-nd", "CC-BY-ND"), ("cc-by-nc-sa", "CC-BY-NC-SA"),
    ("cc-by-nc-nd", "CC-BY-NC-ND"), ("cc0", "CC0"), ("unlicense", "Unlicense"),
]
TEMPLATES += [(label, f"SPDX-License-Identifier {name}") for label, name in SPDX]

K = 3  # words of a group
NEAR = 3  # diagonals this close are one span
COVERAGE = 0.75  # share of a template's groups that a span needs

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z only) words; of null text, none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(_WORDS), F.lit(0))


def _groups(words: Column) -> Column:
    """The text of each group of K words, in order."""
    every = F.transform(
        words,
        lambda w, i: F.when(
            F.get(words, i + (K - 1)).isNotNull(),
            F.concat_ws(" ", w, *(F.get(words, i + j) for j in range(1, K))),
        ),
    )
    return F.filter(every, lambda g: g.isNotNull())


def _likely_groups(words: Column) -> Column:
    """`pos, group` of the groups whose words all stand at their place in some template's group.

    No other group can join, so its text need not be built.
    """
    split = [re.findall("[0-9a-z]+", text.lower()) for _, text in TEMPLATES]
    at = [sorted({t[i + j] for t in split for i in range(len(t) - K + 1)}) for j in range(K)]

    def group(w: Column, i: Column) -> Column:
        rest = [F.get(words, i + j) for j in range(1, K)]
        fits = w.isin(at[0])
        for word, allowed in zip(rest, at[1:]):
            fits &= word.isin(allowed)
        return F.when(fits, F.struct(i.alias("pos"), F.concat_ws(" ", w, *rest).alias("group")))

    return F.filter(F.transform(words, group), lambda g: g.isNotNull())


def _template_groups(df: DataFrame) -> DataFrame:
    """`template, label, n_groups, t_pos, group, group_hash`; its size is that of TEMPLATES."""
    rows = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text")) for i, (label, text) in enumerate(TEMPLATES)))
    one = df.sparkSession.range(1).select(F.inline(rows))
    return (
        one.select("template", "label", words_of(F.col("text")).alias("words"))
        .select("template", "label", _groups(F.col("words")).alias("groups"))
        .select("template", "label", F.size("groups").alias("n_groups"), F.posexplode("groups").alias("t_pos", "group"))
        .withColumn("group_hash", F.xxhash64("group"))
    )


def read_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, text_hash, n_words, places, groups` of each row: all that the texts are read for."""
    words = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), words_of(F.col(text)).alias("words")
    )
    return words.select(
        "doc_id",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        _base_places(F.col("words")).alias("places"),
        _likely_groups(F.col("words")).alias("groups"),
    )


def license_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, text_hash, label, template, first_word, end_word, coverage`, a row per verified span.

    Rows with equal identifier and text give their spans once; a span within another
    one is part of it. Null and empty texts give none. Nothing but the two named
    columns is read.
    """
    return _spans(read_texts(docs, doc_id, text))


def _spans(read: DataFrame) -> DataFrame:
    groups = read.select("doc_id", "text_hash", F.inline("groups")).withColumn("group_hash", F.xxhash64("group"))
    # The template side is a constant list of this module, so its size is bounded.
    hits = groups.join(F.broadcast(_template_groups(read)), ["group_hash", "group"])
    votes = hits.groupBy(
        "doc_id", "text_hash", "template", "label", "n_groups", (F.col("pos") - F.col("t_pos")).alias("diagonal")
    ).agg(F.min("pos").alias("low"), F.max("pos").alias("high"), F.collect_set("t_pos").alias("found"))
    of_template = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    begins = F.col("diagonal") - F.lag("diagonal").over(of_template) > NEAR
    numbered = votes.withColumn("begins", F.coalesce(begins.cast("int"), F.lit(0))).withColumn(
        "span", F.sum("begins").over(of_template)
    )
    spans = numbered.groupBy("doc_id", "text_hash", "template", "label", "n_groups", "span").agg(
        F.min("low").alias("first_word"),
        (F.max("high") + K).alias("end_word"),
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n_found"),
    )
    coverage = F.col("n_found") / F.col("n_groups")
    dense = F.col("end_word") - F.col("first_word") <= F.col("n_groups") + K - 1 + 2 * NEAR
    verified = spans.withColumn("coverage", coverage).filter((F.col("coverage") >= COVERAGE) & dense)
    # `cc by nc` inside `cc by nc sa` is no license of its own: what lies within a longer span goes.
    earlier = (
        Window.partitionBy("doc_id", "text_hash")
        .orderBy("first_word", F.desc("end_word"), "template")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.coalesce(F.max("end_word").over(earlier), F.lit(0))
    return verified.withColumn("reached", reached).filter("end_word > reached").select(
        "doc_id", "text_hash", "label", "template", "first_word", "end_word", "coverage"
    )


def _base_places(words: Column) -> Column:
    """`(place, label)` of each base phrase, in order of place."""

    def at(w: Column, i: Column) -> Column:
        found = F.lit(None).cast("struct<place:int,label:string>")
        for phrase, label in BASE_PHRASES.items():
            first, *rest = phrase.split()
            same = w == first
            for j, word in enumerate(rest, 1):
                same &= F.get(words, i + j).eqNullSafe(F.lit(word))
            here = F.struct(i.alias("place"), F.lit(label).alias("label"))
            found = F.when(same, here).otherwise(found)
        return found

    return F.filter(F.transform(words, at), lambda x: x.isNotNull())


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per input row: `doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`.

    `score` is 1 where a base phrase stands, else the best span's coverage, else
    0. Null and empty texts have no words, no labels and score 0; repeated rows
    stay repeated; a null identifier is a value like another.
    """
    read = staged(read_texts(docs, doc_id, text), "license-reads")
    base = read.select(
        "doc_id",
        "text_hash",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.get("places.place", F.lit(0)).cast("long").alias("first_word"),
        F.get("places.place", F.size("places") - 1).cast("long").alias("last_word"),
        F.array_distinct("places.label").alias("base"),
    )
    own = _spans(read).groupBy(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash")).agg(
        F.collect_set("label").alias("own"), F.max("coverage").alias("coverage")
    )
    joined = base.join(
        own,
        base["doc_id"].eqNullSafe(own["own_id"]) & (base["text_hash"] == own["own_hash"]),
        "left",
    )
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.concat_ws(",", F.array_sort("base")).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("base", F.coalesce("own", none)))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("coverage", F.lit(0.0))).alias("score"),
    )
