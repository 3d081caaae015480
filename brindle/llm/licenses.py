"""License scan: exact containment join of spans of text with license templates, in DataFrame functions only.

A span of a template is a run of words somewhat longer than the template, wherever lines, blank lines or sentences end. Tokens
are ordered by their frequency over the whole corpus, rarest first. A span that holds a share t of a template's distinct
tokens holds one of the template's first |T| - ceil(t |T|) + 1, so only surroundings of such tokens are joined; the length
filter and the positional filter leave few to verify, and verification counts distinct tokens span by span. Of matches that
meet, one whose tokens in the text belong to a better one too gives way to it.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import common

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same class by what it holds: Java's expressions take a twelfth of the time for it.
SIGNS = r"0-9a-z\x80-\x{10FFFF}"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The share of a template's distinct tokens that a block must hold; of templates below ``SHORT`` tokens, all.
THRESHOLD, SHORT = 0.8, 10
#: The phrases of the base labels, and templates of notices by label.
PHRASES = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("apache", "you may not use this file except in compliance with the License"),
    ("apache", "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "GNU Lesser General Public License"),
    ("lgpl", "GNU Library General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "BSD License"),
    ("bsd", "BSD 3-Clause"),
    ("bsd", "BSD 2-Clause"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "ISC License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("mpl", "Mozilla Public License"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("epl", "Eclipse Public License"),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("boost", "Boost Software License"),
    ("zlib", "In no event will the authors be held liable for any damages arising from the use of this software"),
    ("cc-by", "CC BY 4.0"),
    ("cc-by-nc", "CC BY-NC 4.0"),
    ("cc-by-nd", "CC BY-ND 4.0"),
    ("cc-by-sa", "CC BY-SA 4.0"),
    ("cc-by-nc-nd", "CC BY-NC-ND 4.0"),
    ("cc-by-nc-sa", "CC BY-NC-SA 4.0"),
    ("cc-by", "Creative Commons Attribution"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial"),
    ("cc-by-nd", "Creative Commons Attribution-NoDerivatives"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike"),
    ("cc-by-nc-nd", "Creative Commons Attribution-NonCommercial-NoDerivatives"),
    ("cc-by-nc-sa", "Creative Commons Attribution-NonCommercial-ShareAlike"),
    ("cc0", "Released under CC0 1.0 Universal, no rights reserved"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "All rights reserved."),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl", "SPDX-License-Identifier: GPL"),
    ("lgpl", "SPDX-License-Identifier: LGPL"),
    ("agpl", "SPDX-License-Identifier: AGPL"),
    ("bsd", "SPDX-License-Identifier: BSD"),
    ("isc", "SPDX-License-Identifier: ISC"),
    ("mpl", "SPDX-License-Identifier: MPL"),
    ("epl", "SPDX-License-Identifier: EPL"),
    ("boost", "SPDX-License-Identifier: BSL-1.0"),
    ("zlib", "SPDX-License-Identifier: Zlib"),
    ("cc0", "SPDX-License-Identifier: CC0-1.0"),
    ("cc-by", "SPDX-License-Identifier: CC-BY"),
    ("cc-by-nc", "SPDX-License-Identifier: CC-BY-NC"),
    ("cc-by-nd", "SPDX-License-Identifier: CC-BY-ND"),
    ("cc-by-sa", "SPDX-License-Identifier: CC-BY-SA"),
    ("cc-by-nc-nd", "SPDX-License-Identifier: CC-BY-NC-ND"),
    ("cc-by-nc-sa", "SPDX-License-Identifier: CC-BY-NC-SA"),
    ("unlicense", "SPDX-License-Identifier: Unlicense"),
]
#: Words of the longest span at most: spans begin in a stretch of so many words, and stretches are judged with as many words
#: before and twice as many behind, so that all that meets such a span is there.
STRETCH = 64


def lowered(text: Column) -> Column:
    """A-Z lower-cased, for words of ASCII to be compared: other letters may change, but none becomes ASCII (the Kelvin
    sign, the one that would, is replaced before) and none stops being part of a word."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))


def words(text: Column) -> Column:
    """Words of a lowered text."""
    return F.regexp_extract_all(text, F.lit(f"[{SIGNS}]+"), F.lit(0))


def base_hits(w: Column) -> Column:
    """(label, first word) of every place where a base phrase's words stand one after another."""

    def at(x: Column, i: Column) -> Column:
        found = F.lit(None).cast("struct<label:string,start:int>")
        for label, phrase in PHRASES.items():
            before = [F.get(w, i - (len(phrase) - 1 - k)) == p for k, p in enumerate(phrase[:-1])]
            same = x == phrase[-1]
            for b in before:
                same = same & b
            found = F.when(same, F.struct(F.lit(label).alias("label"), (i - (len(phrase) - 1)).cast("int").alias("start"))).otherwise(found)
        return found

    none = F.array().cast("array<struct<label:string,start:int>>")
    return F.when(F.array_contains(w, "license"), F.filter(F.transform(w, at), lambda h: h.isNotNull())).otherwise(none)


def template_tokens() -> list[tuple[str, list[str], int]]:
    """(label, distinct tokens, words of a span) of each template."""
    out = []
    for label, text in TEMPLATES:
        w = re.findall(WORD, text.lower())
        out.append((label, sorted(set(w)), 2 + -(-len(w) * 5 // 4) if len(w) > 5 else 1 + len(w)))
    return out


def needed(n: int, threshold: float = THRESHOLD) -> int:
    """How many of n distinct tokens a block must hold."""
    return n if n < SHORT else math.ceil(threshold * n - 1e-9)


def _table(spark: SparkSession, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """Literal rows; lists become arrays."""
    value = lambda v: F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)
    return spark.range(1).select(F.inline(F.array(*(F.struct(*(value(v).alias(n) for n, v in zip(names, r))) for r in rows))))


def scan(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans), one for each row.

    n_spans counts the matches: spans, by their first word, that begin with a token of a template, reach the threshold for it
    and give way to none. score is the largest containment of a match, 1 where a base phrase stands, 0 where nothing is found.
    Null and empty texts have no words and no labels; whole texts of any length are looked at; repeated rows each have their
    own result; null ids stay null.
    """
    spark = df.sparkSession
    templates = template_tokens()
    universe = sorted({t for _, tokens, _ in templates for t in tokens})
    texts = common.ids_and_texts(df, id_col, text_col).withColumn("text", lowered(F.col("text")))
    known = F.array(*map(F.lit, universe))
    counted = texts.select(F.explode(F.array_intersect(words(F.col("text")), known)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    frequency = {r["token"]: r["n"] for r in counted.collect()}  # one row a template token at most
    order = sorted(universe, key=lambda t: (frequency.get(t, 0), t))
    rank = {t: i for i, t in enumerate(order)}

    prefixes, sets = [], []
    for k, (label, tokens, span) in enumerate(templates):
        ranks = sorted(rank[t] for t in tokens)
        need = needed(len(ranks), threshold)
        sets.append((k, label, ranks, len(ranks), need, span))
        prefixes += [(r, k, p, len(ranks), need) for p, r in enumerate(ranks[: len(ranks) - need + 1])]
    prefix_tokens = F.array(*map(F.lit, sorted({order[p[0]] for p in prefixes})))

    # one pass: words, base hits, and the stretches around prefix tokens
    rows = texts.select("doc_id", words(F.col("text")).alias("w"))
    places = F.filter(F.transform("w", lambda x, i: F.when(F.array_contains(prefix_tokens, x), F.floor(i / STRETCH).cast("int"))), lambda i: i.isNotNull())
    numbers = F.array_distinct(F.flatten(F.transform(F.array_distinct(places), lambda k: F.array(k - 1, k))))
    some = F.transform(F.filter(numbers, lambda k: k >= 0), lambda k: F.struct(k.alias("stretch"), F.slice("w", F.greatest(F.lit(0), (k - 1) * STRETCH) + 1, F.least(k + 1, F.lit(2)) * STRETCH + 2 * STRETCH).alias("words")))
    none = F.array().cast("array<struct<stretch:int,words:array<string>>>")
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), base_hits(F.col("w")).alias("hits"), F.when(F.arrays_overlap("w", prefix_tokens), some).otherwise(none).alias("stretches"))
    rows = common.staged(rows.withColumn("row", F.monotonically_increasing_id()), "licenses-rows")

    to_rank = F.create_map(*(x for t, r in rank.items() for x in (F.lit(t), F.lit(r))))
    stretch = rows.select("row", F.inline("stretches"))
    at = F.filter(F.transform("words", lambda x, i: F.struct(F.element_at(to_rank, x).alias("rank"), (i + F.greatest(F.lit(0), (F.col("stretch") - 1) * STRETCH)).alias("at"))), lambda h: h["rank"].isNotNull())
    stretch = stretch.select("row", "stretch", at.alias("at")).withColumn("ranks", F.array_sort(F.array_distinct(F.transform("at", lambda h: h["rank"]))))
    stretch = stretch.where(F.size("ranks") >= min(s[4] for s in sets))
    prefix = _table(spark, prefixes, ("rank", "template", "first", "size", "need"))
    whole = _table(spark, sets, ("template", "label", "tokens", "size", "need", "span"))
    probe = stretch.select("row", "stretch", "ranks", "at", F.posexplode("ranks").alias("pos", "rank"))
    # both tables have as many rows as the templates have tokens: broadcast whatever the corpus
    pairs = probe.join(F.broadcast(prefix), "rank").where((F.size("ranks") >= F.col("need")) & (F.least(F.col("size") - F.col("first"), F.size("ranks") - F.col("pos")) >= F.col("need")))
    # a pair passes at most once a prefix token: the first common token stands for it
    first = F.array_min(F.array_intersect("ranks", "tokens")) == F.col("rank")
    both = F.size(F.array_intersect("ranks", "tokens"))
    verified = pairs.select("row", "stretch", "ranks", "at", "rank", "template").join(F.broadcast(whole), "template").where(first & (both >= F.col("need")))
    # each span of the template that begins with one of its tokens, with what it has of them
    own = F.filter("at", lambda h: F.array_contains("tokens", h["rank"]))
    verified = verified.select("row", "stretch", "label", "tokens", "size", "need", "span", own.alias("own"))
    within = lambda s: F.filter("own", lambda h: (h["at"] >= s["at"]) & (h["at"] < s["at"] + F.col("span")))
    spans = F.transform("own", lambda s: F.struct(s["at"].alias("start"), F.array_max(F.transform(within(s), lambda h: h["at"])).alias("end"), F.array_distinct(F.transform(within(s), lambda h: h["rank"])).alias("has")))
    found = verified.select("row", "stretch", "label", "tokens", "size", F.inline(F.filter(spans, lambda s: F.size(s["has"]) >= F.col("need"))))
    found = found.withColumn("containment", F.size("has") / F.col("size"))
    # a stretch has the matches of at most as many starts as it has words, for each template
    met = found.groupBy("row", "stretch").agg(F.collect_list(F.struct("label", "tokens", "size", "start", "end", "has", "containment")).alias("m"))
    better = lambda t, u: ((u["containment"] > t["containment"]) | ((u["containment"] == t["containment"]) & (u["size"] > t["size"]))) & (u["start"] <= t["end"]) & (t["start"] <= u["end"]) & (F.size(F.array_except(t["has"], u["tokens"])) == 0)
    home = lambda t: F.floor(t["start"] / STRETCH) == F.col("stretch")
    left = F.filter("m", lambda t: home(t) & ~F.exists("m", lambda u: better(t, u)))
    reached = met.select("row", left.alias("m")).where(F.size("m") > 0)
    labels = reached.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set(F.array_distinct(F.transform("m", lambda t: t["label"]))))).alias("found"), F.max(F.array_max(F.transform("m", lambda t: t["containment"]))).alias("containment"), F.sum(F.size("m")).alias("n_spans"))

    out = rows.select("row", "doc_id", "n_words", "hits").join(labels, "row", "left")
    starts, base = F.transform("hits", lambda h: h["start"]), F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["label"])))
    hit = F.size("hits") > 0
    return out.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_base"),
        F.when(hit, F.array_min(starts)).cast("long").alias("first_word"),
        F.when(hit, F.array_max(starts)).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(hit, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).cast(T.DoubleType()).alias("score"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
    )
