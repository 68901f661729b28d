"""License scans: base phrases, and an exact set-similarity join with templates.

A block of a text, for a template of n words, is any run of ceil(n / threshold)
consecutive words, over line ends too.  It matches when it holds at least
``threshold`` of the template's distinct words.  Each text is split once:

1. A text keeps the template words that it holds.  Their counts over all texts
   give the order of words, rarest first; a text without enough of a template's
   words anywhere can't match it (length filter) and keeps no places of words.
2. A matching block has one of the template's first |T| - need + 1 words
   (prefix filter).  Around each place of one, the words that a block with it
   can hold must be enough, on both sides of it in the order (positional
   filter).
3. What passes is verified: the distinct template words of every block there.

DataFrame expressions only.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .state import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0"],
    "gpl-3": ["This work is licensed under the GNU General Public License, version 3"],
    "gpl-2": ["This program is licensed under the GNU General Public License, version 2"],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License"],
    "cc-by-4.0": ["Licensed under CC BY 4.0"],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0"],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0"],
    "mit-notice": ["Released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License"],
}


def template_sets(templates: dict[str, list[str]], threshold: float) -> list[tuple[str, list[str], int, int]]:
    """(label, distinct words, words needed, words of a block) of each body."""
    out = []
    for label, bodies in templates.items():
        for body in bodies:
            words = re.findall(WORD, body.lower())
            own = sorted(set(words))
            out.append((label, own, max(1, math.ceil(len(own) * threshold - 1e-9)), math.ceil(len(words) / max(threshold, 0.1) - 1e-9)))
    return out


def _words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased.  lower() does more, which no
    result shows: of characters beyond ASCII only the Kelvin sign would become
    an ASCII letter by itself, so another stands in for it."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u212b")))
    return F.array_remove(F.split(plain, _BETWEEN), "")


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words: A-Z lower-cased, then runs of 0-9, a-z and characters beyond ASCII.
    n_base: places where a phrase of PHRASES stands as consecutive words, with
    the smallest and largest start (null without any).  labels: the phrases'
    and the templates'.  score: 1 where a phrase stands, else the greatest
    share of a matching template's words in one block, else 0.

    A null text is empty; a null key is a key like others; rows equal in key
    and text get equal results, one row each; an empty table gives no rows;
    other columns are not read.
    """
    spark = docs.sparkSession
    sets = template_sets(templates, threshold)
    vocabulary = sorted({w for _, own, _, _ in sets for w in own})
    strings = lambda words: F.array(*map(F.lit, words))

    rows = docs.select(F.col(key).alias("k"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), _words(F.col(text)).alias("w"))
    rows = rows.select("k", "h", "w", F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("p"), F.array_intersect(strings(vocabulary), "w").alias("own"))
    enough = F.lit(False)
    for _, words, need, _ in sets:
        enough = enough | (F.size(F.array_intersect("own", strings(words))) >= need)
    held = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("at"), x.alias("word"))), lambda s: F.array_contains(F.col("own"), s["word"]))
    there = F.lit(False)
    for phrase in PHRASES:
        there = there | F.contains("p", F.lit(f" {phrase} "))
    rows = rows.select("k", "h", "p", F.size("w").cast("long").alias("n_words"), "own", F.when(enough, held).alias("held"), there.alias("there"))
    any_phrase = "|".join(PHRASES)
    first = F.regexp_extract("p", f"(?s)^(.*?)(?<= )(?:{any_phrase})(?= )", 1)
    last = F.regexp_extract("p", f"(?s)^(.*)(?<= )(?:{any_phrase})(?= )", 1)
    labels = F.array_compact(F.array(*(F.when(F.contains("p", F.lit(f" {p} ")), F.lit(x)) for p, x in PHRASES.items())))
    rows = rows.select(
        "k", "h", "n_words", "own", "held",
        F.when(F.col("there"), F.regexp_count("p", F.lit(f"(?<= )(?:{any_phrase})(?= )"))).otherwise(0).cast("long").alias("n_base"),
        F.when(F.col("there"), _spaces(first) - 1).cast("long").alias("first_word"),
        F.when(F.col("there"), _spaces(last) - 1).cast("long").alias("last_word"),
        F.when(F.col("there"), labels).otherwise(F.array().cast("array<string>")).alias("base"),
    )
    rows = written(rows, "words")

    counted = rows.select(F.explode("own").alias("x")).groupBy("x").count()
    frequency = {r["x"]: r["count"] for r in counted.collect()}  # at most the templates' words
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}
    index = []
    for i, (label, words, need, wide) in enumerate(sets):
        order = sorted(words, key=rank.__getitem__)
        for at, word in enumerate(order[: len(order) - need + 1]):
            index.append((word, i, label, at, len(order), need, order, wide))
    prefixes = spark.createDataFrame(index, "word string, template int, label string, at int, n int, need int, words array<string>, wide int")
    most = max(x[3] for x in sets)

    some = rows.where("held is not null").select("k", "h", "held").distinct()
    starts = F.filter("held", lambda s: F.array_contains(strings(sorted({x[0] for x in index})), s["word"]))
    spots = some.select("k", "h", F.explode(F.transform(starts, lambda s: F.struct(s["at"].alias("at"), s["word"].alias("word"), F.filter("held", lambda x: F.abs(x["at"] - s["at"]) < most).alias("near")))).alias("s"))
    pairs = spots.select("k", "h", F.col("s.at").alias("place"), "s.word", "s.near").join(F.broadcast(prefixes), "word")  # a few words a template
    # the template's words that a block with this place can hold, in the order of rarity
    near = F.filter("near", lambda x: (F.abs(x["at"] - F.col("place")) < F.col("wide")) & F.array_contains(F.col("words"), x["word"]))
    pairs = pairs.withColumn("near", near)
    pairs = pairs.withColumn("ordered", F.array_intersect("words", F.transform("near", lambda x: x["word"])))
    before = F.array_position("ordered", F.col("word")) - 1
    possible = F.least(F.col("n") - F.col("at"), F.size("ordered") - before) + F.least(F.col("at"), before)
    pairs = pairs.where((F.size("ordered") >= F.col("need")) & (possible >= F.col("need")))
    blocks = F.filter(F.transform("near", lambda x: x["at"]), lambda a: a <= F.col("place"))
    in_block = lambda a: F.size(F.array_distinct(F.transform(F.filter("near", lambda x: (x["at"] >= a) & (x["at"] < a + F.col("wide"))), lambda x: x["word"])))
    pairs = pairs.select("k", "h", "label", "n", "need", F.array_max(F.transform(blocks, in_block)).alias("most")).where(F.col("most") >= F.col("need"))
    matched = pairs.groupBy("k", "h").agg(F.collect_set("label").alias("found"), F.max(F.col("most") / F.col("n")).alias("share"))

    m = matched.select(F.col("k").alias("mk"), F.col("h").alias("mh"), "found", "share")
    out = rows.join(m, F.col("k").eqNullSafe(F.col("mk")) & (F.col("h") == F.col("mh")), "left")
    return out.select(
        F.col("k").alias(key), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
