"""License scans: windows of a text's words compared with licence wordings by the Dice coefficient of their word bigrams.

Text is normalised (lower case, only letters, digits and characters beyond ASCII make words) and read across line ends, so
wrapped and embedded notices are found. A template of b bigrams can reach coefficient t only with windows of t/(2-t)*b to
(2-t)/t*b distinct bigrams that share some of a few necessary bigrams, so most texts meet no template: bigrams are looked
up in the broadcast list of necessary ones within the scan's stage, and only candidate texts are compared in full.

Windows have at most (2-t)/t*b bigrams. The best one begins and ends with a bigram of the template, as dropping another
bigram at an end never lowers the coefficient, so only such windows are compared. Of windows that overlap the one with the
largest coefficient counts, then the one with more words, then the first.

Defined results: null, empty and wordless texts match nothing; a text of one word has no bigram and matches nothing;
among equal windows the first template by name counts; repeated documents give equal rows. Whole texts are
read, however long. Other columns are kept by ``scan_licenses``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import NOT_WORD, broadcast_if_small, literal_rows, lower_ascii, table, words, written

MIN_DICE = 0.8

# Wordings of common licence notices.
TEMPLATES: dict[str, Sequence[str]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "CC-BY-NC-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "All-rights-reserved": ("All rights reserved.",),
}


def normalised(text: Column) -> Column:
    """The words of a line: A-Z in lower case, everything but letters, digits and characters beyond ASCII taken as blank."""
    return words(lower_ascii(text), NOT_WORD)


def bigrams(line_words: Column) -> Column:
    """Distinct pairs of neighbouring words; empty for fewer than two words."""
    starts = F.sequence(F.lit(1), F.size(line_words) - 1)
    pairs = F.transform(starts, lambda i: F.array_join(F.slice(line_words, i, 2), " "))
    return F.when(F.size(line_words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def bigram_key(word: Column, following: Column) -> Column:
    """Bigrams are looked up by this number; should two have the same, the full comparison tells them apart."""
    return F.xxhash64(word, following)


def bounds(size: int, min_dice: float) -> tuple[int, int]:
    """Least and most bigrams of a line that can reach ``min_dice`` with a template of ``size`` bigrams."""
    low, high = min_dice / (2 - min_dice) * size, (2 - min_dice) / min_dice * size
    return math.ceil(low - 1e-9), math.floor(high + 1e-9)


def wordings(spark: SparkSession, templates: Mapping[str, Sequence[str]], min_dice: float) -> tuple[DataFrame, DataFrame]:
    """(wordings with bigrams and size bounds, bigrams of which every match of a wording holds one).

    A match shares at least ceil(t/(2-t)*b) of a template's b bigrams, so it holds one of any b minus that plus one of
    them. Those with the longest words are taken: they are rare in running text.
    """
    rows = [(i, name, w) for i, (name, w) in enumerate((n, w) for n in sorted(templates) for w in templates[n])]
    named = literal_rows(spark, rows, ("wording", "license", "text"))
    kept, necessary = [], []
    for row in named.select("wording", "license", bigrams(normalised(F.col("text"))).alias("own")).collect():
        size = len(row.own)
        if size:
            low, high = bounds(size, min_dice)
            kept.append((row.wording, row.license, row.own, size, low, high))
            rare = sorted(row.own, key=lambda b: (-max(map(len, b.split())), b))
            necessary += [(b, row.wording, low) for b in rare[: size - low + 1]]
    return (
        literal_rows(spark, kept, ("wording", "license", "own", "size", "low", "high")),
        literal_rows(spark, necessary, ("bigram", "wording", "low")),
    )


def license_lines(texts: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, min_dice: float = MIN_DICE) -> DataFrame:
    """(text_key, line, license, dice): the notices of each text by the line they begin on; ``texts`` has (text_key, text).

    Equal texts with equal keys give one row per notice. Lines count from 1.
    """
    if not 0 < min_dice <= 1:
        raise ValueError("min_dice must be above 0 and at most 1")
    known, necessary = wordings(texts.sparkSession, templates, min_dice)
    split = texts.select("text_key", normalised(F.col("text")).alias("words"))
    # Outer, so that Spark does not split each text a second time to look for empty ones; their null words match nothing.
    pairs = split.select("text_key", "words", F.posexplode_outer("words").alias("at", "word"))
    pairs = pairs.where(F.col("at") < F.size("words") - 1).select(
        "text_key", F.size("words").alias("n"), bigram_key(F.col("word"), F.element_at("words", F.col("at") + 2)).alias("bigram")
    )
    necessary = necessary.select(bigram_key(*[F.split("bigram", " ")[i] for i in (0, 1)]).alias("bigram"), "wording", "low")
    # The templates are a given list of bounded size, so both of their tables are broadcast.
    met = pairs.join(F.broadcast(necessary), "bigram").where(F.col("n") - 1 >= F.col("low"))
    candidates = written(met.select("text_key", "wording").distinct(), "license-candidates")
    keys = candidates.select("text_key").distinct()
    # Copies of a text become one before they leave their task.
    once = texts.join(broadcast_if_small(keys), "text_key", "left_semi").groupBy("text_key").agg(F.min("text").alias("text"))
    once = once.select(
        "text_key", normalised(F.col("text")).alias("words"),
        F.flatten(F.transform(F.split("text", "\n"), lambda x, i: F.array_repeat(i + 1, F.size(normalised(x))))).alias("lines"),
    )
    once = once.withColumn("pairs", F.zip_with("words", F.slice("words", 2, F.size("words")), lambda a, b: F.concat_ws(" ", a, b)))
    sized = once.join(broadcast_if_small(candidates), "text_key").join(F.broadcast(known), "wording")
    # Places (from 1) of the template's bigrams; the last word begins none.
    places = F.filter(
        F.transform("pairs", lambda x, i: F.when((i < F.size("words") - 1) & F.array_contains("own", x), i + 1)), lambda x: x.isNotNull()
    )
    hits = sized.select("text_key", "license", "own", "size", "low", "high", "words", "lines", places.alias("hits"))
    hits = hits.where(F.size("hits") >= F.col("low")).select("*", F.posexplode("hits").alias("k", "first"))
    last = F.slice("hits", F.col("k") + F.col("low"), F.col("high") - F.col("low") + 1)
    hits = hits.select(
        "text_key", "license", "own", "size", "low", "high", "first", F.get("lines", F.col("first") - 1).alias("line"),
        F.slice("words", F.col("first"), F.col("high") + 1).alias("near"),
        F.filter(last, lambda e: e - F.col("first") < F.col("high")).alias("last"),
    )
    def scored(end: Column) -> Column:
        found = bigrams(F.slice("near", 1, end - F.col("first") + 2))
        # The pairs are made once: a one-element list binds them to a name.
        dice = F.get(F.transform(F.array(found), lambda pairs: 2 * F.size(F.array_intersect(pairs, F.col("own"))) / (F.size(pairs) + F.col("size"))), F.lit(0))
        return F.struct((end + 1).alias("end"), dice.alias("dice"))

    # Of the windows with one start, those that a shorter one beats can never count: whatever rules out the shorter one
    # rules them out too. The others can, if a longer one overlaps a better match.
    nothing = F.struct(F.lit(min_dice).alias("best"), F.array().cast("array<struct<end:int,dice:double>>").alias("kept"))
    ahead = F.aggregate(
        F.transform("last", scored), nothing,
        lambda front, w: F.when(w["dice"] >= front["best"], F.struct(w["dice"].alias("best"), F.concat(front["kept"], F.array(w)).alias("kept"))).otherwise(front),
        lambda front: front["kept"],
    )
    matched = hits.select("text_key", "license", "line", "first", F.inline(ahead))
    order = F.struct((-F.col("dice")).alias("key"), (F.col("first") - F.col("end")).alias("length"), "first", "license", "end", "line")
    ranked = matched.groupBy("text_key").agg(F.array_sort(F.collect_list(order)).alias("windows"))
    none = F.slice("windows", 1, 0)
    chosen = F.aggregate("windows", none, lambda kept, w: F.when(
        F.exists(kept, lambda k: (k["first"] <= w["end"]) & (w["first"] <= k["end"])), kept).otherwise(F.concat(kept, F.array(w))))
    found = ranked.select("text_key", F.explode(chosen).alias("w"))
    return found.select("text_key", F.col("w.line").alias("line"), F.col("w.license").alias("license"), (-F.col("w.key")).alias("dice"))


def scan_licenses(docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, min_dice: float = MIN_DICE) -> DataFrame:
    """``docs`` (with ``text``) and ``matches``: an array of (line, license, dice) in line order, empty for none."""
    key = F.md5(F.coalesce("text", F.lit("")))
    found = license_lines(docs.select(key.alias("text_key"), "text"), templates, min_dice)
    match = F.struct("line", "license", "dice")
    per_text = written(found.groupBy("text_key").agg(F.array_sort(F.collect_list(match)).alias("_matches")), "license-lines")
    own = [F.col(f"`{c}`") for c in docs.columns if c != "matches"]
    joined = docs.withColumn("_key", key).join(broadcast_if_small(per_text.withColumnRenamed("text_key", "_key")), "_key", "left")
    none = F.array().cast(per_text.schema["_matches"].dataType)
    return joined.select(*own, F.coalesce("_matches", none).alias("matches"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: licence notices found, the licences by name, and the best coefficient."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = scan_licenses(docs)
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return scanned.select(
        "doc_id", F.size("matches").cast("bigint").alias("n_notices"), F.array_join(names, ",").alias("licenses"),
        F.round(F.coalesce(F.array_max(F.transform("matches", lambda m: m["dice"])), F.lit(0.0)), 6).alias("best_dice"),
    )
