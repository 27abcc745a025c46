"""License scan (native: DataFrame functions only).

Words are runs of a-z and 0-9 after lower-casing. For every template length, texts are cut into overlapping windows with as many five-word shingles as the template has,
an eighth of that length apart. A window's MinHash signature is cut into bands; a template is retrieved when a band agrees, and
the match is verified by exact shingle containment: the share of the template's shingles in the window and the words up to its neighbours.
Notices of one family share most of their words. So of the matches of different licenses that overlap in place (by half of the
shorter one) only the best is reported: the greatest containment, then the longest template.

A pair of Jaccard similarity j is retrieved with probability 1 - (1 - j**rows)**bands. A window that holds 80 % of the template has j of at least 2/3
when it is aligned: 0.9999 with the default 16 bands of 2 rows. A window that holds it all collides with certainty.

Windows are made only around anchors: a few words chosen so that a text without any of them cannot hold the wanted share of any
template's shingles. The other windows are left out without loss.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.license_notices import NOTICES

SHINGLE = 5
BROADCAST_ROWS = 20_000

#: Short notices by which works declare their license. Fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


#: The short notices and the whole ones.
ALL_TEMPLATES = TEMPLATES + NOTICES


def plain_words(text: str) -> list[str]:
    out, word = [], ""
    for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text) + " ":
        if "a" <= c <= "z" or "0" <= c <= "9":
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_shingles(words: list[str], size: int = SHINGLE) -> list[str]:
    """Distinct shingles in order; fewer words than a shingle make one."""
    if not words:
        return []
    return list(dict.fromkeys(" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))))


def anchors(shingles: list[list[str]], containment: float) -> list[str]:
    """A few long words such that a text with none of them holds less than ``containment`` of every template's shingles."""
    hit = [set() for _ in shingles]
    need = [len(own) - math.ceil(containment * len(own)) + 1 for own in shingles]
    out = []
    while any(len(h) < n for h, n in zip(hit, need)):
        votes: dict[str, int] = {}
        for own, h, n in zip(shingles, hit, need):
            gains: dict[str, int] = {}
            for s in set(own) - h if len(h) < n else ():
                for w in set(s.split(" ")):
                    gains[w] = gains.get(w, 0) + 1
            for w, gain in gains.items():
                votes[w] = votes.get(w, 0) + min(gain, n - len(h)) * len(w) ** 2
        out.append(max(sorted(votes), key=votes.get))
        for own, h in zip(shingles, hit):
            h.update(s for s in own if out[-1] in s.split(" "))
    return out


def collision_probability(similarity: float, bands: int, rows: int) -> float:
    return 1 - (1 - similarity**rows) ** bands


def words_of(text: Column) -> Column:
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, "[^a-z0-9]+"), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """A shingle for every place; fewer words than a shingle make one."""
    count = F.greatest(F.lit(1), F.size(words) - (SHINGLE - 1))
    return F.transform(F.sequence(F.lit(1), count), lambda i: F.concat_ws(" ", F.slice(words, i, SHINGLE)))


def best_in_place(matches: Column) -> Column:
    """The matches (sorted, best first) without those that lie on a better match of another license."""

    def covered(m: Column, kept: Column) -> Column:
        common = F.least(m["last"], kept["last"]) - F.greatest(m["first"], kept["first"])
        shorter = F.least(m["last"] - m["first"], kept["last"] - kept["first"])
        return (m["license"] != kept["license"]) & (2 * common >= shorter)

    start = F.filter(matches, lambda m: F.lit(False))
    return F.aggregate(matches, start, lambda acc, m: F.when(F.exists(acc, lambda kept: covered(m, kept)), acc).otherwise(F.concat(acc, F.array(m))))


def band_keys(shingles: Column, bands: int, rows: int) -> Column:
    """One key per band: the minima of ``rows`` seeded hashes over the shingles."""

    def least(seed: int) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(seed))))

    return F.array(*(F.xxhash64(F.lit(b), *(least(b * rows + r) for r in range(rows))) for b in range(bands)))


def license_matches(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = ALL_TEMPLATES,
    doc_id: str = "doc_id",
    text: str = "text",
    containment: float = 0.8,
    bands: int = 16,
    rows: int = 2,
) -> DataFrame:
    """One row per document and license found: doc_id, license, containment (the best), first_word, n_words (of that window).

    Null and empty texts and texts without an anchor match nothing. Rows that repeat an id, and rows with a null id, count as
    one document. Templates without words are ignored; without templates the result is empty.
    """
    spark = docs.sparkSession
    known = [(i, name, s) for i, (name, t) in enumerate(templates) if (s := plain_shingles(plain_words(t)))]
    schema = "template int, license string, template_shingles array<string>"
    listed = spark.createDataFrame(known, schema)
    anchor = anchors([s for _, _, s in known], containment)
    if not known:
        return docs.limit(0).select(F.col(doc_id).alias("doc_id")).selectExpr(
            "doc_id", "'' as license", "0D as containment", "0L as first_word", "0L as n_words"
        )
    keyed = listed.select("*", F.posexplode(band_keys(F.col("template_shingles"), bands, rows)).alias("template_band", "template_key"))
    pattern = f"(?i)(?<![a-z0-9])(?:{'|'.join(anchor)})(?![a-z0-9])"
    # A text goes on only if it holds an anchor; only then are its words cut out.
    found = docs.filter(F.col(text).rlike(pattern)).select(F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("words"))
    found = found.withColumn("row", F.monotonically_increasing_id())
    is_anchor = F.transform("words", lambda w, i: F.when(w.isin(anchor), i))
    found = stored(found.withColumn("at", F.filter(is_anchor, lambda i: i.isNotNull())), "licensed-texts")
    lengths = sorted({len(s) for _, _, s in known})

    def starts(n: int) -> Column:
        """Starts of the windows of n shingles that hold an anchor, as multiples of the step."""
        step, reach = max(1, n // 8), n + SHINGLE - 2
        around = F.transform("at", lambda p: F.sequence(F.ceil(F.greatest(p - reach, F.lit(0)) / step).cast("int"), F.floor(p / step).cast("int")))
        return F.transform(F.array_distinct(F.flatten(around)), lambda k: F.struct((k * step).alias("start"), F.lit(n + SHINGLE - 1).alias("length"), F.lit(step - 1).alias("more")))

    at, length, more = F.col("w.start"), F.col("w.length"), F.col("w.more")
    first = F.greatest(at - more, F.lit(0))
    windows = found.select("doc_id", "row", "words", F.explode(F.concat(*(starts(n) for n in lengths))).alias("w")).select(
        "doc_id", "row", length.alias("length"), first.alias("start"), F.slice("words", at + 1, length).alias("own"), F.slice("words", first + 1, at - first + length + more).alias("wide")
    )
    # The rows of a Generate are made once; a projection's expressions would be copied into each of the many uses below.
    pair = F.struct(shingles_of(F.col("own")).alias("own"), shingles_of(F.col("wide")).alias("wide"))
    windows = windows.select("doc_id", "row", "length", "start", F.size("wide").alias("n_words"), F.explode(F.array(pair)).alias("shingles"))
    banded = windows.select("*", F.posexplode(band_keys(F.col("shingles.own"), bands, rows)).alias("band", "key"))
    # The templates are an argument, so the size of this table is known: a row per template and band. Beyond the bound it is shuffled.
    if len(known) * bands <= BROADCAST_ROWS:
        keyed = F.broadcast(keyed)
    # Only windows of the template's own length: a longer one would add up the shingles of several notices.
    own_length = F.col("length") == F.size("template_shingles") + (SHINGLE - 1)
    met = banded.join(keyed, (F.col("band") == F.col("template_band")) & (F.col("key") == F.col("template_key")) & own_length)
    share = F.size(F.array_intersect("template_shingles", "shingles.wide")) / F.size("template_shingles")
    verified = met.withColumn("containment", share).filter(F.col("containment") >= containment)
    own = F.transform("shingles.wide", lambda x, i: F.when(F.array_contains("template_shingles", x), i + F.col("start")))
    placed = verified.select(
        "doc_id", "row", "license", (-F.col("containment")).alias("c"), (-F.size("template_shingles")).alias("size"), "start", "n_words",
        F.array_min(own).alias("first"), (F.array_max(own) + SHINGLE).alias("last"),
    )
    # Windows that see a match at the same place say the same.
    placed = placed.groupBy("doc_id", "row", "license", "first", "last").agg(F.min(F.struct("c", "size", "start", "n_words")).alias("b"))
    match = F.struct("b.c", "b.size", "license", "first", "last", "b.start", "b.n_words")
    by_text = placed.groupBy("doc_id", "row").agg(F.array_sort(F.collect_list(match)).alias("matches"))
    verified = by_text.select("doc_id", F.explode(best_in_place(F.col("matches"))).alias("m")).select("doc_id", "m.*")
    best = F.min(F.struct("c", "start", "n_words"))
    return verified.groupBy("doc_id", "license").agg(best.alias("best")).select(
        "doc_id", "license", (-F.col("best.c")).alias("containment"), F.col("best.start").cast("long").alias("first_word"),
        F.col("best.n_words").cast("long").alias("n_words"),
    )

