"""License scans by diagonal voting, in DataFrame operations only.

Every document's rolling word k-grams are hashed and joined to the positions of the same
k-grams in license templates. A match votes for its diagonal, document position less
template position. A copy of a template puts its votes on one diagonal; a word put in or
left out moves the rest to a neighbour, so neighbouring diagonals of a document
and template are merged. A merged span is verified by how much of the template it covers.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import SEPARATORS_SQL, ascii_lower_col

K = 3
#: Diagonals at most so far apart are one copy.
SLACK = 4
#: Share of a template's k-grams that a span must hold.
COVER = 0.6
#: Templates are parameters of the code, not data; beyond this many k-grams they are
#: joined without a broadcast hint.
BROADCAST_GRAMS = 100_000

# Phrases of the base scan and their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Notices as licenses word them.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
            "the Software."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                 "compliance with the License."),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3", "is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
)


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def words_col(text: Column) -> Column:
    """Words of a text (null is empty), A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower_col(F.coalesce(text, F.lit(""))), SEPARATORS_SQL), "")


def _gram_hash(words: list) -> Column:
    return F.xxhash64(*words)


def template_grams(spark: SparkSession, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """``h, template, label, base, at, n_grams`` for each k-gram of each template and phrase."""
    rows = []
    for number, (label, text, base) in enumerate([(*p, True) for p in phrases] + [(*t, False) for t in templates]):
        w = template_words(text)
        if len(w) < K:
            raise ValueError(f"a template needs at least {K} words: {text!r}")
        rows += [(number, label, base, i, len(w) - K + 1, *w[i:i + K]) for i in range(len(w) - K + 1)]
    names = [f"w{j}" for j in range(K)]
    frame = spark.createDataFrame(rows, "template int, label string, base boolean, at int, n_grams int, " + ", ".join(f"{n} string" for n in names))
    return frame.select(F.xxhash64(*names).alias("h"), "template", "label", "base", "at", "n_grams")


def votes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """``row, doc_id, n_words, template, label, base, at, n_grams, pos``: a row for every
    k-gram of a document that a template has, and one with nulls for a document without any.

    ``row`` numbers the input's rows by partition and position."""
    grams = template_grams(docs.sparkSession, templates, phrases)
    # As many numbers as the templates have k-grams, whatever the documents.
    hashes = sorted({r["h"] for r in grams.select("h").collect()})
    ends = sorted({w for _, text in (*templates, *phrases) for w in template_words(text)[K - 1:]})
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), words_col(F.col(text_col)).alias("w"))
    # A k-gram is hashed only where its last word ends some template's k-gram.
    rolled = F.transform("w", lambda x, i: F.when((i >= K - 1) & x.isin(ends), F.struct(
        (i - (K - 1)).alias("pos"), F.xxhash64(*[F.get("w", i - (K - 1) + j) for j in range(K)]).alias("h"))))
    hits = words.select("row", id_col, F.size("w").cast("long").alias("n_words"),
                        F.explode_outer(F.filter(rolled, lambda g: g.isNotNull() & g["h"].isin(hashes))).alias("g"))
    hits = hits.select("row", id_col, "n_words", "g.pos", "g.h")
    return hits.join(F.broadcast(grams) if len(hashes) <= BROADCAST_GRAMS else grams, "h", "left").drop("h")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES,
         slack: int = SLACK, cover: float = COVER) -> DataFrame:
    """One row per document: ``doc_id, n_words, places, score``; ``places`` is an array of
    (start, last, label, base, cover), words from 0, sorted by start.

    A base phrase needs all its votes on one diagonal. A template's neighbouring diagonals
    (at most ``slack`` apart, spans at most a template apart) are merged; the span is a
    place if its votes cover ``cover`` of the longer of template and span. ``score`` is
    the best cover of any place, 0 without one.

    Null text is empty and has no words. Rows are handled one by one, so null or repeated
    ids and repeated rows keep their own results. An empty table gives no rows. Other
    columns are ignored, whatever their names.
    """
    voted = votes(docs, id_col, text_col, templates, phrases).withColumn("d", F.col("pos") - F.col("at"))
    by = ["row", id_col, "n_words", "template", "label", "base", "n_grams"]
    lines = voted.groupBy(*by, "d").agg(F.count("pos").alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("top"))
    along = Window.partitionBy("row", "template").orderBy("d")
    near = (F.col("d") - F.lag("d").over(along) <= slack) & (F.col("first") - F.lag("top").over(along) <= F.col("n_grams"))
    numbered = lines.withColumn("new", F.when(near & ~F.col("base"), 0).otherwise(1)).withColumn(
        "copy", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = numbered.groupBy(*by, "copy").agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("top").alias("top"))
    held = F.col("votes") / F.greatest(F.col("n_grams"), F.col("top") - F.col("first") + 1)
    place = F.struct(F.col("first").alias("start"), (F.col("top") + K - 1).alias("last"), "label", "base",
                     F.least(held, F.lit(1.0)).alias("cover"))
    right = F.when(F.col("base"), held >= 1).otherwise(held >= cover)
    return merged.groupBy("row", id_col, "n_words").agg(F.array_sort(F.collect_list(F.when(right, place))).alias("places")).select(
        id_col, "n_words", "places", F.coalesce(F.array_max(F.transform("places", lambda p: p["cover"])), F.lit(0.0)).alias("score"))


def digest_columns(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and label strings of :func:`scan`."""
    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"].cast("long"))
    return scanned.select(id_col, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                          F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"),
                          labels(F.col("places")).alias("labels"), "score")
