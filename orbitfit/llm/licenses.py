"""Licence scan: a paragraph classifier with an unknown class, confirmed by templates.

Paragraphs are runs of lines that hold a word, joined by a space, without
comment marks; overlapping windows of ``WINDOW`` words of them are scored, and so is every
single line. A sparse logistic regression over the distinct word 1-, 2-
and 3-grams that occur in the licence templates gives each paragraph a
probability per licence family and for "unknown". It is trained on the
templates (whole, and with single words left out). Unknown are sentences that speak of
licences without granting one, the templates denied ("not licensed under ...") or with
another licence's name (``denied_or_foreign``), and, of a bounded sample of the
table (``MAX_PLAIN``), the lines without an anchor and those with one that hold under
``CONTAINED`` of every template. The cut above which a family is believed is
calibrated on a part of the unknown sentences and lines that training does not see. A
prediction counts only if the paragraph also holds at least ``CONTAINED`` of the
word pairs of one of that family's templates.

Every template holds one of the ``ANCHORS``; a line or window without any of them
is unknown by definition, so texts without a word of an anchor are not cut into
paragraphs. A notice is reported at its line where a line alone confirms it, else
once at the first line of its paragraph. All scoring is joins with the bounded weight and template tables
and sums per paragraph, in DataFrame functions only; fitting uses Spark's own
logistic regression.

Cases: null and empty texts have no licence; texts of any length are scanned
whole; repeated rows get equal results; rows that share an identifier, or have
none, keep each their own licences; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitfit.llm.base import bounded_sample, written

UNKNOWN = "unknown"
MAX_PLAIN = 4000       # documents whose paragraphs teach the unknown class
CONTAINED = 0.6
WINDOW, STEP = 64, 16  # words of a window, and from one window to the next; any template fits into one
CUT = 0.5              # least cut of the calibrated probability
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
# Phrases one of which every template holds.
ANCHORS = ("licens", "licenc", "public domain", "redistribution and use", "permission is hereby granted",
           "permission to use", "spdx")
# Comment marks that are words; those of other characters are not read as words anyway.
COMMENT = r"^\s*(?:rem|dnl)(?:\s|$)"
# One word of each anchor, for a cheap look at whole texts, whose lines may part the others.
ANCHOR_WORDS = ("licens", "licenc", "domain", "redistribution", "permission", "spdx")

# Usual notices of licence families.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License."),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1"),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all rights; this work is in the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Sentences that name licences without granting one.
PLAIN = (
    "See the license for details.", "The driver must show a valid license and insurance.",
    "He lost his licence after the second offence.", "A fishing license is required on this lake.",
    "The version of the story is released this week.", "The terms of the license were discussed at the meeting.",
    "This song is in the public domain.", "The general public is invited to the work shop.",
    "You may not use this entrance.", "The software licensing market grew by ten percent.",
    "Under the terms of the agreement the work is finished.", "The city may license street vendors under the new law.",
)
# Names in the templates, and names of other licences that take their place in unknown sentences.
NAMES = ("GNU Lesser General Public", "GNU General Public", "Apache", "MIT", "BSD 3-Clause", "Mozilla Public",
         "Creative Commons Attribution-ShareAlike", "Creative Commons Attribution-NonCommercial",
         "Creative Commons Attribution", "CC BY-SA", "CC BY-NC", "CC BY")
FOREIGN = ("Artistic", "Eclipse Public", "Boost Software", "Microsoft Public", "Academic Free", "Open Software", "PostgreSQL",
           "SIL Open Font", "European Union Public", "Common Development", "zlib", "Example Corporation Commercial")
DENIALS = ("not", "never", "no longer")


def denied_or_foreign() -> list[str]:
    """Templates that are denied, or speak of another licence: sentences of the unknown class."""
    out = []
    for _, text in TEMPLATES:
        low = text.lower()
        for verb in ("licensed under", "released under", "subject to"):
            if verb in low:
                out += [low.replace(verb, f"{d} {verb}", 1) for d in DENIALS]
                rest = low.split(verb, 1)[1]
                out += [f"we {d} {verb.replace('d ', ' ', 1)} it{rest}" for d in ("did not", "never", "will not")]
                out += [f"we {d} {act} it under{rest}" for d in ("did not", "do not") for act in ("release", "license", "publish")]
                out += [f"it is {d} {act} under{rest}" for d in DENIALS for act in ("released", "licensed", "available")]
        name = next((n.lower() for n in NAMES if n.lower() in low), None)
        if name and "spdx" not in low:
            out += [low.replace(name, f.lower(), 1) for f in FOREIGN]
    return sorted(set(out))


def lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def anchored(low: Column, anchors: tuple[str, ...] = ANCHORS) -> Column:
    found = F.lit(False)
    for a in anchors:
        found = found | low.contains(a)
    return found


def words(low: Column) -> Column:
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def grams(w: Column, n: int) -> Column:
    """Word n-grams of an array of words."""
    index = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>"))
    # Element by element: a slice would copy the whole array for every gram.
    return F.transform(index, lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]))


def features(w: Column) -> Column:
    return F.array_distinct(F.concat(w, grams(w, 2), grams(w, 3)))


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, low, row) of the texts with a word of an anchor, written, so that row numbers are the same at every read."""
    return written(docs.select(F.col(id_col).alias("id"), lowered(F.col(text_col)).alias("low"))
                   .filter(anchored(F.col("low"), ANCHOR_WORDS)).withColumn("row", F.monotonically_increasing_id()), "anchored")


def paragraphs(rows: DataFrame) -> DataFrame:
    """(row, id, part, place, alone, w): words of single lines and of windows of paragraphs that hold an anchor.

    ``rows`` are those of ``numbered``. ``place`` is the line, or the first line of the paragraph; ``part`` is
    the paragraph's number in the row.
    """
    # Each line ends with a mark that holds its number; a line without a word ends a paragraph.
    lines = F.split(F.replace(F.col("low"), F.lit("\x01"), F.lit(" ")), "\n")
    marked = F.transform(lines, lambda t, i: F.when(F.regexp_replace(t, COMMENT, "").rlike("[a-z0-9]"), F.concat(t, F.lit("\x01"), i.cast("string"))).otherwise(""))
    runs = rows.select("row", "id", F.posexplode(F.split(F.array_join(marked, "\n"), "\n{2,}")).alias("part", "run"))
    pieces = F.filter(F.split("run", "\n"), lambda t: t != "")
    runs = runs.filter(anchored(F.col("run"), ANCHOR_WORDS)).select("row", "id", "part", F.transform(pieces, lambda t: F.struct(
        F.substring_index(t, "\x01", -1).cast("int").alias("place"), F.substring_index(t, "\x01", 1).alias("low"))).alias("lines"))
    single = (runs.select("row", "id", "part", F.explode("lines").alias("line")).filter(anchored(F.col("line.low")))
              .select("row", "id", "part", "line.place", F.lit(True).alias("alone"), words(F.col("line.low")).alias("w")))
    plain = F.transform("lines", lambda t: words(F.regexp_replace(t["low"], COMMENT, "")))
    whole = runs.select("row", "id", "part", F.get("lines", F.lit(0))["place"].alias("place"),
                        F.size("lines").alias("many"), F.flatten(plain).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("all") - WINDOW + STEP - 1), F.lit(STEP))
    window = (whole.filter((F.col("many") > 1) | (F.size("all") > WINDOW))
              .select("row", "id", "part", "place", F.explode(F.transform(starts, lambda k: F.slice("all", k + 1, WINDOW))).alias("w"))
              .filter(anchored(F.array_join("w", " "))))
    return single.unionByName(window.select("row", "id", "part", "place", F.lit(False).alias("alone"), "w"))


class Model:
    """Weight table (gram, one column per class), intercepts, cut."""

    def __init__(self, classes: list[str], grams: list[str], weights: list[list[float]], bias: list[float], cut: float):
        self.classes, self.grams, self.weights, self.bias, self.cut = classes, grams, weights, bias, cut

    def table(self, spark: SparkSession) -> DataFrame:
        names = [f"w{k}" for k in range(len(self.classes))]
        rows = [(g, *w) for g, w in zip(self.grams, self.weights)]
        return spark.createDataFrame(rows, ", ".join(["gram string", *(f"{n} double" for n in names)]))


def scored(found: DataFrame, model: Model) -> DataFrame:
    """(key, family, probability) of the most likely class of each row (key, x); rows without a known gram drop out."""
    spark, names = found.sparkSession, [f"w{k}" for k in range(len(model.classes))]
    exploded = found.select("key", F.explode("x").alias("gram"))
    # The weight table is bounded by the templates.
    sums = (exploded.join(F.broadcast(model.table(spark)), "gram").groupBy("key")
            .agg(*[F.sum(n).alias(n) for n in names]))
    logits = [F.col(n) + F.lit(b) for n, b in zip(names, model.bias)]
    top = F.greatest(*logits)
    total = sum((F.exp(z - top) for z in logits), F.lit(0.0))
    best = F.array_max(F.array(*[F.struct(z.alias("z"), F.lit(c).alias("family")) for z, c in zip(logits, model.classes)]))
    return sums.select("key", best["family"].alias("family"), (1 / total).alias("probability"))


def containment(lines: DataFrame) -> DataFrame:
    """(key, family, contained): the largest share of the word pairs of a template of the family that a row (key, w) holds."""
    pairs = F.array_distinct(grams(words(F.col("low")), 2))
    templates = (lines.sparkSession.createDataFrame([(k, f, t.lower()) for k, (f, t) in enumerate(TEMPLATES)],
                                                    "template int, family string, low string")
                 .select("template", "family", pairs.alias("pairs")).select(
                     "template", "family", F.size("pairs").alias("of"), F.explode("pairs").alias("pair")))
    # Distinct pairs of a row against the bounded template table.
    return (lines.select("key", F.explode(F.array_distinct(grams(F.col("w"), 2))).alias("pair"))
            .join(F.broadcast(templates), "pair").groupBy("key", "family", "template", "of").count()
            .groupBy("key", "family").agg(F.max(F.col("count") / F.col("of")).alias("contained")))


def fit(docs: DataFrame, id_col: str, text_col: str) -> Model:
    spark = docs.sparkSession
    part = F.pmod(F.xxhash64("low", F.lit("part")), F.lit(4)).cast("int")
    templates = spark.createDataFrame([(f, t.lower(), 0) for f, t in TEMPLATES] + [(UNKNOWN, t.lower(), 0) for t in PLAIN]
                                      + [(UNKNOWN, t, 1) for t in denied_or_foreign()], "family string, low string, made int")
    w = words(F.col("low"))
    shaped = written(templates.select("family", "made", F.when(F.col("made") == 1, part).otherwise(0).alias("part"), w.alias("w")), "shaped")
    made, shaped = shaped.filter("made = 1").drop("made"), shaped.filter("made = 0").drop("made")
    # Each template also with one word left out, in turn.
    left_out = shaped.filter(F.size("w") > 3).select("family", "part", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("w") - 1),
        lambda k: F.filter(F.col("w"), lambda _, i: i != k))).alias("w"))
    sample = bounded_sample(docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("text")).filter("text is not null"),
                            F.col("k"), MAX_PLAIN)
    # Written, so that no later filter repeats the cutting into words per gram.
    lines = written(sample.select(F.explode(F.split(lowered(F.col("text")), "\n")).alias("low")).distinct().select(
        F.lit(UNKNOWN).alias("family"), part.alias("part"), words(F.col("low")).alias("w"), anchored(F.col("low")).alias("named"),
        F.xxhash64("low").alias("key")), "plain")
    granting = containment(lines.filter("named")).filter(F.col("contained") >= CONTAINED).select("key").distinct()
    plain = lines.filter("not named").drop("key", "named").unionByName(
        lines.filter("named").join(granting, "key", "left_anti").drop("key", "named"))
    # Grams of the templates, and those that tell denied and foreign sentences from them.
    known = {r[0] for r in shaped.filter(F.col("family") != UNKNOWN).select(F.explode(features(F.col("w")))).distinct().collect()}
    known |= {r[0] for r in made.filter("part <> 3").select(F.explode(features(F.col("w")))).distinct().collect()}
    known -= {"not", "no", "did", "it"}   # only together with a neighbour: long notices hold them as well
    vocabulary = F.array(*[F.lit(g) for g in sorted(known)])
    # Of the table's paragraphs only their grams that templates have matter; equal sets are one row.
    plain = (plain.select("family", "part", F.array_sort(F.array_intersect(features(F.col("w")), vocabulary)).alias("x"))
             .distinct())
    rows = written(shaped.unionByName(left_out).unionByName(made)
                   .select("family", "part", F.array_intersect(features(F.col("w")), vocabulary).alias("x"))
                   .unionByName(plain), "training")
    vectors = CountVectorizer(inputCol="x", outputCol="v", binary=True, vocabSize=1 << 16)
    vectors = vectors.fit(rows.filter("part <> 3"))
    order = sorted({f for f, _ in TEMPLATES}) + [UNKNOWN]
    label = F.create_map(*[x for k, f in enumerate(order) for x in (F.lit(f), F.lit(float(k)))])
    weight = F.when(F.col("family") == UNKNOWN, 0.25).otherwise(1.0)
    data = vectors.transform(rows).select("part", "family", "x", "v", label[F.col("family")].alias("y"), weight.alias("weight"))
    lr = LogisticRegression(featuresCol="v", labelCol="y", weightCol="weight", family="multinomial", regParam=2e-4,
                            maxIter=40, standardization=False)
    fitted = lr.fit(data.filter("part <> 3").repartition(2))
    matrix = fitted.coefficientMatrix.toArray()
    model = Model(order, vectors.vocabulary, matrix.T.tolist(), fitted.interceptVector.toArray().tolist(), CUT)
    # Unknown paragraphs that training did not see: the cut lies halfway between the surest of them and 1.
    held = scored(data.filter("part = 3").select(F.xxhash64("x").alias("key"), "x"), model)
    worst = held.filter(F.col("family") != UNKNOWN).agg(F.max("probability")).first()[0] or 0.0
    model.cut = max(CUT, (worst + 1) / 2) if worst >= CUT else CUT
    return model


def notices(rows: DataFrame, model: Model) -> DataFrame:
    """(row, id, place, family, probability, contained) of the confirmed notices of ``numbered`` rows."""
    lines = written(paragraphs(rows).withColumn("key", F.monotonically_increasing_id()), "paragraphs")
    best = scored(lines.select("key", features(F.col("w")).alias("x")), model).filter((F.col("family") != UNKNOWN) & (F.col("probability") >= model.cut))
    confirmed = best.join(containment(lines), ["key", "family"]).filter(F.col("contained") >= CONTAINED)
    confirmed = written(confirmed.join(lines.select("key", "row", "id", "part", "place", "alone"), "key"), "confirmed")
    alone = confirmed.filter("alone")
    # The windows of a paragraph overlap: one row for those of a family that no line alone confirms.
    wrapped = (confirmed.filter("not alone").join(alone.select("row", "part", "family"), ["row", "part", "family"], "left_anti")
               .groupBy("row", "part", "family", "id", "place")
               .agg(F.max("probability").alias("probability"), F.max("contained").alias("contained")))
    columns = ["row", "id", "place", "family", "probability", "contained"]
    return alone.select(*columns).unionByName(wrapped.select(*columns))


def scan_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    model: Model | None = None) -> DataFrame:
    """(id, place, family, probability, contained) of the notices with a confirmed licence; place counts lines from 0."""
    found = notices(numbered(docs, id_col, text_col), model or fit(docs, id_col, text_col))
    return found.select(F.col("id").alias(id_col), "place", "family", "probability", "contained")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """Per row: id, families (distinct, sorted, comma-joined; empty if none), n_lines, probability (largest)."""
    rows = numbered(docs, id_col, text_col)
    found = notices(rows, model or fit(docs, id_col, text_col)).groupBy("row").agg(
        F.concat_ws(",", F.array_sort(F.collect_set("family"))).alias("families"),   # at most one per family
        F.count("*").alias("n_lines"), F.max("probability").alias("probability"))
    named = rows.select("row", F.col("id").alias(id_col)).join(found, "row", "left").select(
        id_col, F.coalesce("families", F.lit("")).alias("families"),
        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), "probability")
    # The other texts hold no anchor: no row of theirs is joined.
    other = docs.filter(~anchored(lowered(F.col(text_col)), ANCHOR_WORDS)).select(
        id_col, F.lit("").alias("families"), F.lit(0).cast("long").alias("n_lines"), F.lit(None).cast("double").alias("probability"))
    return named.unionByName(other)
