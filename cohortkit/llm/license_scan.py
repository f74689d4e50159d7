"""License scans: a trained paragraph classifier over sparse word n-grams, confirmed by templates, in DataFrame functions only.

Paragraphs are the lines of a text that hold a word. Their grams (two and three words, A-Z lower-cased, punctuation
blanked) are looked up in the vocabulary of the licence templates, so features are sparse and most paragraphs have none.
A multinomial logistic regression over gram presence names a family or ``unknown``. It is fitted on template variants
with words left out, on fragments of templates and on paragraphs of the corpus that share grams with a template but
hold little of any (both ``unknown``); at most ``BACKGROUND`` of the latter, first by hash, a documented bound. The
probability that a prediction must reach is calibrated on held-out variants and paragraphs: it is the midpoint of the
unknown ones' ``QUANTILE`` and the known ones' lowest hundredth, within ``FLOOR`` and ``CEILING``; all known families together
must reach it. Then each family counts of which one template is contained to ``CONTAINED`` in the paragraph's grams, the best
contained first; a later one must be contained to that share also without the grams that it has in common with the families
before it (CC BY-NC holds most of CC BY). All paragraphs of all documents are scanned.

A notice that is wrapped over lines is found in windows: a line and the words after it, up to the next line without a
word and as many as a template may take (``Vocabulary.reach``). A window counts for the line in which the notice begins: the line adds to the
best template of the family and the words before it do not. A family that a single line of the window holds is left to that line, and
notices of one family that follow each other within a window, without an empty line, give one row. Only documents that
hold a template to ``CONTAINED`` as a whole, which no window can exceed, are cut in windows.

Defined results: null or empty texts have no paragraphs; repeated rows give a row each; null doc_ids stay null; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import common

BACKGROUND, VARIANTS, FRAGMENTS = 4000, 60, 30
QUANTILE, FLOOR, CEILING, CONTAINED, BACKGROUND_SHARE = 0.999, 0.5, 0.95, 0.6, 0.3
UNKNOWN = "unknown"
# Notices by which works name their licence, by family.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
            "to deal in the Software without restriction"),
    ("Apache", "Licensed under the Apache License, Version 2.0."),
    ("Apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
            "by the Free Software Foundation"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License."),
    ("AGPL", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Use of this source code is governed by a BSD-style license."),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0"),
    ("Proprietary", "Copyright. All rights reserved. No part of this work may be reproduced without permission."),
]
FAMILIES = [*dict.fromkeys(f for f, _ in TEMPLATES), UNKNOWN]
# Function words; a gram of these alone says nothing about a licence.
FUNCTION_WORDS = "a an and any are as be by for from in is it may no not of or out part that the this to under use with you".split()
NOT_WORD = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"
FIELDS = "doc_id", "paragraph"
BEHIND = 8  # more words than any run of function words in a template


def words_of(line: Column) -> Column:
    """Lower-cased words between ASCII blanks and punctuation."""
    return F.filter(F.split(F.lower(line), NOT_WORD, -1), lambda w: w != "")


def gram_hashes(w: str | Column, n: int) -> Column:
    """64-bit hashes of the runs of ``n`` words of column ``w``."""
    w = F.col(w) if isinstance(w, str) else w
    starts = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.lit(None))
    return F.coalesce(F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)])), F.array().cast("array<bigint>"))


def once(col: Column) -> Column:
    """``col`` behind a generator of one row: filters stay above it and it is computed once."""
    return F.explode(F.array(col))


class Vocabulary:
    """Grams of the templates (bounded by ``TEMPLATES``): all pairs, all triples, and the grams of each template."""

    def __init__(self, spark: SparkSession):
        t = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(TEMPLATES)], "template int, text string").withColumn("w", words_of(F.col("text")))
        plain = F.array(*[F.lit(x) for x in FUNCTION_WORDS])
        said = lambda n: F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda i: F.size(F.array_except(F.slice("w", i + 1, n), plain)) > 0)
        useful = lambda n: F.transform(F.filter(F.arrays_zip(gram_hashes("w", n).alias("h"), said(n).alias("s")), lambda x: x["s"]), lambda x: x["h"])
        rows = t.select("template", F.size("w").alias("size"), useful(2).alias("g2"), useful(3).alias("g3")).orderBy("template").collect()
        self.reach = math.ceil(max(r["size"] for r in rows) / CONTAINED)  # words after a line that a wrapped template may take
        self.pairs = sorted({g for r in rows for g in r["g2"]})
        self.triples = sorted({g for r in rows for g in r["g3"]})
        self.of = [sorted({*r["g2"], *r["g3"]}) for r in rows]
        self.all = self.pairs + self.triples

    def shared(self, x: DataFrame, keep: list[str]) -> DataFrame:
        """Rows with words ``w`` that share a pair with a template, and their shared grams ``g``.

        ``once`` keeps the filter above the pairs; pushed below, it would compute the words anew for every pair.
        """
        x = x.select(*keep, once(F.col("w")).alias("w"))
        x = x.select(*x.columns, once(F.array_intersect(gram_hashes("w", 2), common.constant(self.pairs, "bigint"))).alias("g2")).filter(F.size("g2") > 0)
        keep = x.columns[:-2]
        return x.select(*keep, F.concat("g2", F.array_intersect(gram_hashes("w", 3), common.constant(self.triples, "bigint"))).alias("g"))

    def contained(self, family: int | None = None) -> Column:
        """The largest share of a template's grams that ``g`` holds; of one family or of all."""
        parts = [F.size(F.array_intersect("g", common.constant(t, "bigint"))) / len(t) for (f, _), t in zip(TEMPLATES, self.of) if t and family in (None, FAMILIES.index(f))]
        return F.greatest(*parts, F.lit(0.0), F.lit(0.0))


    def named(self) -> Column:
        """(family, contained) of the families that ``g`` names, given ``shares`` and ``chances`` of each family."""
        grams = lambda t: common.constant(t, "bigint")
        templates = F.array(*[F.struct(F.lit(FAMILIES.index(f)).alias("f"), grams(t).alias("g")) for (f, _), t in zip(TEMPLATES, self.of) if t])
        whole = F.array(*[grams(sorted({g for (f, _), t in zip(TEMPLATES, self.of) if f == family for g in t})) for family in FAMILIES[:-1]])
        held = F.filter(F.transform("shares", lambda c, i: F.struct(c.alias("contained"), F.get("chances", i).alias("p"), i.alias("f"))), lambda x: x["contained"] >= CONTAINED)

        def after(seen: Column, x: Column) -> Column:
            rest = lambda t: F.array_except(t["g"], F.flatten(F.transform(seen, lambda y: F.get(whole, y["f"]))))
            own = lambda t: (t["f"] == x["f"]) & (F.size(F.array_intersect(t["g"], F.col("g"))) >= CONTAINED * F.size(t["g"])) & (F.size(rest(t)) > 0) \
                & (F.size(F.array_intersect(rest(t), F.col("g"))) >= CONTAINED * F.size(rest(t)))
            return F.when(F.exists(templates, own), F.concat(seen, F.array(x))).otherwise(seen)

        return F.aggregate(F.sort_array(held, False), F.array().cast("array<struct<contained:double,p:double,f:int>>"), after)

    def share(self, words: Column, family: Column) -> Column:
        """The largest share of a template of ``family`` (a number of each row) that ``words`` hold."""
        g = F.concat(gram_hashes(words, 2), gram_hashes(words, 3))
        of = F.array(*[F.struct(F.lit(FAMILIES.index(f)).alias("f"), common.constant(t, "bigint").alias("g")) for (f, _), t in zip(TEMPLATES, self.of) if t])
        return F.array_max(F.transform(F.filter(of, lambda t: t["f"] == family), lambda t: F.size(F.array_intersect(t["g"], g)) / F.size(t["g"])))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph (line number from 0) and line of every line with a word."""
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("paragraph", "line"))
    return x.filter(F.col("line").rlike(common.WORD))


def windows(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, paragraph, words ``before`` (the previous line and ``BEHIND`` words at least), ``w`` (the line and what follows it), ``after`` (what follows it) and the ``lines`` of ``w``."""
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.contains("text", F.lit("\n"))).withColumn("w", words_of(F.col("text")))
    x = vocabulary.shared(x, ["doc_id", "text"]).filter(vocabulary.contained() >= CONTAINED)
    x = x.select("doc_id", once(F.transform(F.split("text", "\n", -1), words_of)).alias("all"))
    near = F.transform("all", lambda w, i: F.struct(F.reverse(F.slice("all", F.greatest(i - BEHIND, F.lit(0)) + 1, F.least(i, F.lit(BEHIND)))).alias("back"), w.alias("w"),
                                                    F.slice("all", i + 2, F.lit(vocabulary.reach)).alias("next")))
    x = x.select("doc_id", F.posexplode(near).alias("paragraph", "x")).select("doc_id", "paragraph", "x.*").filter(F.size("w") > 0)
    for c in ("back", "next"):  # lines up to the next one without a word
        stop = F.array_position(F.transform(c, F.size), F.lit(0)).cast("int")
        x = x.withColumn(c, once(F.when(stop > 0, F.slice(c, F.lit(1), stop - 1)).otherwise(F.col(c))))
    x = x.withColumn("before", once(F.flatten(F.reverse("back"))))
    many = F.greatest(F.coalesce(F.size(F.get("back", F.lit(0))), F.lit(0)), F.lit(BEHIND))
    x = x.withColumn("before", once(F.when(F.size("before") > many, F.slice("before", -many, many)).otherwise(F.col("before"))))
    words = F.flatten(F.transform("next", lambda w, i: F.transform(w, lambda v: F.struct(v.alias("word"), (i + 1).alias("line")))))
    x = x.withColumn("after", once(F.slice(words, 1, vocabulary.reach))).filter(F.size("after") > 0)
    lines = F.concat(F.array("w"), F.slice("next", F.lit(1), F.element_at("after", -1)["line"]))
    return x.select(*FIELDS, "before", F.concat("w", F.col("after.word")).alias("w"), F.col("after.word").alias("after"), lines.alias("lines"))


def training_rows(spark: SparkSession, vocabulary: Vocabulary, found: DataFrame) -> DataFrame:
    """label, g and held (a fifth, for the calibration)."""
    t = spark.createDataFrame([(i, FAMILIES.index(f), t) for i, (f, t) in enumerate(TEMPLATES)], "template int, family int, text string")
    t = t.withColumn("w", words_of(F.col("text"))).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    thinned = F.filter("w", lambda x, i: (F.col("v") == 0) | (F.pmod(F.xxhash64("v", "template", i), F.lit(12)) > 0))
    cut = F.slice("w", (F.pmod(F.xxhash64("v", "template"), F.size("w")) + 1).cast("int"), F.greatest(F.lit(2), F.floor(F.size("w") / 4).cast("int")))
    known = vocabulary.shared(t.withColumn("w", thinned), ["template", "v", F.col("family").alias("label")])
    pieces = vocabulary.shared(t.filter(F.col("v") < FRAGMENTS).withColumn("w", cut), ["template", "v"]).filter(vocabulary.contained() < CONTAINED)
    other = found.filter(vocabulary.contained() < BACKGROUND_SHARE).select("line_hash", "g").distinct().orderBy(F.xxhash64("line_hash"), "line_hash").limit(BACKGROUND)
    unknown = F.lit(len(FAMILIES) - 1).alias("label")
    rows = known.select("label", "g", F.xxhash64("template", "v").alias("k")) \
        .unionByName(pieces.select(unknown, "g", F.xxhash64("v", "template").alias("k"))) \
        .unionByName(other.select(unknown, "g", F.xxhash64("line_hash").alias("k")))
    rows = rows.unionByName(spark.range(50).select(unknown, F.array().cast("array<bigint>").alias("g"), F.col("id").alias("k")))  # no gram: unknown
    return rows.select(F.col("label").cast("double").alias("label"), "g", (F.pmod("k", F.lit(5)) == 0).alias("held"))


def probabilities(x: DataFrame, vocabulary: Vocabulary, weights: list[list[float]], bias: list[float]) -> DataFrame:
    """Adds ``chances`` (the probability of each family) and ``p_unknown``."""
    position = F.transform("g", lambda v: F.array_position(common.constant(vocabulary.all, "bigint"), v).cast("int") - 1)
    x = x.select("*", once(position).alias("at"))

    def total(w: list[float], b: float) -> Column:
        return F.aggregate("at", F.lit(b), lambda acc, i: acc + F.get(common.constant(w, "double"), i))

    z = [total(w, b) for w, b in zip(weights, bias)]
    keep = [c for c in x.columns if c != "at"]
    x = x.select(*keep, once(F.array(*z)).alias("z"))
    x = x.select(*keep, "z", once(F.array_max("z")).alias("m"))
    x = x.select(*keep, once(F.transform("z", lambda v: F.exp(v - F.col("m")))).alias("e"))
    x = x.select(*keep, "e", once(F.aggregate("e", F.lit(0.0), lambda a, b: a + b)).alias("m"))
    x = x.select(*keep, once(F.transform("e", lambda v: v / F.col("m"))).alias("e"))
    return x.select(*keep, F.col("e").alias("chances"), F.get("e", F.lit(len(FAMILIES) - 1)).alias("p_unknown"))


def fit(rows: DataFrame, vocabulary: Vocabulary) -> tuple[list[list[float]], list[float]]:
    """Weights of each family over the vocabulary, and biases."""
    counter = CountVectorizerModel.from_vocabulary([str(g) for g in vocabulary.all], "grams", "features").setBinary(True)
    named = rows.filter("NOT held").select("label", F.transform("g", lambda v: v.cast("string")).alias("grams"))
    model = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60, standardization=False).fit(counter.transform(named).coalesce(2))
    matrix = model.coefficientMatrix.toArray()
    return [[round(float(v), 6) for v in row] for row in matrix], [float(b) for b in model.interceptVector.toArray()]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph, family, probability, contained and threshold of every paragraph with a confirmed licence family."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(spark)
    lines = paragraphs(docs).select(*FIELDS, F.xxhash64("line").alias("line_hash"), words_of(F.col("line")).alias("w"))
    found = common.stored(vocabulary.shared(lines, [*FIELDS, "line_hash"]), "license-candidates")
    rows = common.stored(training_rows(spark, vocabulary, found), "license-training")
    weights, bias = fit(rows, vocabulary)
    held = probabilities(rows.filter("held"), vocabulary, weights, bias)
    last = len(FAMILIES) - 1
    known = 1 - F.col("p_unknown")
    q = held.agg(F.percentile(F.when(F.col("label") == last, known), F.lit(QUANTILE)).alias("hi"), F.percentile(F.when(F.col("label") < last, known), F.lit(0.01)).alias("lo")).first()
    threshold = min(CEILING, max(FLOOR, ((q["hi"] or 0.0) + (1.0 if q["lo"] is None else q["lo"])) / 2))

    def judged(x: DataFrame, keep: list[str]) -> DataFrame:
        x = probabilities(x.filter(vocabulary.contained() >= CONTAINED), vocabulary, weights, bias).filter(known >= threshold)
        shares = F.array(*[vocabulary.contained(i) for i in range(last)])
        x = x.select(*keep, "g", "chances", once(shares).alias("shares"))
        x = x.select(*keep, F.explode(vocabulary.named()).alias("n")).select(*keep, F.col("n.f").alias("f"), F.col("n.p").alias("probability"), F.col("n.contained").alias("contained"))
        return x.withColumn("family", F.get(F.array(*[F.lit(f) for f in FAMILIES]), F.col("f")))

    out = [*FIELDS, "family", "probability", "contained", F.lit(threshold).alias("threshold")]
    near = ["before", "words", "after", "lines"]
    wide = windows(docs, vocabulary).withColumn("words", F.col("w"))
    wide = judged(vocabulary.shared(wide.select(*FIELDS, *near, "w"), [*FIELDS, *near]), [*FIELDS, *near])
    begins = (vocabulary.share(F.concat("before", "words"), F.col("f")) <= F.col("contained")) & (vocabulary.share(F.col("after"), F.col("f")) < F.col("contained"))
    alone = F.exists("lines", lambda w: vocabulary.share(w, F.col("f")) >= CONTAINED)
    return judged(found, list(FIELDS)).select(*out).unionByName(wide.filter(begins).filter(~alone).select(*out))
