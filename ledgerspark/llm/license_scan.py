"""Licence scan by a trained paragraph classifier, in DataFrame functions and Spark ML only.

Paragraphs (lines) are classified by multinomial logistic regression over word
n-grams of one to three words, with an L1 penalty that leaves few weights. The
classes are the licence families, ``unknown`` (licence language of no known
family) and ``none``. It is trained on the notices below, each inside several
phrases and in parts, and on a bounded sample of the corpus's own paragraphs as
``none``, without those that have a licence word or much of a notice. A temperature, chosen by log-loss on the third of the training rows
that the regression doesn't see, calibrates the probabilities. A predicted
family stands only if one of its notices confirms it (share of the notice's
word pairs found in the paragraph); otherwise the paragraph is ``unknown``.

A paragraph is a line, or neighbouring lines (no empty one between them) that
hold a wrapped notice together: these are one row, with the number of the first
line, in place of their own rows of unknown family.

Every paragraph of every document is looked at. An n-gram's anchor is its
rarest word; a paragraph without any anchor has no weighted n-gram, so its
score is the intercepts' (class ``none``) and it is left out early. Different
paragraphs are scored once each and joined back to where they stand, so a
notice that a third of all documents carry is one row of scoring.

Defined results: null text counts as empty, empty paragraphs are ``none``;
null ids are kept; rows that repeat give the same rows again; an empty table
gives an empty table (and the regression is then trained on the notices alone);
further columns are not read. A very long text is split into its lines once, inside its task;
only lines with an anchor in them or in the next one carry their window of following lines.
"""

from __future__ import annotations

import json
import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, hash_sample, table, text_or_empty

#: Documents whose paragraphs are sampled as examples of no licence, and the number of those paragraphs.
SAMPLE_DOCS, SAMPLE_PARAGRAPHS = 400, 4000
MOST_NGRAMS = 6000
NONE, UNKNOWN = "none", "unknown"
NONE_AT_LEAST, FAMILY_AT_LEAST, CONFIRM_AT_LEAST = 0.5, 0.5, 0.6
#: A sampled paragraph with so many of a notice's word pairs, and such a share of them or of its own, is no example of none.
LIKE_PAIRS, LIKE_SHARE, OWN_SHARE = 3, 0.3, 0.5
#: A notice's n-gram in more than this share of the examples of none is left out.
FREQUENT = 0.001
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)

#: Notices by family (public licence texts' usual short notices and opening clauses).
NOTICES: dict[str, list[str]] = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "SPDX-License-Identifier: Apache-2.0"],
    "mit": ["Released under the MIT License", "Licensed under the MIT License", "This software is distributed under the MIT license",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "SPDX-License-Identifier: MIT"],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3",
                "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
                "Licensed under the GPL v3", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "gpl-2.0": ["This program is licensed under the GNU General Public License, version 2",
                "it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
                "Licensed under the GPL v2", "SPDX-License-Identifier: GPL-2.0-only"],
    "lgpl": ["Licensed under the GNU Lesser General Public License",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             "SPDX-License-Identifier: LGPL-3.0-only"],
    "agpl": ["Licensed under the GNU Affero General Public License",
             "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
             "SPDX-License-Identifier: AGPL-3.0-only"],
    "bsd": ["Licensed under the BSD License", "Distributed under the 3-clause BSD license", "Released under the BSD 2-Clause License",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "SPDX-License-Identifier: BSD-3-Clause"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
                "Licensed under the Mozilla Public License 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "isc": ["Released under the ISC License",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
            "SPDX-License-Identifier: ISC"],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
              "https://creativecommons.org/licenses/by/4.0/"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
                 "https://creativecommons.org/licenses/by-sa/4.0/"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
                 "https://creativecommons.org/licenses/by-nc/4.0/"],
    "public-domain": ["Dedicated to the public domain under CC0 1.0", "This work has been released into the public domain",
                      "This is free and unencumbered software released into the public domain",
                      "https://creativecommons.org/publicdomain/zero/1.0/", "SPDX-License-Identifier: CC0-1.0"],
    "proprietary": ["All rights reserved", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited",
                    "No part of this publication may be reproduced without the prior written permission of the publisher"],
    UNKNOWN: ["Licensed under the terms of the licence agreement", "See the license file for details", "Use is subject to license terms",
              "This content is licensed", "Distributed under a custom license", "Please read the licence before use",
              "License: see below", "The license is granted to the licensee", "Subject to the license of the vendor",
              "Usage is governed by the end user license agreement"],
}
#: Sentences with the same words that are no licence language.
OTHER = ["She got her driving license last week", "The licensed driver arrived at the station", "He has a fishing license",
         "The version of the story that the public knows", "Free of charge for all visitors", "The general public was invited",
         "Use the file in the source folder", "A licence plate was found near the road", "The restaurant lost its liquor license",
         "All rights and duties of the members", "It is part of the software for the library", "The doctor's license was revoked"]
#: Phrases that the notices are put into for training.
PHRASES = ["{}", "{}.", "Copyright (c) 2021 The Authors. {}.", "© 2019 Example Ltd. {}.", "This file is part of the project. {}.",
           "# {}", "// {}", "Note: {}. See LICENSE for details.", "{}. Details in the file COPYING.", "License: {}"]
FAMILIES = [f for f in NOTICES if f != UNKNOWN]
CLASSES = [*FAMILIES, UNKNOWN, NONE]
#: A notice has no more words (addresses are several words).
MOST_WORDS = max(sum(1 + x.count("/") + x.count(":") for x in n.split()) for f in FAMILIES for n in NOTICES[f])


def words_of(text: Column) -> Column:
    """Lower-case words: letters, digits, and points or dashes between them."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.\-]+|[.\-]+(?![\p{L}\p{N}])|(?<![\p{L}\p{N}])[.\-]+", -1), lambda w: w != "")


def ngrams(words: str, most: int = 3, least: int = 1) -> Column:
    """Different word n-grams of a column of words (a column, so that the words are not split anew for each n-gram)."""
    words = F.col(words)

    def of(n: int) -> Column:
        if n == 1:
            return words
        some = F.sequence(F.lit(0), F.size(words) - n)
        runs = F.transform(some, lambda i: F.array_join(F.slice(words, i + 1, n), " "))
        return F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*(of(n) for n in range(least, most + 1))))


def json_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small table from the driver, as a JSON literal (no RDD)."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def notice_pairs(spark: SparkSession) -> DataFrame:
    """(guess, notice, pairs): the word pairs of each family's notices."""
    notices = json_rows(spark, [{"guess": f, "notice": n} for f in FAMILIES for n in NOTICES[f]], "guess string, notice string")
    notices = notices.withColumn("words", words_of(F.col("notice"))).select("guess", "notice", ngrams("words", 2, 2).alias("pairs"))
    return notices.where(F.size("pairs") > 0)


def without_notices(paragraphs: DataFrame) -> DataFrame:
    """The different paragraphs that hold no notice and no larger part of one, also where no licence word is in them."""
    own = paragraphs.withColumn("words", words_of(F.col("paragraph"))).select("paragraph", ngrams("words", 2, 2).alias("have"))
    theirs = notice_pairs(paragraphs.sparkSession).select("notice", F.size("pairs").alias("of"), F.explode("pairs").alias("pair"))
    shared = own.select("paragraph", F.size("have").alias("n"), F.explode("have").alias("pair")).join(F.broadcast(theirs), "pair")
    shared = shared.groupBy("paragraph", "notice", "n", "of").agg(F.count(F.lit(1)).alias("both"))
    part = (F.col("both") >= LIKE_PAIRS) & ((F.col("both") >= LIKE_SHARE * F.col("of")) | (F.col("both") >= OWN_SHARE * F.col("n")))
    like = shared.where(part | (F.col("both") >= CONFIRM_AT_LEAST * F.col("of")))
    return paragraphs.join(like.select("paragraph").distinct(), "paragraph", "left_anti")


def training_rows(spark: SparkSession, docs: DataFrame, text_col: str) -> DataFrame:
    """(class, paragraph, fold): notices in phrases and in halves, and sampled corpus paragraphs."""
    rows = []
    for family, notices in NOTICES.items():
        for notice in notices:
            parts = notice.split()
            halves = [" ".join(parts[:len(parts) // 2]), " ".join(parts[len(parts) // 2:])] if len(parts) >= 14 else []
            rows += [{"family": family, "paragraph": p.format(n), "fold": i % 3}
                     for n in (notice, *halves) for i, p in enumerate(PHRASES)]
    rows += [{"family": NONE, "paragraph": p.format(n), "fold": i % 3} for n in OTHER for i, p in enumerate(PHRASES[:2] + ["Note: {}."])]
    known = json_rows(spark, rows, "family string, paragraph string, fold int")
    text = text_or_empty(F.col(text_col))
    some = hash_sample(docs.select(text.alias("text")), F.col("text"), SAMPLE_DOCS, docs.count())
    lines = some.select(F.explode(F.split("text", "\n", -1)).alias("paragraph")).distinct()
    lines = lines.where(~F.col("paragraph").rlike(r"(?i)licen[cs]|copyright|rights reserved|public domain|SPDX|©"))
    lines = without_notices(lines)
    lines = lines.orderBy(F.xxhash64("paragraph"), "paragraph").limit(SAMPLE_PARAGRAPHS)
    other = lines.select(F.lit(NONE).alias("family"), "paragraph", F.pmod(F.xxhash64("paragraph"), F.lit(3)).cast("int").alias("fold"))
    return known.unionByName(other)


class LicenceModel:
    """Weights by n-gram, intercepts, temperature and anchors."""

    def __init__(self, weights: dict[str, list[float]], intercepts: list[float], anchors: list[str]):
        self.weights, self.intercepts, self.anchors, self.temperature = weights, intercepts, anchors, 1.0

    def scores(self, paragraphs: DataFrame, scratch: Scratch) -> DataFrame:
        """(paragraph, z, top): class scores, and the highest, of different paragraphs that have an anchor."""
        spark = paragraphs.sparkSession
        table_ = json_rows(spark, [{"gram": g, "w": w} for g, w in self.weights.items()], "gram string, w array<double>")
        words = paragraphs.select("paragraph", words_of(F.col("paragraph")).alias("words"))
        grams = words.select("paragraph", F.explode(ngrams("words")).alias("gram"))
        found = grams.join(F.broadcast(table_), "gram")     # at most MOST_NGRAMS rows
        z = found.groupBy("paragraph").agg(F.array(*(F.sum(F.col("w")[k]) + F.lit(b) for k, b in enumerate(self.intercepts))).alias("z"))
        return scratch.keep(z.withColumn("top", F.array_max("z")), "scores")

    def total(self, temperature: float | None = None) -> Column:
        """Sum over the classes of exp((z - top) / temperature)."""
        t = F.lit(temperature or self.temperature)
        return F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp((x - F.col("top")) / t))


def fit(docs: DataFrame, text_col: str = "text") -> LicenceModel:
    spark = docs.sparkSession
    scratch = Scratch(spark, "licence")
    rows = scratch.keep(training_rows(spark, docs, text_col).withColumn("words", words_of(F.col("paragraph")))
                        .withColumn("grams", ngrams("words")).drop("words"), "training")
    # Only n-grams that are rare in the corpus sample can speak for a licence.
    exploded = rows.select("family", "paragraph", F.explode("grams").alias("gram"))
    counts = exploded.groupBy("gram").agg(F.sum((F.col("family") != NONE).cast("int")).alias("known"),
                                          F.sum((F.col("family") == NONE).cast("int")).alias("other"))
    written = {w for n in OTHER for w in n.lower().split()}
    seen = {r.gram: (r.known, r.other) for r in counts.where("known > 0").collect()}
    frequent = FREQUENT * rows.where(F.col("family") == NONE).count()
    vocabulary = sorted((g for g, (_, other) in seen.items() if other <= frequent or g in written and other < 20), key=lambda g: (-seen[g][0], g))[:MOST_NGRAMS]
    usual = F.array_intersect("grams", F.from_json(F.lit(json.dumps(vocabulary)), "array<string>"))
    label = F.array_position(F.array(*(F.lit(c) for c in CLASSES)), F.col("family")) - 1
    ready = rows.select("paragraph", "fold", "family", label.cast("double").alias("label"), usual.alias("grams"))
    vectors = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=MOST_NGRAMS, minDF=1.0, binary=True)
    train = scratch.keep(ready.where("fold < 2").coalesce(2), "train")     # a bounded sample, read in every iteration
    vector_model = vectors.fit(train)
    # Each class counts alike, whatever its number of rows.
    sizes = {r.family: r["count"] for r in train.groupBy("family").count().collect()}
    weight = F.lit(1.0)
    for c, n in sizes.items():
        weight = F.when(F.col("family") == c, len(train.columns) * 100.0 / n).otherwise(weight)
    regression = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=2e-3, maxIter=40, weightCol="weight",
                                    standardization=False)
    # A row of each class keeps the classes' number, with or without a corpus sample.
    base = json_rows(spark, [{"family": c, "grams": [], "label": float(i)} for i, c in enumerate(CLASSES)],
                     "family string, grams array<string>, label double").select("family", "label", "grams", F.lit(1e-3).alias("weight"))
    fitted = regression.fit(vector_model.transform(train.select("family", "label", "grams", weight.alias("weight")).unionByName(base)))
    matrix = fitted.coefficientMatrix.toArray()
    weights = {g: [round(float(x), 6) for x in matrix[:, j]] for j, g in enumerate(vector_model.vocabulary)
               if abs(matrix[:, j]).max() > 1e-6}
    intercepts = [float(x) for x in fitted.interceptVector.toArray()]
    # Without any n-gram a paragraph is none.
    intercepts[-1] = max(intercepts[-1], max(intercepts[:-1]) + 1.0)
    single = {g: n for g, (_, n) in seen.items() if " " not in g}
    anchors = sorted({min(g.split(" "), key=lambda w: (single.get(w, 0), -len(w), w)) for g in weights})
    model = LicenceModel(weights, intercepts, anchors)
    held = rows.where("fold = 2").select("paragraph", "family").distinct()
    z = model.scores(held.select("paragraph").distinct(), scratch).join(held, "paragraph")
    own = F.element_at("z", F.array_position(F.array(*(F.lit(c) for c in CLASSES)), F.col("family")).cast("int"))
    losses = z.agg(*(F.avg(F.log(model.total(t)) - (own - F.col("top")) / t).alias(f"t{i}")
                     for i, t in enumerate(TEMPERATURES))).first()
    loss = [x if x is not None and not math.isnan(x) else math.inf for x in losses]
    model.temperature = TEMPERATURES[loss.index(min(loss))] if min(loss) < math.inf else 1.0
    for df in (rows, train):
        scratch.drop(df)
    return model


def confirmed(guesses: DataFrame) -> DataFrame:
    """Per (paragraph, guess, ...) the largest share of a notice's word pairs that the paragraph has, over the guessed
    family's notices."""
    notices = notice_pairs(guesses.sparkSession).drop("notice")
    both = guesses.withColumn("words", words_of(F.col("paragraph"))).withColumn("have", ngrams("words", 2, 2))
    both = both.join(F.broadcast(notices), "guess", "left")
    share = F.size(F.array_intersect("pairs", "have")) / F.size("pairs")
    return both.groupBy("paragraph", "guess", "probability").agg(F.coalesce(F.max(share), F.lit(0.0)).alias("confirmation"))


def judged(paragraphs: DataFrame, model: LicenceModel, scratch: Scratch) -> DataFrame:
    """(paragraph, probability, guess) of different paragraphs that aren't ``none``."""
    families = F.slice("z", 1, len(FAMILIES))
    share = lambda z: F.exp((z - F.col("top")) / F.lit(model.temperature)) / F.col("total")
    scored = model.scores(paragraphs, scratch).withColumn("total", model.total())
    return scored.where(share(F.col("z")[len(CLASSES) - 1]) < NONE_AT_LEAST).select(
        "paragraph", share(F.array_max(families)).alias("probability"),
        F.element_at(F.array(*(F.lit(f) for f in FAMILIES)), F.array_position(families, F.array_max(families)).cast("int")).alias("guess"))


def wrapped(near: DataFrame, model: LicenceModel, scratch: Scratch) -> DataFrame:
    """(near, family, lines, probability, confirmation, paragraph): notices that begin in the first of a window's lines and go on
    in the next, with the fewest lines that hold as much of the notice. ``near``: different windows (line, near)."""
    # Of the first line only the end, of the others only the beginning can belong to a notice that begins in the first.
    first, rest = words_of(F.col("line")), words_of(F.expr("substring(near, length(line) + 1)"))
    words = near.select("near", first.alias("first"), rest.alias("rest")).select("near", F.concat(
        F.slice("first", F.greatest(F.size("first") - MOST_WORDS + 1, F.lit(1)), MOST_WORDS), F.slice("rest", 1, MOST_WORDS)).alias("words"))
    theirs = notice_pairs(near.sparkSession).select("guess", "notice", F.size("pairs").alias("of"), F.explode("pairs").alias("pair"))
    shared = words.select("near", F.explode(ngrams("words", 2, 2)).alias("pair")).join(F.broadcast(theirs), "pair")
    likely = shared.groupBy("near", "guess", "notice", "of").agg(F.count(F.lit(1)).alias("both")).where(
        F.col("both") >= CONFIRM_AT_LEAST * F.col("of")).select("near", "guess").distinct()
    parts = F.split("near", "\n", -1)
    heads = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "\n"))
    heads = scratch.keep(likely.select("near", "guess", F.posexplode(heads).alias("lines", "paragraph")), "heads")
    shares = confirmed(heads.select("paragraph", "guess", F.lit(0.0).alias("probability")).distinct()).drop("probability")
    best = heads.join(shares, ["paragraph", "guess"]).groupBy("near", "guess").agg(
        F.max(F.struct("confirmation", (-F.col("lines")).alias("lines"), "paragraph")).alias("best"))
    best = scratch.keep(best.select("near", "guess", (1 - F.col("best.lines")).alias("lines"), "best.confirmation", "best.paragraph").where(
        (F.col("lines") > 1) & (F.col("confirmation") >= CONFIRM_AT_LEAST)), "wrapped")
    found = judged(best.select("paragraph").distinct(), model, scratch).where(F.col("probability") >= FAMILY_AT_LEAST)
    return best.join(found, ["paragraph", "guess"]).select("near", F.col("guess").alias("family"), "lines", "probability", "confirmation", "paragraph")


def scan(docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph with licence language: id, paragraph number, family (or unknown), probability of the
    best family, confirmation, paragraph."""
    scratch = Scratch(docs.sparkSession, "licence")
    anchored = lambda text: F.exists(words_of(text), lambda w: w.isin(*model.anchors))
    # The row's number first: beside the explode it would be a line's. Lines and anchors are columns of their own, so
    # that a text is split once, not once for each of its lines.
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                       F.split(text_or_empty(F.col(text_col)), "\n", -1).alias("lines"))
    rows = rows.select("*", F.transform("lines", anchored).alias("anchors"))
    # Only lines with an anchor in them or in the next one begin a window; a notice has a word at least in each line that
    # it is wrapped into.
    begins = F.filter(F.sequence(F.lit(1), F.size("lines")), lambda i: F.element_at("anchors", i) | F.coalesce(F.get("anchors", i), F.lit(False)))
    rows = rows.select("id", "row", "lines", "anchors", begins.alias("begins"))
    window = F.transform("begins", lambda i: F.struct(
        (i - 1).alias("pos"), F.element_at("lines", i).alias("line"), F.element_at("anchors", i).alias("own"),
        F.array_join(F.slice("lines", i, MOST_WORDS), "\n").alias("near")))
    rows = rows.select("id", "row", F.explode(window).alias("at")).select("id", "row", "at.*")
    # A window ends before a line without words, or where a notice's words must have ended.
    block = F.split("near", r"\n[^\p{L}\p{N}\n]*(?=\n|\z)", 2)[0]
    rest = F.regexp_extract(F.expr("substring(block, length(line) + 1)"), rf"\A\s*+(?:\S++\s++){{0,{2 * MOST_WORDS}}}+[^\n]*+", 0)
    kept = scratch.keep(rows.withColumn("block", block).select("id", "row", "pos", "line", "own", F.concat("line", rest).alias("near")), "anchored")
    some = kept.where("own").select("id", "row", "pos", F.col("line").alias("paragraph"))
    scored = confirmed(judged(some.select("paragraph").distinct(), model, scratch))
    sure = (F.col("probability") >= FAMILY_AT_LEAST) & (F.col("confirmation") >= CONFIRM_AT_LEAST)
    scored = scratch.keep(scored.select("paragraph", F.when(sure, F.col("guess")).otherwise(UNKNOWN).alias("family"),
                                        "probability", "confirmation"), "scored")
    single = scratch.keep(some.join(scored.hint("merge"), "paragraph"), "single")
    long = wrapped(kept.where(F.length("near") > F.length("line")).select("line", "near").distinct(), model, scratch)
    long = scratch.keep(kept.select("id", "row", "pos", "near").join(long.hint("merge"), "near").drop("near"), "long")
    # A line that holds its family's notice alone stands by itself.
    in_lines = long.select("row", F.col("pos").alias("start"), "family", F.explode(F.expr("sequence(pos, pos + lines - 1)")).alias("pos"))
    alone = in_lines.join(single.select("row", "pos", "family"), ["row", "pos", "family"]).select("row", F.col("start").alias("pos"), "family")
    long = long.join(alone.distinct(), ["row", "pos", "family"], "left_anti")
    # Of overlapping windows of a family the one with the most of the notice stays, of equal ones the last.
    order = Window.partitionBy("row", "family").orderBy("pos")
    after = (F.lead("pos").over(order) < F.col("pos") + F.col("lines")) & (F.lead("confirmation").over(order) >= F.col("confirmation"))
    before = (F.lag(F.col("pos") + F.col("lines")).over(order) > F.col("pos")) & (F.lag("confirmation").over(order) > F.col("confirmation"))
    long = long.withColumn("less", F.coalesce(after, F.lit(False)) | F.coalesce(before, F.lit(False))).where(~F.col("less")).drop("less")
    long = scratch.keep(long, "windows")
    parts = long.select("row", F.explode(F.expr("sequence(pos, pos + lines - 1)")).alias("pos"), F.lit(UNKNOWN).alias("family")).distinct()
    single = single.join(parts, ["row", "pos", "family"], "left_anti")
    columns = [F.col("id").alias(id_col), F.col("pos").alias("paragraph_no"), "family", "probability", "confirmation", "paragraph"]
    return single.select(*columns).unionByName(long.select(*columns))


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    """Every paragraph with licence language, in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, fit(docs))


QUERIES = {"op5_license_scan": op5_license_scan}
ORACLE: dict[str, str] = {}
