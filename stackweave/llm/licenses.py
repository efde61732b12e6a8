"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line of a text. Its words and word pairs, hashed to sparse vectors, go through a
multinomial logistic regression that knows the licence families and ordinary text. It is trained
by Spark on the template sentences below and on paragraphs of the corpus. A paragraph that is less
likely to be ordinary text than all but a few held-out ordinary paragraphs is reported. Its family
counts only if its probability reaches a cutoff, calibrated on held-out variants of the templates,
and if the paragraph shares enough five-word shingles with a template of that family; else the
family is ``unknown``.

All work on the corpus is DataFrame and SQL functions and the JVM's own ML stages, in one pass
without a shuffle of texts. Training uses at most ``ORDINARY`` corpus paragraphs.

Defined cases: null and empty texts have no paragraphs. Lines without a word are skipped. Rows
that repeat a document are reported again. An empty corpus gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackweave.llm import common

# Sentences of public licence notices, by family.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation.",
        "Released under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Copyright 2024. All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
}
ORDINARY_TEXT, UNKNOWN = "none", "unknown"
FEATURES = 1 << 12
ORDINARY = 4000  # corpus paragraphs in training
FALSE_ALARMS = 0.001  # share of held-out ordinary paragraphs that may be reported
MISSED = 0.02  # share of held-out licence variants that may fall below the family cutoff
SHINGLE, SIMILARITY = 5, 0.8


def words(paragraph: Column) -> Column:
    """Lower-case runs of letters; numbers, dates and versions vary within a family."""
    return F.filter(F.split(F.lower(paragraph), r"[^\p{L}]+"), lambda word: word != "")


def shingles(tokens: Column) -> Column:
    """Hashes of five-word shingles; the whole of a shorter paragraph."""
    last = F.size(tokens) - SHINGLE
    several = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(F.slice(tokens, i + 1, SHINGLE)))
    return F.array_distinct(several)


def _running(tokens: str) -> Column:
    """Words with a blank around each, so that a text inside another is found at whole words."""
    return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, body, words) of every line with a word."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "body"))
    return lines.withColumn("words", words(F.col("body"))).where(F.size("words") > 0)


def template_table(spark: SparkSession) -> DataFrame:
    rows = ",".join("({}, {})".format(*map(_quoted, (family, text))) for family, texts in TEMPLATES.items() for text in texts)
    table = spark.sql(f"select * from values {rows} as t(family, body)")
    return table.withColumn("words", words(F.col("body")))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _variants(templates: DataFrame) -> DataFrame:
    """Templates as they turn up: whole, without one word, after a copyright line, or cut after most words."""
    size = F.size("words")
    without = F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(F.slice("words", 1, i - 1), F.slice("words", i + 1, size)))
    named = F.array(F.concat(F.array(F.lit("copyright"), F.lit("c"), F.lit("the"), F.lit("authors")), F.col("words")))
    most = F.array(F.slice("words", 1, F.ceil(size * 0.8).cast("int")))
    every = F.concat(F.array("words"), F.when(size > 3, without).otherwise(F.array("words")), named, most)
    return templates.select("family", F.explode(every).alias("words")).where(F.size("words") > 0)


def _features() -> list:
    """Words and pairs of words, hashed; a word that comes twice counts once."""
    return [
        NGram(n=2, inputCol="words", outputCol="pairs"),
        HashingTF(inputCol="words", outputCol="word_bag", numFeatures=FEATURES, binary=True),
        HashingTF(inputCol="pairs", outputCol="pair_bag", numFeatures=FEATURES, binary=True),
        VectorAssembler(inputCols=["word_bag", "pair_bag"], outputCol="features"),
    ]


def _families() -> list[str]:
    return [ORDINARY_TEXT, *sorted(TEMPLATES)]


@dataclass
class Scanner:
    """Fitted stages; a paragraph is reported below ``ordinary``, its family counts from ``family`` on."""

    model: PipelineModel
    ordinary: float
    family: float


def train(docs: DataFrame) -> Scanner:
    """Fit the classifier and calibrate its two cutoffs on rows it was not fitted on."""
    spark = docs.sparkSession
    names = F.array(*map(F.lit, _families()))
    templates = template_table(spark)
    known = templates.select(F.explode(shingles(F.col("words"))).alias("shingle")).distinct()
    # Ordinary text: corpus paragraphs, chosen by hash, that share no shingle with a template.
    order = F.xxhash64(F.lit(9), "doc_id", "paragraph")
    lines = docs.agg(F.sum(F.regexp_count("text", F.lit("\n")) + 1)).first()[0] or 0
    drawn = common.first_by(paragraphs(docs).select("doc_id", "paragraph", "words"), order, ORDINARY, lines)
    tagged = common.WorkTable(drawn.select("words", F.monotonically_increasing_id().alias("row")), "drawn").df
    near = tagged.select("row", F.explode(shingles(F.col("words"))).alias("shingle")).join(known, "shingle").select("row").distinct()
    ordinary = tagged.join(near, "row", "left_anti").select(F.lit(ORDINARY_TEXT).alias("family"), "words")
    variants = _variants(templates).unionByName(ordinary)
    held = F.pmod(F.xxhash64("words"), F.lit(4)) == 0
    # Every family weighs as much as ordinary text.
    rows = variants.withColumn("held", held).withColumn("label", F.array_position(names, F.col("family")) - 1.0)
    weights = rows.groupBy("family").agg((1000.0 / F.count("*")).alias("weight"))
    weighed = common.WorkTable(rows.join(weights, "family"), "paragraphs").df
    regression = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", family="multinomial", regParam=1e-4, maxIter=40)
    model = Pipeline(stages=[*_features(), regression]).fit(weighed.where("not held"))
    judged = _probabilities(model, weighed.where("held")).select("label", F.get("p", 0).alias("none"), F.get("p", F.col("label").cast("int")).alias("own"))
    plain = F.col("label") == 0
    low, own = judged.agg(
        F.percentile(F.when(plain, F.col("none")), FALSE_ALARMS), F.percentile(F.when(~plain, F.col("own")), MISSED)
    ).first()
    return Scanner(model, min(0.5, 0.5 if low is None else low), 0.5 if own is None else own)


def _probabilities(model: PipelineModel, rows: DataFrame) -> DataFrame:
    done = model.transform(rows).withColumn("p", vector_to_array("probability"))
    return done.drop("pairs", "word_bag", "pair_bag", "features", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity, body) of paragraphs that look like licences."""
    names = F.array(*map(F.lit, _families()[1:]))
    scored = _probabilities(scanner.model, paragraphs(docs)).where(F.get("p", 0) < scanner.ordinary)
    families = F.slice("p", 2, len(TEMPLATES))
    guessed = scored.select(
        "doc_id", "paragraph", "body", shingles(F.col("words")).alias("own"), _running("words").alias("running"),
        F.array_max(families).alias("probability"), F.get(names, (F.array_position(families, F.array_max(families)) - 1).cast("int")).alias("guess"),
    )
    theirs = F.struct(shingles(F.col("words")).alias("shingles"), _running("words").alias("running"), (F.size("words") < SHINGLE).alias("short"))
    templates = template_table(docs.sparkSession).groupBy(F.col("family").alias("guess")).agg(F.collect_list(theirs).alias("theirs"))
    # A template inside the paragraph, or the paragraph inside a template; a template shorter than a
    # shingle has to stand in the paragraph as it is.
    inside = lambda t: F.size(F.array_intersect(t["shingles"], F.col("own"))) / F.least(F.size(t["shingles"]), F.size("own"))
    shared = lambda t: F.when(t["short"], F.contains(F.col("running"), t["running"]).cast("double")).otherwise(inside(t))
    compared = guessed.join(templates, "guess").withColumn("similarity", F.array_max(F.transform("theirs", shared)))
    sure = (F.col("probability") >= scanner.family) & (F.col("similarity") >= SIMILARITY)
    family = F.when(sure, F.col("guess")).otherwise(F.lit(UNKNOWN))
    return compared.select("doc_id", F.col("paragraph").cast("long").alias("paragraph"), family.alias("family"), "probability", "similarity", "body")
