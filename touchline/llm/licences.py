"""Licence families of paragraphs, by a classifier over word n-grams and by comparison with templates.

DataFrame functions only. A paragraph is a line. Its features are the pairs and triples of words that
occur in the templates; others carry no weight, so a paragraph without any is no licence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.llm.shared import stored

NONE, UNKNOWN = "none", "unknown"
CORPUS_ROWS = 4_000
LEAST_SIMILARITY = 0.5

#: How licences are usually named or granted.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache License 2.0.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Distributed under the terms of the MIT License.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GNU GPL v3.",
        "Licensed under the GNU General Public License version 2 or later.",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "cc_by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Available under the Creative Commons Attribution license.",
    ],
    "cc_by_sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc_by_nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without permission.",
        "Unauthorized copying of this file is strictly prohibited. Proprietary and confidential.",
    ],
    UNKNOWN: [
        "Licensed under the terms given elsewhere.",
        "This work is licensed under a private license.",
        "Released under a custom license, version 7.",
        "Subject to the license of its owner.",
        "Licensed under the Example License, Version 9.1.",
        "This software is licensed under other terms.",
    ],
}
FAMILIES = [*TEMPLATES, NONE]


@dataclass
class LicenceModel:
    """``weights``: n, hash and one column per family; ``templates``: family and features of each."""

    weights: DataFrame
    intercepts: list[float]
    templates: DataFrame
    floor: float


def _rows(spark: SparkSession, items: list[tuple], names: list[str]) -> DataFrame:
    """A small table of literals."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, item, strict=True)]) for item in items]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def words_of(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id``, place and text of every line."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))


def _pairs(rows: DataFrame) -> DataFrame:
    """One row per pair of neighbouring words, with the hashes of the pair and of the triple it opens."""
    at = F.col("_at")
    hashed = rows.withColumn("_words", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    last = F.size("_words") - 2
    nth = lambda j: F.get("_words", at + j)
    return hashed.select("*", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("_at")).withColumns(
        {
            "_pair": F.xxhash64(nth(0), nth(1)),
            "_triple": F.when(at < last, F.xxhash64(nth(0), nth(1), nth(2))),
        }
    )


def _grams(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each pair and triple as a row."""
    kind = lambda n, gram: F.struct(F.lit(n).alias("n"), F.col(gram).alias("gram"))
    both = F.array(kind(2, "_pair"), kind(3, "_triple"))
    return _pairs(rows).select(*keys, F.explode(both).alias("g")).select(*keys, "g.*").filter("gram is not null")


def _statements(spark: SparkSession) -> DataFrame:
    items = [(f, i, t) for f, texts in TEMPLATES.items() for i, t in enumerate(texts)]
    return _rows(spark, items, ["family", "template", "text"]).withColumn("words", words_of(F.col("text")))


def train(docs: DataFrame, corpus_rows: int = CORPUS_ROWS) -> LicenceModel:
    """Multinomial logistic regression on cuttings of the templates and on ordinary paragraphs.

    A cutting drops up to two words at either end of a template. Ordinary paragraphs are the first
    ``corpus_rows`` by hash of text that share fewer than three features with the templates; this
    bound is the only sample. ``floor`` is the calibrated limit of the unknown class: the largest
    probability that a cutting of an unknown licence gives to any family, or the 1 % point of what
    cuttings of known ones give to theirs, whichever is higher, but at most 0.95.
    """
    spark = docs.sparkSession
    statements = _statements(spark)
    grams = _grams(statements, ["family", "template"]).distinct()
    # Bounded by the templates above.
    found = sorted((r["n"], r["gram"]) for r in grams.select("n", "gram").distinct().collect())
    vocabulary = F.broadcast(_rows(spark, [(i, n, g) for i, (n, g) in enumerate(found)], ["feature", "n", "gram"]))
    drop = F.explode(F.sequence(F.lit(0), F.lit(2)))
    cuttings = (
        statements.select("family", "template", "words", drop.alias("head"))
        .select("*", drop.alias("tail"))
        .filter(F.size("words") - F.col("head") - F.col("tail") >= 2)
        .withColumn("words", F.expr("slice(words, head + 1, size(words) - head - tail)"))
        .select(F.concat_ws("/", "family", "template", "head", "tail").alias("row"), "family", "words")
    )
    # Hashes are ranked before the lines themselves are fetched, so that whole texts are not shuffled.
    lines = paragraphs(docs).select("line", F.xxhash64("line").alias("h")).filter(F.col("line").rlike(r"[\p{L}\p{N}]"))
    first = stored(lines.select("h").distinct().orderBy("h").limit(corpus_rows), "line_hashes")
    lines = lines.join(F.broadcast(first), "h", "left_semi").distinct().orderBy("h", "line").limit(corpus_rows)
    ordinary = lines.select(
        F.concat(F.lit("line/"), "line").alias("row"), F.lit(NONE).alias("family"), words_of(F.col("line")).alias("words")
    )
    rows = stored(cuttings.unionAll(ordinary), "licence_rows")
    counted = (
        _grams(rows, ["row", "family"]).join(vocabulary, ["n", "gram"]).groupBy("row", "family", "feature").count()
    )
    entries = F.map_from_entries(F.collect_list(F.struct("feature", F.col("count").cast("double"))))
    filled = counted.groupBy("row", "family").agg(entries.alias("m"), F.count(F.lit(1)).alias("k"))
    width = len(found)
    vector = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))
    )
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")).cast("double") - 1
    plain = rows.filter(F.col("family") == NONE).join(filled.select("row"), "row", "left_anti")
    zeros = F.array_repeat(F.lit(0.0), width)
    learn = (
        filled.filter((F.col("family") != NONE) | (F.col("k") < 3))
        .select("family", label.alias("label"), array_to_vector(vector).alias("features"))
        .unionAll(plain.select("family", label.alias("label"), array_to_vector(zeros).alias("features")))
        # One line that is always there, so that the class of ordinary paragraphs is never empty.
        .unionAll(
            spark.range(50).select(
                F.lit(NONE).alias("family"), F.lit(float(len(FAMILIES) - 1)).alias("label"), array_to_vector(zeros).alias("features")
            )
        )
    )
    learn = stored(learn.withColumn("features", vector_to_array("features")), "licence_vectors")
    vectors = learn.select("family", "label", array_to_vector("features").alias("features")).coalesce(4)
    model = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=60, standardization=False).fit(vectors)
    matrix = model.coefficientMatrix.toArray()
    weights = _rows(
        spark,
        [(i, n, g, *map(float, matrix[:, i])) for i, (n, g) in enumerate(found)],
        ["feature", "n", "gram", *(f"w{k}" for k in range(len(FAMILIES)))],
    )
    p = vector_to_array(F.col("probability"))
    known = F.slice(p, 1, len(FAMILIES) - 2)
    judged = model.transform(vectors).filter(F.col("family") != NONE)
    own = F.get(p, F.col("label").cast("int"))
    levels = judged.select(
        F.max(F.when(F.col("family") == UNKNOWN, F.array_max(known))).alias("u"),
        F.percentile_approx(F.when(F.col("family") != UNKNOWN, own), 0.01).alias("k"),
    ).first()
    features = (
        grams.join(vocabulary, ["n", "gram"])
        .filter(F.col("family") != UNKNOWN)
        .groupBy("family", "template")
        .agg(F.collect_set("feature").alias("template_features"))
    )
    floor = min(0.95, max(levels["u"] or 0.0, levels["k"] or 0.0))
    return LicenceModel(weights, [float(b) for b in model.interceptVector], features, floor)


def scan(docs: DataFrame, model: LicenceModel, least_similarity: float = LEAST_SIMILARITY) -> DataFrame:
    """Paragraphs that hold a licence: family, probability, and likeness to the family's templates.

    A paragraph is reported if the classifier finds something else than ordinary text likeliest. Its
    family stands if its probability reaches the model's floor and its words hold at least
    ``least_similarity`` of the pairs and triples of one of the family's templates (``confirmed``);
    otherwise it is ``unknown``. Lines without a word, NULL and empty texts give no rows; repeated rows
    of one id are taken as one; rows with a NULL id as one document; other columns are not read.
    """
    grams = model.weights
    names = [f"w{k}" for k in range(len(FAMILIES))]
    # The weights have as many rows as the templates have pairs and triples: a few hundred.
    pair_weights = F.broadcast(grams.filter("n = 2").select(F.col("gram").alias("_pair"), "feature", *names))
    triple_weights = F.broadcast(
        grams.filter("n = 3").select(
            F.col("gram").alias("_triple"), F.col("feature").alias("feature3"), *[F.col(w).alias(f"t{w}") for w in names]
        )
    )
    lines = paragraphs(docs).select("doc_id", "paragraph", words_of(F.col("line")).alias("words"))
    hits = _pairs(lines).select("doc_id", "paragraph", "_at", "_pair", "_triple").join(
        pair_weights, "_pair"
    )
    hits = hits.join(triple_weights, "_triple", "left")
    repeated = hits.groupBy("doc_id", "paragraph", "_at").agg(
        F.first("feature").alias("feature"),
        F.first("feature3").alias("feature3"),
        *[F.first(F.col(w) + F.coalesce(F.col(f"t{w}"), F.lit(0.0))).alias(w) for w in names],
    )
    logits = [F.sum(w) + F.lit(b) for w, b in zip(names, model.intercepts, strict=True)]
    sums = repeated.groupBy("doc_id", "paragraph").agg(
        F.array(*logits).alias("logits"),
        F.array_union(F.collect_set("feature"), F.collect_set("feature3")).alias("features"),
    )
    top = F.array_max("logits")
    total = F.aggregate("logits", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    place = F.array_position("logits", top)
    best = sums.select(
        "doc_id",
        "paragraph",
        "features",
        F.element_at(F.array(*map(F.lit, FAMILIES)), place.cast("int")).alias("likeliest"),
        (F.lit(1.0) / total).alias("probability"),
    ).filter(F.col("likeliest") != NONE)
    shared = F.size(F.array_intersect("features", "template_features")) / F.size("template_features")
    alike = (
        best.join(F.broadcast(model.templates), best["likeliest"] == model.templates["family"], "left")
        .groupBy("doc_id", "paragraph", "likeliest", "probability")
        .agg(F.coalesce(F.max(shared), F.lit(0.0)).alias("similarity"))
    )
    confirmed = (F.col("probability") >= model.floor) & (F.col("similarity") >= least_similarity)
    return alike.select(
        "doc_id",
        "paragraph",
        F.when(confirmed, F.col("likeliest")).otherwise(UNKNOWN).alias("family"),
        "likeliest",
        "probability",
        "similarity",
        confirmed.alias("confirmed"),
    )
