"""Licence scan with a trained paragraph classifier.

Sentences that hold a licence cue are taken out of every whole text and classified by multinomial logistic regression
over hashed word 1- to 3-grams. It is trained in the session on notices of each family in several forms, on cue
sentences that name no known family, and on a bounded sample of ordinary sentences of the corpus: distinct ones without
a cue, taken by their hash over the whole table, wherever they stand in it. The last two are the class ``unknown``; the probability from which a family is believed is calibrated on held-out forms so that no unknown
one reaches it. A believed family is confirmed by comparing the sentence's n-grams with the family's notices.

Native: DataFrame functions and Spark's own ML transformers, no Python on executors. Only sentences with a cue are
exploded, by document; one grouping by id brings them back. A sentence without a cue has no feature that a family's
notices have in the training set apart from function words, so it is unknown without being scored.

Bounds: ``SAMPLE_SENTENCES`` ordinary sentences for training; the notices are fixed values.

Defined results: null and empty texts, and texts without cues, have no licences; equal sentences of one document count
each; rows with equal ids share their findings.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import materialize

FEATURES = 1 << 13
SAMPLE_SENTENCES = 2_000
HASHES = 1 << 40
CONFIRM = 0.6  # share of n-grams in common, of the shorter side
FLOOR = 0.5  # lowest probability ever believed

CUES = r"(?i)licen[sc]|copyright|copyleft|all rights reserved|public domain|redistribut|permission is hereby|warrant(?:y|ies)|SPDX|creative commons|\bCC[ -](?:BY|0)\b"

# Notices by family, as they are commonly written.
NOTICES = {
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "agpl-3.0": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced without written permission.",
        "This software is proprietary and confidential; redistribution is prohibited.",
    ],
}

# Sentences with cues that state no known licence.
OTHERS = [
    "Licensed under the terms of the company agreement.",
    "This work is licensed under the house rules of the archive, version 7.",
    "Released under the terms agreed with the publisher.",
    "The licence was renewed last year by the ministry.",
    "She lost her driving license on the way home.",
    "Copyright law differs between countries.",
    "The warranty covers parts and labour for two years.",
    "A licence fee is due every month.",
    "Copyright belongs to the respective authors.",
    "They asked for a license to sell food in the market.",
    "The fishing licence costs ten pounds.",
    "The old song has been in the public domain for decades.",
    "The council will redistribute the funds among the schools.",
    "Licensed premises must close at eleven.",
    "Subject to the conditions of the licensing board, version of May.",
    "Licensed under the community charter, edition 4.",
]


def sentences(text: Column) -> Column:
    """Lines, cut further where a sentence ends and the next begins with a capital letter."""
    return F.split(F.coalesce(text, F.lit("")), r"\n|(?<=[.!?])\s+(?=\p{Lu})")


def grams(text: Column) -> Column:
    """Distinct word 1- to 3-grams, case and punctuation aside."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}.+-]+|\.(?=\s|$)"), "")
    n = F.size(words)
    ahead = lambda k: F.slice(words, F.lit(k), F.greatest(n, F.lit(1)))
    rows = F.arrays_zip(words.alias("a"), ahead(2).alias("b"), ahead(3).alias("c"))
    cells = F.transform(rows, lambda r: F.array(
        r["a"], F.when(r["b"].isNotNull(), F.concat_ws(" ", r["a"], r["b"])),
        F.when(r["c"].isNotNull(), F.concat_ws(" ", r["a"], r["b"], r["c"])),
    ))
    return F.array_distinct(F.array_compact(F.flatten(cells)))


def _fixed(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f, t in rows])
    return spark.range(1).select(F.inline(cells))


def _forms(text: str) -> list[str]:
    """A notice as it is, in other dress, and in part."""
    words = text.split()
    out = [text, text.upper(), text.rstrip(".") + ",", "Note: " + text, text + " See the file for details.", text.replace("This work", "The following text")]
    if len(words) > 12:
        half = len(words) // 2
        out += [" ".join(words[:half]), " ".join(words[half // 2 : half // 2 + half])]
    return out


def _ordinary(docs: DataFrame, text_col: str) -> DataFrame:
    """Distinct sentences without a cue, those with the lowest hashes of the whole table."""
    plain = F.filter(sentences(F.col(text_col)), lambda s: (F.length(F.trim(s)) > 0) & ~s.rlike(CUES))
    rows = docs.select(F.explode(plain).alias("text"))
    key = F.pmod(F.xxhash64("text"), F.lit(HASHES))
    # A sketch of the number of distinct sentences gives the share of hashes that holds enough of them.
    known = rows.agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).first()["n"]
    below = HASHES if known <= 2 * SAMPLE_SENTENCES else HASHES * 2 * SAMPLE_SENTENCES // known
    return rows.filter(key < F.lit(below)).distinct().orderBy(key, "text").limit(SAMPLE_SENTENCES)


class LicenseModel:
    def __init__(self, hasher: HashingTF, model: LogisticRegressionModel, families: list[str], believed: float):
        self.hasher, self.model, self.families, self.believed = hasher, model, families, believed

    def classify(self, rows: DataFrame, text_col: str) -> DataFrame:
        """``rows`` with ``family``, ``probability`` and ``similarity`` to the family's nearest notice."""
        keep = rows.columns
        scored = self.model.transform(self.hasher.transform(rows.withColumn("__grams", grams(F.col(text_col)))))
        p = vector_to_array("probability")
        best = scored.select(*keep, "__grams", p.alias("__p")).withColumn("probability", F.array_max("__p"))
        names = F.array(*map(F.lit, self.families))
        guess = F.element_at(names, F.array_position("__p", F.col("probability")).cast("int"))
        near = F.coalesce(F.when(F.lit(False), F.lit(0.0)), *[
            F.when(F.col("guess") == family, F.greatest(F.lit(0.0), *[_alike(F.col("__grams"), t) for t in texts]))
            for family, texts in NOTICES.items()
        ], F.lit(0.0))
        out = best.withColumn("guess", guess).withColumn("similarity", near)
        believed = (F.col("probability") >= self.believed) & (F.col("similarity") >= CONFIRM)
        return out.select(*keep, F.when(believed, F.col("guess")).otherwise("unknown").alias("family"), "probability", "similarity")


def _alike(cells: Column, notice: str) -> Column:
    """Share of n-grams in common with a notice, of the shorter side."""
    other = grams(F.lit(notice))
    return F.size(F.array_intersect(cells, other)) / F.greatest(F.least(F.size(cells), F.size(other)), F.lit(1))


def train(docs: DataFrame, text_col: str = "text") -> LicenseModel:
    """Fit on the fixed notices and a bounded sample of the corpus's sentences; calibrate on held-out forms."""
    spark = docs.sparkSession
    families = ["unknown", *NOTICES]
    fit_rows, held_rows = [], []
    for family, texts in [*NOTICES.items(), ("unknown", OTHERS)]:
        for i, text in enumerate(texts):
            for j, form in enumerate(_forms(text)):
                # Of the unknown ones whole sentences are held out, of the families some forms.
                held = i % 4 == 3 if family == "unknown" else j in (3, 5)
                (held_rows if held else fit_rows).append((family, form))
    plain = _ordinary(docs, text_col).select(F.lit("unknown").alias("family"), F.substring("text", 1, 2_000).alias("text"))
    rows = materialize(_fixed(spark, fit_rows).union(plain), "notices").withColumn("__grams", grams(F.col("text")))
    hasher = HashingTF(inputCol="__grams", outputCol="features", numFeatures=FEATURES, binary=True)
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    # Weights even out the classes.
    weight = F.when((F.col("family") == "unknown") & ~F.col("text").rlike(CUES), 0.02).otherwise(1.0)
    ready = hasher.transform(rows).withColumns({"label": label.cast("double"), "weight": weight}).cache()
    model = LogisticRegression(family="multinomial", regParam=2e-3, maxIter=60, weightCol="weight", standardization=False).fit(ready)
    ready.unpersist()
    held = model.transform(hasher.transform(_fixed(spark, held_rows).withColumn("__grams", grams(F.col("text")))))
    p = vector_to_array("probability")
    strays = held.filter("family = 'unknown'").select(F.array_max(F.slice(p, 2, len(families))).alias("p"))
    top = strays.agg(F.max("p")).first()[0] or 0.0
    return LicenseModel(hasher, model, families, max(FLOOR, round(top + 0.01, 4)))


def license_sentences(docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sentence, family, probability, similarity) of every sentence with a cue."""
    cued = F.filter(sentences(F.col(text_col)), lambda s: s.rlike(CUES))
    rows = docs.filter(F.col(text_col).rlike(CUES)).select(F.col(id_col).alias("id"), F.explode(cued).alias("sentence"))
    return model.classify(rows, "sentence")


def document_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id with ``n_sentences`` (with a cue), ``n_licensed`` and ``families`` (sorted, comma-joined)."""
    found = license_sentences(docs, train(docs, text_col), id_col, text_col)
    known = F.when(F.col("family") != "unknown", F.col("family"))
    per = found.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_sentences"), F.count(known).alias("n_licensed"), F.array_join(F.sort_array(F.collect_set(known)), ",").alias("families")
    )
    return docs.select(id_col).join(per, docs[id_col].eqNullSafe(per["id"]), "left").select(
        id_col, F.coalesce("n_sentences", F.lit(0)).alias("n_sentences"), F.coalesce("n_licensed", F.lit(0)).alias("n_licensed"),
        F.coalesce("families", F.lit("")).alias("families"),
    )
