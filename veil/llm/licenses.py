"""License scan: a trained paragraph classifier whose findings are confirmed against templates.

Paragraphs are lines that follow each other up to one without words, so that wrapped notices and comments stay
whole; long ones are read in overlapping windows. A sparse logistic regression over hashed
word pairs, trained here on the templates in many damaged forms and on all paragraphs of the corpus, gives
each paragraph a family or none. A paragraph counts only if its families together are above a level that hardly
any held-out foreign paragraph reaches, and a family only if enough of a template of it is found there. Families
beside the likeliest one must also show what sets their template apart from those of the likeliest.

Everything runs on DataFrame functions and Spark's own learner.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from veil.llm.common import column, stored, text_of

UNKNOWN = "unknown"
WINDOW, STRIDE = 60, 30
FEATURES = 1 << 14
VARIANTS = 48
# The foreign paragraphs whose words stand around damaged notices, and the windows of each on average. All foreign windows
# of the corpus weigh no more than that many together, so that the notices keep their weight in a corpus of any size.
FOREIGN, PER_FOREIGN = 4000, 4
_EXAMPLES = StructType(
    [StructField("label", DoubleType()), StructField("foreign", BooleanType()), StructField("held_out", BooleanType()), StructField("features", VectorUDT())]
)
CONFIRMED = 0.6
# More than this share of what a template does not have in common with the likeliest family.
BESIDE = 0.8
_WORD = r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"

# A line break before a line without words.
_BLANK = r"\n[^\p{L}\p{N}\n]*+(?=\n)"
_SPDX = "spdx-license-identifier"
# An identifier of an SPDX expression and the operator after it.
_OPERAND = rf"((?:{_SPDX}:?|\G(?!^))[ \t(]+)([^\s()]+(?:[ \t]+with[ \t]+[^\s()]+)?[ \t)]+)(?:or|and)(?=[ \t(])"

# Short notices as licence texts prescribe or recommend them.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License.",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "AGPL-3.0": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
# Sentences with the words of licences that are none, as examples of the unknown class.
_NEAR_MISSES = [
    "The driver must carry a license and a permit at all times.",
    "He was granted permission to use the copy room without charge.",
    "The general public is free to visit the foundation.",
    "Version 2.0 of the software was released under pressure in 2004.",
    "All rights of way are subject to the following conditions.",
    "A common work of the creative class at MIT in version 3.",
]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def pairs_of(words: Column) -> Column:
    """Neighbouring words, joined."""
    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.zip_with(firsts, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))


def blocks_of(docs: DataFrame) -> DataFrame:
    """``row, doc_id, paragraph, content``: the lines between those without words, and one null content for each row."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), column("doc_id").cast("long").alias("doc_id"), text_of().alias("content")
    )
    every = F.concat(F.split("content", _BLANK), F.array(F.lit(None).cast("string")))
    return rows.select("row", "doc_id", F.posexplode(every).alias("paragraph", "content"))


def paragraphs(blocks: DataFrame) -> DataFrame:
    """``row, doc_id, paragraph, words``: the words of each paragraph, in windows that overlap by half where it is long.

    A null content has one row without words; other columns stay. Each identifier of an SPDX expression follows the tag, as it does in the templates.
    """
    low = F.lower("content")
    listed = F.when(F.contains(low, F.lit(_SPDX)), F.regexp_replace(low, _OPERAND, f"$1$2{_SPDX}")).otherwise(low)
    every = words_of(listed)
    cut = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("every") - (WINDOW - STRIDE), F.lit(1)), F.lit(STRIDE)),
        lambda at: F.slice("every", at, F.lit(WINDOW)),
    )
    # no filter on the words: it would be pushed below and split each paragraph twice
    own = F.when(F.size("every") > WINDOW, cut).otherwise(F.filter(F.array("every"), lambda w: F.size(w) > 0))
    own = F.when(F.col("every").isNull(), F.array(F.array().cast("array<string>"))).otherwise(own)
    place = [c for c in blocks.columns if c != "content"]
    return blocks.select(*place, every.alias("every")).select(*place, F.explode(own).alias("words"))


def templates(spark: SparkSession) -> DataFrame:
    """``family, words`` of each notice."""
    rows = [(f, t) for f, texts in TEMPLATES.items() for t in texts]
    return spark.createDataFrame(rows, "family string, content string").select("family", words_of(F.col("content")).alias("words"))


def _examples(spark: SparkSession, foreign: DataFrame) -> DataFrame:
    """``label, words, bare``: notices with words dropped, half of them between words of the foreign windows."""
    names = [UNKNOWN, *TEMPLATES]
    number = F.element_at(F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(float(i)))]), F.col("family"))
    near = spark.createDataFrame([(UNKNOWN, t) for t in _NEAR_MISSES], "family string, content string")
    notices = templates(spark).unionByName(near.select("family", words_of(F.col("content")).alias("words")))
    varied = notices.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    # each variant drops about a word in twelve; half of them stand between words of a foreign paragraph
    key = F.xxhash64("words", "variant")
    dropped = F.filter("words", lambda w, i: F.pmod(F.xxhash64(w, i, F.col("variant")), F.lit(12)) > 0)
    around = foreign.where("NOT held_out").select(
        F.pmod(F.xxhash64("words"), F.lit(1 << 10)).alias("slot"), F.slice("words", 1, 25).alias("before"), F.slice("words", 26, 25).alias("after")
    ).dropDuplicates(["slot"])
    placed = varied.select(number.alias("label"), dropped.alias("kept"), "variant", F.pmod(key, F.lit(1 << 10)).alias("slot"))
    # at most 1,024 rows of 50 words
    inside = placed.join(F.broadcast(around), "slot", "left")
    none = F.array().cast("array<string>")
    edge = lambda c: F.when(F.col("variant") % 2 == 1, F.coalesce(F.col(c), none)).otherwise(none)
    return inside.select("label", F.concat(edge("before"), "kept", edge("after")).alias("words"), (F.col("variant") % 2 == 0).alias("bare"))


def _hashing() -> HashingTF:
    return HashingTF(inputCol="terms", outputCol="features", numFeatures=FEATURES, binary=True)


def _terms(df: DataFrame) -> DataFrame:
    return df.withColumn("terms", pairs_of(F.col("words")))


@dataclass(frozen=True)
class LicenseModel:
    stages: PipelineModel
    level: float
    """The probability that the families must have together."""


def _below(hashed: DataFrame, h: str, n: int) -> DataFrame:
    """The rows whose hash is one of about ``1.5 n`` of all different hashes (all, if fewer)."""
    about = hashed.agg(F.approx_count_distinct(h)).first()[0]
    return hashed.where(F.col(h) <= min(2**63 - 1, -(2**63) + int(2**64 * min(1.0, 1.5 * n / max(1, about)))))


def _drawn(docs: DataFrame, n: int) -> DataFrame:
    """``words`` of at most ``n * PER_FOREIGN`` different windows, of about ``n`` different paragraphs, all drawn by hash.

    Counts set the hash below which a row is drawn, so hardly more rows are ordered than are kept.
    """
    hashed = blocks_of(docs).where("content IS NOT NULL").withColumn("h", F.xxhash64("content"))
    windows = stored(paragraphs(_below(hashed, "h", n)).select("words", F.xxhash64("words").alias("w")), "license-windows")
    one = _below(windows, "w", n * PER_FOREIGN).groupBy("w").agg(F.min("words").alias("words"))
    return one.orderBy("w").limit(n * PER_FOREIGN).select("words")


def _alike(spark: SparkSession) -> Column:
    """How many different word pairs of the templates are among the ``terms``."""
    # some hundred pairs, as values: an expression of theirs would be worked out for each row
    known = sorted({p for r in templates(spark).select(pairs_of(F.col("words")).alias("pairs")).collect() for p in r["pairs"]})
    return F.size(F.array_distinct(F.filter("terms", lambda p: p.isin(known))))


def _foreign(windows: DataFrame) -> DataFrame:
    """``words, h, held_out`` of the windows, and ``alike``: below three for those that are like no template.

    A quarter is held out for the calibration.
    """
    h = F.xxhash64("words")
    told = _terms(windows).select("words", "terms", h.alias("h"), (F.pmod(h, F.lit(4)) == 0).alias("held_out"))
    return told.withColumn("alike", _alike(windows.sparkSession))


def _places() -> Column:
    """The places of the terms in the sparse ``features``."""
    return F.unwrap_udt("features")["indices"].cast("array<short>").alias("places")


def _vectors(rows: DataFrame, label: str) -> DataFrame:
    """Stored ``label, foreign, held_out, features`` of rows with the ``places`` of their terms."""
    # the stored form of a sparse vector of ones
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(FEATURES).alias("size"),
        F.col("places").cast("array<int>").alias("indices"), F.array_repeat(F.lit(1.0), F.size("places")).alias("values"),
    )
    return stored(rows.select("label", "foreign", "held_out", vector.alias("features")), label, _EXAMPLES)


def _examples_of(docs: DataFrame, notices: DataFrame) -> DataFrame:
    """Stored ``label, foreign, held_out, features`` of the notices and of every different foreign window of the corpus.

    ``notices`` have features. Windows that repeat are told by their hash; only the places of their terms are shuffled.
    """
    windows = _hashing().transform(_foreign(paragraphs(blocks_of(docs).where("content IS NOT NULL")).select("words")))
    # a filter on rows would be pushed below and make their terms twice
    different = windows.select("h", "held_out", "alike", _places()).groupBy("h", "held_out").agg(F.min("alike").alias("alike"), F.min("places").alias("places"))
    foreign = different.where("alike < 3").select(F.lit(0.0).alias("label"), F.lit(True).alias("foreign"), "held_out", "places")
    own = notices.select("label", F.lit(False).alias("foreign"), F.lit(False).alias("held_out"), _places())
    return _vectors(own.unionByName(foreign), "license-examples")


def _lent(examples: DataFrame, notices: DataFrame) -> DataFrame:
    """Notices amid the terms of about one in 15 foreign windows, as many as there are of 12,000: otherwise those of a large
    corpus would tell that there is no notice near them."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 10)).alias("slot")
    # at most 1,024 rows; about half of the slots have one
    bare = notices.where("bare").select("label", _places()).select("label", F.col("places").alias("own"), slot("places")).dropDuplicates(["slot"])
    windows = examples.where("foreign AND NOT held_out").select("foreign", "held_out", _places()).where(F.pmod(F.xxhash64("places", F.lit(1)), F.lit(8)) == 0)
    amid = windows.withColumn("slot", slot("places")).join(F.broadcast(bare), "slot")
    return _vectors(amid.withColumn("places", F.array_sort(F.array_union("places", "own"))), "notices-amid-windows")


def _weighted(examples: DataFrame, notices: DataFrame, n: int) -> DataFrame:
    """The examples with a ``weight``: one for a notice, and no more than ``n`` for all foreign windows together; where
    they are more, notices amid them have the weight of a window."""
    found = examples.where("foreign").count()
    if found > n:
        examples = examples.unionByName(_lent(examples, notices))
    return examples.withColumn("weight", F.when(F.col("foreign"), F.lit(min(1.0, n / max(1, found)))).otherwise(F.lit(1.0)))


def fit(docs: DataFrame, foreign: int = FOREIGN) -> LicenseModel:
    """Train on the templates and every different window of the corpus that is like none of them, but for the quarter of
    these that the level is calibrated on.

    Damaged forms of the templates stand between words of windows of about ``foreign`` paragraphs, and all foreign windows
    weigh no more than these, however many they are.
    """
    others = stored(_foreign(_drawn(docs, foreign)).where("alike < 3").select("words", "held_out"), "foreign-paragraphs")
    learner = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=40, standardization=False, weightCol="weight")
    notices = _hashing().transform(_terms(_examples(docs.sparkSession, others)))
    examples = _examples_of(docs, notices)
    taught = learner.fit(_weighted(examples, notices, foreign * PER_FOREIGN).where("NOT held_out").select("label", "features", "weight"))
    best = 1 - F.element_at(vector_to_array("probability"), 1)
    reached = taught.transform(examples.where("held_out")).agg(F.percentile_approx(best, 0.999, 10000)).first()[0]
    return LicenseModel(PipelineModel([_hashing(), taught]), min(0.95, max(0.5, reached or 0.0)))


def _compared(spark: SparkSession) -> DataFrame:
    """``best, notices``: every template as ``family, pairs, beside``, the last without the pairs of the family ``best``."""
    notices = templates(spark).select("family", F.array_distinct(pairs_of(F.col("words"))).alias("pairs"))
    theirs = notices.groupBy(F.col("family").alias("best")).agg(F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("theirs"))
    notice = F.struct("family", "pairs", F.array_except("pairs", "theirs").alias("beside"))
    return theirs.crossJoin(notices).groupBy("best").agg(F.collect_list(notice).alias("notices"))


def _scored(docs: DataFrame, model: LicenseModel) -> DataFrame:
    """``row, doc_id, paragraph, words, probability, best`` of paragraphs above the level, and a row without words for each document."""
    scored = model.stages.transform(_terms(paragraphs(blocks_of(docs)))).withColumn("p", vector_to_array("probability"))
    found = scored.withColumn("probability", 1 - F.element_at("p", 1)).where((F.col("probability") > model.level) | (F.size("words") == 0))
    families = F.array(*[F.lit(f) for f in TEMPLATES])
    # position in the list of classes, of which the first is the unknown one
    likeliest = F.array_position("p", F.array_max(F.slice("p", 2, len(TEMPLATES))))
    best = F.element_at(families, F.greatest(likeliest - 1, F.lit(1)).cast("int"))
    return found.select("row", "doc_id", "paragraph", "words", "probability", best.alias("best"))


def _compare(spark: SparkSession, found: DataFrame) -> DataFrame:
    """One row for each paragraph and family: the likeliest, and all others that are confirmed."""
    found = found.withColumn("own", F.array_distinct(pairs_of(F.col("words"))))
    # one row for each family
    found = found.join(F.broadcast(_compared(spark)), "best")
    share = lambda pairs: F.size(F.array_intersect("own", pairs)) / F.greatest(F.size(pairs), F.lit(1))
    each = F.transform(
        "notices", lambda t: F.struct(t["family"].alias("family"), share(t["pairs"]).alias("similarity"), share(t["beside"]).alias("beside"))
    )
    found = found.select("row", "doc_id", "paragraph", "probability", "best", each.alias("each"))
    mine = F.filter("each", lambda t: t["family"] == F.col("best"))
    first = F.struct(F.col("best").alias("family"), F.array_max(F.transform(mine, lambda t: t["similarity"])).alias("similarity"))
    others = F.filter("each", lambda t: (t["family"] != F.col("best")) & (t["similarity"] >= CONFIRMED) & (t["beside"] > BESIDE))
    others = F.transform(others, lambda t: F.struct(t["family"].alias("family"), t["similarity"].alias("similarity")))
    return found.select("row", "doc_id", "paragraph", "probability", F.inline(F.concat(F.array(first), others))).select(
        "row", "doc_id", "paragraph", "family", "probability", "similarity", (F.col("similarity") >= CONFIRMED).alias("confirmed")
    )


def predictions(docs: DataFrame, model: LicenseModel) -> DataFrame:
    """``row, doc_id, paragraph, family, probability, similarity, confirmed`` of paragraphs that the classifier takes for
    licences: the likeliest family, and all others that are confirmed."""
    return _compare(docs.sparkSession, _scored(docs, model).where(F.size("words") > 0))


def license_scan(docs: DataFrame, foreign: int = FOREIGN) -> DataFrame:
    """One row per document: ``doc_id, families, n_confirmed, n_unconfirmed, similarity``.

    ``families`` lists the confirmed licence families in alphabetical order, separated by commas, and is
    empty without any; ``similarity`` is the best share of a template that was found. A null text is empty, a null id
    stays null. Repeated rows keep their rows, also where a second reading of the table would order them otherwise; other
    columns are ignored.
    """
    model = fit(docs, foreign)
    # rows are numbered in one reading, whose result holds every document, so that any table may come in
    scored = stored(_scored(docs, model), "license-paragraphs")
    found = _compare(docs.sparkSession, scored.where(F.size("words") > 0))
    sure = F.when(F.col("confirmed"), F.col("family"))
    per_row = found.groupBy("row").agg(
        F.array_join(F.array_sort(F.collect_set(sure)), ",").alias("families"),
        F.count_distinct(F.when(F.col("confirmed"), F.struct("paragraph", "family"))).alias("n_confirmed"),
        F.count_distinct(F.when(~F.col("confirmed"), F.struct("paragraph", "family"))).alias("n_unconfirmed"),
        F.max(F.when(F.col("confirmed"), F.col("similarity"))).alias("similarity"),
    )
    rows = scored.where(F.size("words") == 0).select("row", "doc_id")
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        F.coalesce("families", F.lit("")).alias("families"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_confirmed", "n_unconfirmed")],
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )
