"""Licence notices, paragraph by paragraph, in DataFrame operations only.

A logistic regression with an L1 penalty over words and pairs of words tells the licence families
and "no licence" apart.  It learns from the templates below, each in many damaged variants
set into ordinary text, and from a bounded sample of paragraphs of the corpus as "none".
A temperature, fitted on variants it has not seen, calibrates its probabilities.  A paragraph is
compared with the templates of all families: it is of the family of the closest one if at least
0.8 of that template's five-word shingles occur in it.  If none is that close, and "no licence" is
less probable than not, it is a licence of unknown class, however its probability is spread.

A paragraph is a line, or neighbouring lines over which the words of a wrapped template run;
blank lines (and lines of comment marks only) end it.  Wrapped notices that are close to no
template are scored line by line.

Every line that has a word is scored.  Lines in which the classifier sees a licence, and those with a
telling word (of the stems below, or one of a template without which less than 0.8 of the template's
shingles are left), are then compared with the templates; no other line can be reported.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinspark.llm.common import uniform
from clinspark.session import stage

# Notices and opening clauses of public licences, by family.  Fixed texts.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "This project is licensed under the terms of the MIT license"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Licensed under the BSD 3-Clause License"),
    ("BSD", "Use of this source code is governed by a BSD-style license"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("LGPL", "Licensed under the GNU Lesser General Public License"),
    ("AGPL", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("EPL", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0"),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY", "Licensed under CC BY 4.0"),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Boost", "Distributed under the Boost Software License, Version 1.0"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty"),
]

LETTERS = r"[\p{L}\p{Nd}]"
NONE = "none"
UNKNOWN = "unknown"
FEATURES = 1 << 13  # words and pairs of the training rows, the frequent first; others say nothing
SHINGLE = 5
LEAST_SIMILARITY = 0.8
LEAST_PROBABILITY = 0.5
SAMPLE_DOCS = 400  # documents whose paragraphs show what ordinary text looks like, about
SAMPLE_LINES = 3000
VARIANTS = 40  # damaged copies of each template
MARKS = r"(?im)^\s*(?:dnl|rem)(?=\s)"  # comment marks made of letters; others are no words anyway
SPREAD = 10  # words that may stand between two matching shingles of a template, besides its own
STEMS = r"licen[sc]\p{L}*|copyright\p{L}*|redistribut\p{L}*"  # words that notices of unknown licences have


def _plain_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({LETTERS}+)"), F.lit(1))


def grams_of(words: Column) -> Column:
    """The words and pairs of neighbours; the features are binary, so repeats do not count."""
    pairs = F.when(
        F.size(words) > 1,
        F.zip_with(
            F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b)
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(words, pairs)


def shingles_of(words: Column) -> Column:
    """The different runs of five words; all words, if there are fewer."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - (SHINGLE - 1)))
    return F.array_distinct(F.transform(starts, lambda i: F.concat_ws(" ", F.slice(words, i, SHINGLE))))


def once(value: Column) -> Column:
    """``value``, computed once a row: a filter or several uses of it do not repeat the work."""
    return F.explode(F.array(value))


def lines_of(docs: DataFrame, telling: str | None = None, chosen: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``uid``, ``line`` (from 0), ``begin``, ``end`` (characters) and ``paragraph`` of each line of each text.

    With ``telling`` only lines that it finds are returned, with ``chosen`` (``uid``, ``line``, each once) only those.
    Offsets are running sums of lengths, so a text takes time in proportion to its length, however many
    lines of it are returned.
    """
    at = docs.select("doc_id", "uid", F.posexplode(F.split("text", "\n")).alias("line", "paragraph"))
    wanted = F.lit(True) if telling is None else F.col("paragraph").rlike(telling)
    if chosen is not None:
        at = at.join(chosen.withColumn("chosen", F.lit(True)), ["uid", "line"], "left")
        wanted = wanted & F.col("chosen").isNotNull()
    # Lines that are not wanted are moved as lengths only.
    sized = at.withColumn("size", F.length("paragraph")).withColumn("paragraph", F.when(wanted, F.col("paragraph")))
    before = Window.partitionBy("uid").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.col("size") + 1).over(before), F.lit(0))
    return (
        sized.withColumn("begin", begin.cast("int"))
        .where("paragraph is not null")
        .select("doc_id", "uid", "line", "begin", (F.col("begin") + F.col("size")).alias("end"), "paragraph")
    )


@dataclass
class LicenceModel:
    classes: list[str]
    regression: LogisticRegressionModel | None
    temperature: float
    vocabulary: CountVectorizerModel | None = None

    def claims(self, paragraphs: DataFrame) -> DataFrame:
        """``paragraphs`` (with ``words``) with ``claim`` (the best family), its calibrated ``probability`` and
        ``licence_probability``, that of all families together."""
        counted = self.vocabulary.transform(paragraphs.withColumn("grams", grams_of(F.col("words"))))
        raw = self.regression.transform(counted)
        names = F.array(*map(F.lit, self.classes))
        return (
            raw.withColumn("margins", once(vector_to_array("rawPrediction")))
            .withColumn("families", F.slice("margins", 2, len(self.classes)))  # NONE is the first class
            .withColumn("best", F.array_max("families"))
            .withColumn("probability", _softmax(self.temperature))
            .withColumn("licence_probability", 1 - _softmax(self.temperature, F.col("margins")[0]))
            .withColumn("claim", names[F.array_position("families", F.col("best")).cast("int")])
            .select([F.col(c) for c in paragraphs.columns] + ["claim", "probability", "licence_probability"])
        )


def _softmax(temperature: float, of: Column | None = None) -> Column:
    """Probability of the class whose margin is ``of`` (the best, if not given)."""
    of = F.col("best") if of is None else of
    total = F.aggregate("margins", F.lit(0.0), lambda a, m: a + F.exp((m - of) / temperature))
    return 1 / total


def _variants(spark: SparkSession, paragraphs: DataFrame) -> DataFrame:
    """Damaged copies of the templates, most of them behind the words of an ordinary paragraph."""
    families = [(f, i, _plain_words(t)) for i, (f, t) in enumerate(TEMPLATES)]
    table = spark.createDataFrame(families, "family string, template int, words array<string>")
    copies = table.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    drop = F.lit(0.012) * (F.col("copy") % 12)
    kept = F.expr("transform(words, (w, i) -> struct(w, pmod(xxhash64(template, copy, i), 1000) / 1000.0 as u))")
    damaged = copies.withColumn("drop", drop).withColumn("kept", kept)
    damaged = damaged.withColumn("words", F.expr("transform(filter(kept, x -> x.u >= drop), x -> x.w)"))
    numbered = paragraphs.select(
        F.pmod(F.xxhash64("paragraph"), F.lit(VARIANTS)).cast("int").alias("copy"), words_of(F.col("paragraph")).alias("around")
    )
    around = numbered.groupBy("copy").agg(F.min("around").alias("around"))  # one paragraph per copy number
    return damaged.join(F.broadcast(around), "copy", "left").select(
        "family",
        "copy",
        F.when(
            (F.col("copy") % 4 != 0) & F.col("around").isNotNull(), F.concat(F.slice("around", 1, 40), F.col("words"))
        )
        .otherwise(F.col("words"))
        .alias("words"),
    )


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES, seed: int = 9) -> LicenceModel:
    """Fit on the templates and on a bounded sample of paragraphs of ``docs``.

    About ``sample_docs`` documents are taken by a hash of id and length, and ``sample_lines`` of
    their paragraphs.  Paragraphs that contain half of a template are left out of "none".
    """
    spark = docs.sparkSession
    total = docs.count()
    taken = docs.where(uniform(F.lit(seed), F.col("doc_id")) < F.lit(sample_docs / max(1, total)))
    lines = taken.select(F.explode(F.split("text", "\n")).alias("paragraph")).where(F.length("paragraph") > 0)
    lines = lines.orderBy(F.xxhash64("paragraph"), "paragraph").limit(sample_lines)
    lines = stage(lines.withColumn("words", words_of(F.col("paragraph"))), "licence-lines")
    near = F.exists(_similarities(), lambda s: s["similarity"] >= 0.5)
    ordinary = stage(lines.where(~near).coalesce(1), "licence-ordinary")

    variants = _variants(spark, ordinary)
    classes = [NONE, *sorted({f for f, _ in TEMPLATES})]
    label = F.array_position(F.array(*map(F.lit, classes)), F.col("family")).cast("double") - 1
    half = F.pmod(F.xxhash64("paragraph"), F.lit(4)).cast("int")
    rows = variants.select("family", "copy", "words").union(ordinary.select(F.lit(NONE), half, "words"))
    rows = rows.withColumn("label", label).withColumn("grams", grams_of(F.col("words")))
    rows = stage(rows.select("copy", "label", "grams").coalesce(1), "licence-grams")
    vocabulary = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=2.0, vocabSize=FEATURES).fit(rows)
    rows = stage(vocabulary.transform(rows).select("copy", "label", "features").coalesce(1), "licence-training")
    regression = LogisticRegression(regParam=0.0005, elasticNetParam=1.0, maxIter=60, family="multinomial")
    fitted = regression.fit(rows.where("copy % 4 <> 3"))

    unseen = fitted.transform(rows.where("copy % 4 = 3")).withColumn("margins", vector_to_array("rawPrediction"))
    grid = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
    right = F.col("margins")[F.col("label").cast("int")]
    losses = unseen.agg(*[F.avg(-F.log(_softmax(t, right) + 1e-12)).alias(str(i)) for i, t in enumerate(grid)]).first()
    temperature = min(zip(losses, grid, strict=True))[1] if losses[0] is not None else 1.0
    return LicenceModel(classes, fitted, temperature, vocabulary)


def _shingles(text: str) -> list[str]:
    w = _plain_words(text)
    return [" ".join(w[i : i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))]


def required_word(text: str) -> str:
    """A word that every paragraph with at least 0.8 of the template's shingles has: the longest such word."""
    wanted = {tuple(s.split()) for s in _shingles(text)}
    words = {w for s in wanted for w in s}
    needed = [w for w in words if sum(w not in s for s in wanted) / len(wanted) < LEAST_SIMILARITY]
    return max(needed, key=lambda w: (w.startswith("licens"), len(w), w))


def telling_words() -> str:
    """A pattern that finds a telling word."""
    words = sorted({required_word(text) for _, text in TEMPLATES})
    return f"(?i)(?<!{LETTERS})(?:{STEMS}|{'|'.join(words)})(?!{LETTERS})"


def _similarities() -> Column:
    """For each template the share of its shingles that the paragraph's ``words`` contain."""
    here = shingles_of(F.col("words"))
    out = []
    for family, text in TEMPLATES:
        wanted = sorted(set(_shingles(text)))
        shared = F.size(F.array_intersect(here, F.split(F.lit("|".join(wanted)), "[|]")))
        out.append(F.struct((shared / len(wanted)).alias("similarity"), F.lit(family).alias("family"), F.lit(len(wanted)).alias("size")))
    return F.array(*out)


def wrapped(docs: DataFrame) -> DataFrame:
    """``uid``, ``line`` and ``last_line`` of lines that only together hold at least 0.8 of a template's shingles."""
    lines = F.split("text", "\n")
    plain = lambda text: words_of(F.regexp_replace(text, MARKS, " "))
    # A line without words stands as an empty word, which is in no shingle.
    token = lambda w, i: F.struct(w.alias("w"), i.alias("line"))
    of_line = lambda text, i: F.transform(
        F.when(F.size(plain(text)) > 0, plain(text)).otherwise(F.array(F.lit(""))), lambda w: token(w, i)
    )
    tokens = docs.select("uid", F.flatten(F.transform(lines, of_line)).alias("t")).where(F.size("t") >= SHINGLE)
    here = lambda i: F.struct(
        F.concat_ws(" ", *[F.col("t")[i + j]["w"] for j in range(SHINGLE)]).alias("shingle"),
        i.alias("at"),
        F.col("t")[i]["line"].alias("line"),
        F.col("t")[i + (SHINGLE - 1)]["line"].alias("last_line"),
    )
    starts = F.sequence(F.lit(0), F.size("t") - SHINGLE)
    runs = tokens.select("uid", F.explode(F.transform(starts, here)).alias("r")).select("uid", "r.*")

    known, sizes = [], []
    for template, (_, text) in enumerate(TEMPLATES):
        wanted = list(dict.fromkeys(_shingles(text)))
        sizes.append(len(wanted))
        known += [f"{s}|{template}|{k}" for k, s in enumerate(wanted)]
    # One literal: a plan with a struct for each shingle takes much of the driver's memory.
    table = docs.sparkSession.range(1).select(F.explode(F.split(F.lit(";".join(known)), ";")).alias("s"))
    table = table.select(F.split("s", "[|]").alias("s")).select(F.col("s")[0].alias("shingle"), F.col("s")[1].cast("int").alias("template"), F.col("s")[2].cast("int").alias("k"))
    in_text = Window.partitionBy("uid", "template").orderBy("at")
    k, at = F.lag("k").over(in_text), F.lag("at").over(in_text)
    new = k.isNull() | (F.col("k") <= k) | (F.col("at") - at > F.col("k") - k + SPREAD)
    found = (
        runs.join(F.broadcast(table), "shingle")
        .withColumn("new", new.cast("int"))
        .withColumn("occurrence", F.sum("new").over(in_text))
        .groupBy("uid", "template", "occurrence")
        .agg(F.min("line").alias("line"), F.max("last_line").alias("last_line"), F.count("*").alias("n"))
        .where("last_line > line")
        .where(F.col("n") / F.array(*map(F.lit, sizes))[F.col("template")] >= LEAST_SIMILARITY)
        .select("uid", "line", "last_line")
        .distinct()
    )
    # Of nested ones the outer: no earlier (or as early and longer) one reaches its end.
    before = Window.partitionBy("uid").orderBy("line", F.desc("last_line")).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("last_line").over(before), F.lit(-1))
    return found.withColumn("reach", reach).where("last_line > reach").drop("reach")


def likely(docs: DataFrame, model: LicenceModel, telling: str) -> DataFrame:
    """``uid`` and ``line`` of the lines in which ``model`` sees a licence or that have a telling word.

    All lines of all texts are scored where they are read; blank ones (and comment marks only) are no paragraphs.
    """
    lines = docs.select("uid", F.posexplode(F.split("text", "\n")).alias("line", "paragraph"))
    words = words_of(F.regexp_replace("paragraph", MARKS, " "))
    lines = lines.select("uid", "line", "paragraph", once(words).alias("words")).where(F.size("words") > 0)
    sees = F.col("licence_probability") >= LEAST_PROBABILITY
    return model.claims(lines).where(sees | F.col("paragraph").rlike(telling)).select("uid", "line")


def paragraphs_of(docs: DataFrame, model: LicenceModel, telling: str) -> DataFrame:
    """``doc_id``, ``line``, ``last_line``, ``begin``, ``end``, ``paragraph`` of the ``likely`` lines and of wrapped
    notices; ``covered`` tells whether a line is a part of one."""
    docs = stage(docs.withColumn("uid", F.monotonically_increasing_id()), "licence-texts")  # the numbers are fixed once
    chosen = stage(likely(docs, model, telling), "licence-lines")
    docs = docs.join(chosen.select("uid").distinct(), "uid", "left_semi")
    # A wrapped notice is close to a template, so it has a telling word.
    spans = wrapped(docs.where(F.col("text").rlike(telling)))
    spans = spans.groupBy("uid").agg(F.collect_list(F.struct("line", "last_line")).alias("spans"))
    spans = stage(spans, "licence-spans")
    single = lines_of(docs, chosen=chosen)
    inside = F.exists("spans", lambda s: F.col("line").between(s["line"], s["last_line"]))
    single = single.join(spans, "uid", "left").select(
        "doc_id", "line", F.col("line").alias("last_line"), "begin", "end", "paragraph", F.coalesce(inside, F.lit(False)).alias("covered")
    )
    lines = docs.join(spans, "uid").withColumn("lines", F.split("text", "\n"))
    lines = lines.select("doc_id", "text", "lines", F.explode("spans").alias("s")).select("doc_id", "text", "lines", "s.*")
    before = F.length(F.array_join(F.slice("lines", 1, F.col("line")), "\n"))
    many = lines.withColumn("begin", F.when(F.col("line") > 0, before + 1).otherwise(0)).withColumn(
        "end", F.length(F.array_join(F.slice("lines", 1, F.col("last_line") + 1), "\n"))
    )
    paragraph = F.substr(F.col("text"), F.col("begin") + 1, F.col("end") - F.col("begin"))
    many = many.select("doc_id", "line", "last_line", "begin", "end", paragraph.alias("paragraph"), F.lit(False).alias("covered"))
    return single.union(many)


def scan(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """The paragraphs of ``docs`` that are close to a template or in which the classifier sees a licence.

    ``doc_id``, ``line``, ``last_line``, ``begin``, ``end`` (characters of the text), ``family`` (of the closest
    template, ``unknown`` unless confirmed), ``claim`` (the classifier's best family),
    ``probability`` (of the claim), ``licence_probability`` (of any family), ``similarity`` (of the
    closest template; the claimed family's goes first if equal) and ``confirmed``.  Null and empty texts have no rows;
    rows that repeat an id or a text each have their own.
    """
    telling = telling_words()
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # Staged, as are the scores, so that no plan holds the templates more than once.
    found = stage(paragraphs_of(docs, model, telling), "licence-paragraphs")
    found = found.withColumn("words", words_of(F.regexp_replace("paragraph", MARKS, " ")))
    mine = lambda s: F.struct(
        s["similarity"].alias("similarity"), (s["family"] == F.col("claim")).alias("mine"), s["size"].alias("size"), s["family"].alias("family")
    )
    claimed = model.claims(found).withColumn("closest", F.array_max(F.transform(_similarities(), mine)))
    claimed = stage(claimed.drop("words", "paragraph"), "licence-scores")
    similarity = F.col("closest")["similarity"]
    confirmed = similarity >= LEAST_SIMILARITY
    return (
        claimed.withColumn("similarity", similarity)
        .withColumn("confirmed", confirmed)
        .where(F.col("confirmed") | ~F.col("covered") & (F.col("licence_probability") >= LEAST_PROBABILITY))
        .select(
            "doc_id",
            "line",
            "last_line",
            "begin",
            "end",
            F.when(F.col("confirmed"), F.col("closest")["family"]).otherwise(UNKNOWN).alias("family"),
            "claim",
            "probability",
            "licence_probability",
            "similarity",
            "confirmed",
        )
    )
