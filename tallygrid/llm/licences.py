"""Find licence statements in text and the licence family of each.

Method: a trained paragraph classifier. Word n-grams of a paragraph go into a sparse
logistic regression over licence families, general licence wording and ordinary text, which
every text of the table stands for. Its thresholds are calibrated on paragraphs kept out of
training; what no class reaches is an unknown licence. A family counts only if the paragraph also matches one of the family's
templates or has the family's name. Paragraphs end at blank lines; each is scored whole
with its lines joined, by line and sentence, and, where a family is possible, in windows
of neighbouring lines and sentences.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.llm.common import stored, with_facts

# How licences name themselves.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction.",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the Apache License, Version 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, without warranties or conditions of any kind.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation.",
        "Distributed under the GNU GPL, without any warranty.",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met.",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "public-domain": (
        "Dedicated to the public domain under the CC0 1.0 license.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
}
#: Short names, as they stand in sentences and SPDX lines.
SHORT: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT", "the MIT License", "MIT License"),
    "Apache": ("Apache-2.0", "Apache 2.0", "the Apache License 2.0"),
    "GPL": ("GPL", "GPLv2", "GPLv3", "GPLv2+", "GPLv3+", "GPL v2", "GPL v3", "GPL-2.0", "GPL-3.0", "GPL-2.0-only",
            "GPL-3.0-only", "GPL-2.0-or-later", "GPL-3.0-or-later", "the GNU GPL, version 2", "the GNU GPL, version 3"),
    "BSD": ("BSD-2-Clause", "BSD-3-Clause", "BSD 2-Clause", "BSD 3-Clause", "the BSD License"),
    "MPL": ("MPL-2.0", "MPL 2.0", "the MPL, version 2.0"),
    "CC-BY": ("CC BY 4.0", "CC-BY-4.0", "CC BY 3.0", "CC BY", "CC-BY"),
    "CC-BY-SA": ("CC BY-SA 4.0", "CC-BY-SA-4.0", "CC BY-SA 3.0", "CC BY-SA", "CC-BY-SA"),
    "CC-BY-NC": ("CC BY-NC 4.0", "CC-BY-NC-4.0", "CC BY-NC 3.0", "CC BY-NC", "CC-BY-NC"),
    "public-domain": ("CC0 1.0", "CC0-1.0", "CC0", "the public domain"),
}
LEADS = ("", "Released under ", "Distributed under ", "Available under ", "Licensed under ", "Dedicated to ",
         "Available under the terms of ", "SPDX: ", "SPDX-License-Identifier: ", "License: ")
_UNDER = r"(?:(?:under|terms of|spdx:|identifier:|licen[cs]e:) (?:the )?)"
#: A family's name in text whose lines are joined; names that mean other things need their surroundings.
NAMES: dict[str, str] = {
    "MIT": rf"(?i)\bmit licen[cs]e|{_UNDER}mit\b",
    "Apache": r"(?i)\bapache(?: software)?(?:,? licen[cs]e)?[ ,-]*(?:version |v)?2(?:\.0)?\b|\bapache licen[cs]e",
    "GPL": r"(?i)(?<![a-z-])gpl(?:[ -]?v?[123](?:\.0)?)?(?![a-z0-9])|\bgnu general public licen[cs]e",
    "BSD": r"(?i)\bbsd[ -][234][ -]clause|\b[234][ -]clause bsd|\bbsd licen[cs]e",
    "MPL": r"(?i)\bmpl[ -]?v?[12]\.[01]\b|\bmozilla public licen[cs]e|\bthe mpl\b",
    "CC-BY": r"(?i)\bcc[ -]by\b(?![ -](?:sa|nc|nd))",
    "CC-BY-SA": r"(?i)\bcc[ -]by[ -]sa\b",
    "CC-BY-NC": r"(?i)\bcc[ -]by[ -]nc\b(?![ -](?:sa|nd))",
    "public-domain": r"(?i)\bcc[ -]?(?:0|zero)\b|\b(?:dedicated to|released into|placed in) the public domain\b",
}
UNKNOWN = "unknown"
ORDINARY = "none"
#: Licence wording that names no family.
GENERAL = (
    "Copyright, all rights reserved.",
    "Copyright 2021 by the author, all rights reserved.",
    "Licensed under the Example Public License, revision 2.",
    "Released under the Sample Software License 1.0.",
    "License",
    "Copyright",
    "All rights reserved by the copyright holder.",
    "Licensed under the terms of a proprietary license agreement.",
    "No part of this document may be copied without permission of the copyright holder.",
    "Released under a custom license, see the license file.",
    "Used with permission; the license terms apply to every copy.",
    "This text is provided under its own license without warranty.",
)
#: What pages end with, of whatever licence.
FOOTERS = ("All rights reserved.",)
#: Ordinary paragraphs with one of these are rare; each counts ``CUED`` times in training.
CUES = r"(?i)licen[cs]|copyright|warrant|redistribut|permission|permitted|public domain|creative commons"

FEATURES = 1 << 14
WEIGHS = 300  # beside what is taught, the ordinary text of a table counts as so many documents at most
CUED = 10
TRAINING_TASKS = 8  # at least; each pass over the training rows is a job
TRAINING_ROWS = 100_000  # of a task, about: counted rows, each with a set of grams of its own
STEPS = 10_000  # thresholds are whole steps, so that a share of any number of scores is found by counting
MATCHED = 0.6  # of a template's word pairs that a paragraph must have
LEAST = 0.5
MOST = 0.9
_MARKS = r"[ \t\r#*/;>|%-]*"  # what a line may begin with in comments and quotes
BLANK = rf"\n(?:{_MARKS}\n)+"
PIECES = r"\n+|(?<=[.;!?])[ \t]+(?=[A-Z])"
WINDOWS = (2, 3, 4, 6, 8, 12)  # pieces in a row; the whole paragraph is tried too


_WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), 0)


def _words_of(line: str) -> list[str]:
    return re.findall(_WORD, line.lower())


def _pairs_of(line: str) -> list[str]:
    own = _words_of(line)
    return sorted({f"{a} {b}" for a, b in zip(own, own[1:])})


_LINES = tuple(line for lines in TEMPLATES.values() for line in lines)
_NAMED = tuple(f"{lead}{name}." for names in SHORT.values() for name in names for lead in LEADS)
_PLACEHOLDERS = {"example", "sample", "2020", "2021"}
#: Words of any text ("mit" of German): by themselves, and two in a row, they are no sign of a licence.
_FUNCTION = set("a all and any are as at be been by except following for from has in is it its may mit must no not of "
                "on or own part see than that the this to under use used with without you your work works".split())
_TAUGHT_WORDS = sorted(
    {w for line in (*_LINES, *GENERAL, *_NAMED) for w in _words_of(line)} - _PLACEHOLDERS - _FUNCTION)
#: Words that may name a licence by themselves; the others, alone, are ordinary.
_NAMING = {w for names in SHORT.values() for name in names for w in _words_of(name)} - {"the", "version"} | {
    w for w in _TAUGHT_WORDS if re.search(r"licen[cs]|copyright|warrant|redistribut", w)}
_TAUGHT_PAIRS = sorted({p for line in (*_LINES, *GENERAL, *_NAMED) for p in _pairs_of(line)})
_SEEN = sorted({w for line in (*_LINES, *GENERAL, *_NAMED) for w in _words_of(line)})
#: A unit with none of these has no feature but that all of its words are others.
_TELLING = sorted(set(_SEEN) - _FUNCTION)
_FUNCTION_PAIRS = [p for p in _TAUGHT_PAIRS if set(p.split(" ")) <= _FUNCTION]


def _tokens(text: Column) -> Column:
    """The words in order, null for those that stand in nothing that is taught."""
    return F.transform(words(text), lambda w: F.when(w.isin(_SEEN), w))


def pairs(own: Column) -> Column:
    """Each two words in a row, joined by a space, null beside a null; none of a single word."""
    # No lambda looks into ``own``: where Spark inlines it, it would be made again for each word.
    n = F.greatest(F.size(own) - 1, F.lit(0))
    return F.zip_with(F.slice(own, F.lit(1), n), F.slice(own, F.lit(2), n), lambda a, b: F.when(
        a.isNotNull() & b.isNotNull(), F.concat_ws(" ", a, b)))


def _others(quarters: Column) -> Column:
    return F.concat(F.lit("other "), quarters.cast("string"))


def _with_grams(df: DataFrame) -> DataFrame:
    """``hits`` and ``grams`` of ``tokens``. Grams are the words and word pairs that were taught, and
    which share of the words was not, so that ordinary words, of whatever language, cannot fall on
    those of a licence."""
    known = F.filter("tokens", lambda w: w.isin(_TAUGHT_WORDS))
    foreign = F.ceil(4 * (F.size("tokens") - F.size("own")) / F.nullif(F.size("tokens"), F.lit(0)))
    made = _made_once(df.withColumn("own", known).withColumn("hits", _hits(F.col("tokens"))))
    return made.withColumn("grams", F.array_sort(F.array_distinct(F.concat("own", F.filter(
        "hits", lambda p: ~p.isin(_FUNCTION_PAIRS)), F.array(_others(F.coalesce(foreign, F.lit(4)))))))).drop("own", "tokens")


def _with_features(df: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(df)


def _taught(spark: SparkSession) -> DataFrame:
    """Templates, general wording, their parts of five words or more, and short names."""
    whole = [(f, t) for f, lines in TEMPLATES.items() for t in lines] + [(UNKNOWN, t) for t in GENERAL]
    short = [(f, f"{lead}{name}.") for f, names in SHORT.items() for name in names for lead in LEADS
             if lead or f not in ("MIT", "public-domain")]
    own = F.split("paragraph", " ")
    starts = F.sequence(F.lit(1), F.greatest(F.size(own) - 4, F.lit(1)))
    parts = F.flatten(F.transform(starts, lambda i: F.transform(
        F.array(F.lit(5), F.lit(8), F.lit(60)), lambda n: F.array_join(F.slice(own, i, n), " "))))
    df = spark.createDataFrame(whole, "family string, paragraph string")
    named = spark.createDataFrame(short, "family string, paragraph string")
    leads = F.array(*(F.lit(x) for x in ("", "Copyright 2020 the authors. ", "Notice: ")))
    return df.unionByName(df.select("family", F.explode(parts).alias("paragraph"))).unionByName(named).select(
        "family", F.explode(F.transform(leads, lambda x: F.concat(x, "paragraph"))).alias("paragraph"))


def _tells(tokens: Column) -> Column:
    return F.exists(tokens, lambda w: w.isNotNull() & w.isin(_TELLING))  # false, not null, beside a null


def _alone() -> Column:
    """What tells rows without an id apart: a hash of the text."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text"))


def _blocks(docs: DataFrame) -> DataFrame:
    """doc_id, alone, place, and pieces (lines and sentences) of each paragraph, with the tokens of
    each piece: no word goes over its end, so those of a window are those of its pieces."""
    # The outer form, here and for units: for the plain one Spark adds a filter by the size of
    # what is taken apart, moves it down, and so makes all of it once more.
    blocks = _made_once(docs.filter(F.col("text").isNotNull()).select(
        "doc_id", _alone().alias("alone"), F.posexplode_outer(F.split("text", BLANK)).alias("place", "block")).select(
        "doc_id", "alone", "place", F.split("block", PIECES).alias("pieces")))
    return _made_once(blocks.withColumn("tokens", F.transform("pieces", _tokens)).withColumn(
        "paragraph", F.array_join("pieces", " ")))


def _array(names: list[str]) -> Column:
    return F.array(*(F.lit(x) for x in names))  # folded once; made with pairs() it would be made again for each row


def _has(lines: tuple[str, ...]) -> Column:
    """Whether ``hits`` has enough word pairs of one of the lines."""
    found = F.lit(False)
    for own in map(_pairs_of, lines):
        found = found | ((F.size("hits") / len(own) >= MATCHED) & (
            F.size(F.array_intersect(F.col("hits"), _array(own))) / len(own) >= MATCHED))
    return (F.size("hits") > 0) & found


def _possible(family: str) -> Column:
    """Whether ``hits`` and ``naming`` have a template or the name of the family."""
    return F.coalesce(F.col("naming").rlike(NAMES[family]), F.lit(False)) | _has(TEMPLATES[family])


def _hits(own: Column) -> Column:
    return F.filter(pairs(own), lambda p: p.isin(_TAUGHT_PAIRS))


_ANY_NAME = "(?i)" + "|".join(name.removeprefix("(?i)") for name in NAMES.values())
#: Text that ``_ANY_NAME`` finds something in has one of these, in lower case.
_IN_NAMES = ("mit lic", "the mit", "under mit", "terms of mit", "spdx: mit", "identifier: mit", "license: mit", "licence: mit",
             "apache", "gpl", "gnu general", "bsd", "mpl", "mozilla", "cc by", "cc-by", "cc0", "cc 0", "cc-0", "cczero",
             "cc zero", "cc-zero", "the public domain")


#: Text that ``CUES`` finds something in has one of these, in lower case.
_IN_CUES = ("licens", "licenc", "copyright", "warrant", "redistribut", "permission", "permitted", "public domain",
            "creative commons")


def _any_of(text: str, parts: tuple[str, ...]) -> Column:
    return F.exists(_array(parts), lambda x: F.contains(F.col(text), x))


def _named() -> Column:
    """Whether ``paragraph`` has any family's name. The expression is slow, so it only looks at
    text in which a part of a name stands: ``low`` is the text in lower case."""
    return _any_of("low", _IN_NAMES) & F.col("paragraph").rlike(_ANY_NAME)


def _made_once(df: DataFrame) -> DataFrame:
    """A barrier: Spark moves filters down past what they are made of, and makes it again there,
    but not past this."""
    return df.select(F.explode_outer(F.array(F.struct(*df.columns))).alias("row")).select("row.*")


def units(docs: DataFrame, telling: bool = True) -> DataFrame:
    """doc_id, alone, place, block (a hash), first and last piece, hits, grams, naming (the text, if a
    family's name stands in it) and share of each piece, each whole paragraph, and each window of a
    paragraph in which a family is possible. ``share`` is how often a unit counts as ordinary text in
    training: 0 for windows, for what matches a template or general wording, or names a family.
    ``telling``: only units with a telling word; how many pieces and whole paragraphs of a block have
    none is ``n`` in a row of its own, without a place, as all of those have the same grams.

    A window has no pair of words that its paragraph has not, so none is left out that a
    template or a name could confirm.
    """
    blocks = _blocks(docs).withColumn("all", F.flatten("tokens"))
    blocks = _made_once(blocks.withColumn("tells", _tells(F.col("all"))).withColumn("low", F.lower("paragraph")))
    blocks = _made_once(blocks.withColumn("hits", F.when(F.col("tells"), _hits(F.col("all")))))
    possible = F.col("tells") & (_named() | _has(_LINES))
    blocks = _made_once(blocks.withColumn("possible", possible).withColumn("block", F.xxhash64("paragraph")).drop("low"))
    n = F.size("pieces")

    def unit(first: Column, last: Column, paragraph: Column, tokens: Column, count: Column = F.lit(1), whole: bool = True) -> Column:
        return F.struct(
            first.cast("int").alias("first"), last.cast("int").alias("last"), paragraph.alias("paragraph"),
            tokens.alias("tokens"), count.cast("long").alias("n"), F.lit(whole).alias("whole"))

    none = F.array().cast("array<struct<first:int,last:int,paragraph:string,tokens:array<string>,n:long,whole:boolean>>")
    singles = F.transform("pieces", lambda x, i: unit(i, i, x, F.get("tokens", i)))
    entire = F.when(n > 1, F.array(unit(F.lit(0), n - 1, F.col("paragraph"), F.col("all")))).otherwise(none)

    def window(size: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))
        return F.when((n > size) & F.col("possible"), F.transform(starts, lambda i: unit(
            i, i + (size - 1), F.array_join(F.slice("pieces", i + 1, F.lit(size)), " "),
            F.flatten(F.slice("tokens", i + 1, F.lit(size))), whole=False))).otherwise(none)

    made = F.concat(singles, entire, *(window(size) for size in WINDOWS))
    if telling:
        # Of a paragraph without a telling word there is no unit but the count.
        plain = F.size(F.filter("tokens", lambda t: ~_tells(t))) + F.when((n > 1) & ~F.col("tells"), 1).otherwise(0)
        empty = F.lit(None).cast("int")
        rest = F.array(unit(empty, empty, F.lit(None).cast("string"), F.array().cast("array<string>"), plain))
        made = F.when(F.col("tells"), F.concat(F.filter(made, lambda u: _tells(u["tokens"])), rest)).otherwise(rest)
    rows = blocks.select("doc_id", "alone", "place", "block", F.explode_outer(made).alias("unit")).select(
        "doc_id", "alone", "place", "block", "unit.*")
    rows = _made_once(_with_grams(rows.withColumn("low", F.lower("paragraph"))))
    cued = _any_of("low", _IN_CUES)
    rows = _made_once(rows.withColumn("named", F.coalesce(_named(), F.lit(False))).withColumn(
        "cued", F.coalesce(cued, F.lit(False))).drop("low"))
    other = F.col("named") | _has(_LINES) | (F.col("cued") & _has(tuple(x for x in GENERAL if _pairs_of(x))))
    return rows.select(
        "doc_id", "alone", "place", "block", "first", "last", "hits", "grams", "n",
        F.when(F.col("named"), F.col("paragraph")).alias("naming"),
        F.when(~F.col("whole") | other, 0).when(F.col("cued"), CUED).otherwise(1).alias("share"))


def _ordinary(found: DataFrame, rows: int) -> DataFrame:
    """family, grams, fold and times of the ordinary units of all of ``rows`` documents, equal ones
    counted. A paragraph's units are in one fold. The table counts as ``WEIGHS`` documents, cued
    units as ``CUED`` times as many; ``times`` are in units of one ``rows``-th."""
    counted = found.filter("share > 0").groupBy("grams", F.pmod("block", F.lit(5)).alias("fold"), "share").agg(
        F.sum("n").alias("n"))
    weight = F.least(F.lit(rows).cast("long"), WEIGHS * F.col("share"))
    return counted.filter("n > 0").select(F.lit(ORDINARY).alias("family"), "grams", "fold", (F.col("n") * weight).alias("times"))


@dataclass
class Model:
    """``threshold`` is the least chance of a family, ``foreign`` that of anything but ordinary,
    ``plain`` what that is for text without a taught word."""

    families: list[str]
    regression: LogisticRegressionModel
    threshold: float
    foreign: float
    plain: float


def learn(docs: DataFrame, found: DataFrame | None = None) -> Model:
    """Train on templates, general wording, short names, and the ordinary paragraphs of every
    document, of which equal ones are counted. ``found``: units(docs), if they were made before."""
    spark = docs.sparkSession
    alone = [(ORDINARY, x) for x in (*FOOTERS, *(w for w in _TAUGHT_WORDS if w not in _NAMING)) for _ in range(20)]
    n = docs.count()
    taught = _with_grams(_taught(spark).unionByName(spark.createDataFrame(alone, "family string, paragraph string")).withColumn(
        "tokens", _tokens(F.col("paragraph")))).select(
        "family", "grams", F.pmod(F.xxhash64("paragraph"), F.lit(5)).alias("fold"), F.lit(max(n, 1)).cast("long").alias("times"))
    rows = taught.unionByName(_ordinary(units(docs) if found is None else found, n))
    families = sorted({*TEMPLATES, UNKNOWN, ORDINARY})
    place = F.array_position(F.array(*(F.lit(f) for f in families)), F.col("family")) - 1
    rows = stored(_with_features(rows).select(
        "family", "features", place.cast("double").alias("label"), "fold", "times"), "licence-training")
    # General wording and ordinary text are one answer each and many rows; weight by label.
    sizes = {r["label"]: (r["times"], r["n"]) for r in rows.groupBy("label").agg(
        F.sum("times").alias("times"), F.count("*").alias("n")).collect()}
    rows = rows.coalesce(max(TRAINING_TASKS, sum(n for _, n in sizes.values()) // TRAINING_ROWS))
    weight = F.lit(1.0)
    for label, (times, _) in sizes.items():
        weight = F.when(F.col("label") == label, F.col("times") * (100.0 / times)).otherwise(weight)
    regression = LogisticRegression(
        family="multinomial", regParam=0.002, maxIter=40, weightCol="weight", featuresCol="features")
    fitted = regression.fit(rows.filter("fold <> 0").withColumn("weight", weight))
    chances = vector_to_array("probability")
    among = [i for i, f in enumerate(families) if f in TEMPLATES]
    best = F.greatest(*(F.element_at(chances, i + 1) for i in among))
    foreign = fitted.transform(rows.filter("fold = 0").filter(~F.col("family").isin(*TEMPLATES)))
    other = F.when(F.col("family") == ORDINARY, 1 - F.element_at(chances, families.index(ORDINARY) + 1))
    calibrated, clean = foreign.select(*(F.percentile(F.ceil(x * STEPS), F.lit(share), F.col("times")) / STEPS for x, share in (
        (best, 0.99), (other, 0.999)))).first()
    others = HashingTF(numFeatures=FEATURES).indexOf("other 4")
    plain = 1 - fitted.predictProbability(Vectors.sparse(FEATURES, {others: 1.0}))[families.index(ORDINARY)]
    return Model(families, fitted, max(LEAST, min(MOST, calibrated or 0.0)), max(LEAST, min(MOST, clean or 0.0)),
                 float(plain))


def _within(x: Column, y: Column) -> Column:
    """Whether ``x`` is a part of ``y`` and not all of it."""
    return (y["first"] <= x["first"]) & (x["last"] <= y["last"]) & (
        (x["first"] != y["first"]) | (x["last"] != y["last"]))


def _meet(x: Column, y: Column) -> Column:
    return (x["first"] <= y["last"]) & (y["first"] <= x["last"])


def statements(docs: DataFrame, model: Model, made: DataFrame | None = None) -> DataFrame:
    """doc_id, alone, family, score and n of the licence statements found, n of them equal.

    Every piece and every paragraph of every text is scored. Those without a taught word have
    one and the same score, which is known beforehand; where it says ordinary text, as it
    should, they are not scored one by one. A statement is the shortest window that a family
    is found in; unknown licences are those beside them.
    """
    telling = model.plain < model.foreign
    if made is None or not telling:
        made = units(docs, telling)
    scored = model.regression.transform(_with_features(made.filter("first is not null")))
    chances = F.col("chances")
    others = [F.struct(F.element_at(chances, i + 1).alias("chance"), F.lit(f).alias("name"))
              for i, f in enumerate(model.families) if f != ORDINARY]
    judged = _made_once(scored.select("doc_id", "alone", "place", "block", "first", "last", "hits", "naming",
                                      vector_to_array("probability").alias("chances")))
    marked = judged.filter(
        1 - F.element_at(chances, model.families.index(ORDINARY) + 1) >= model.foreign)
    marked = marked.withColumn("best", F.greatest(*others)).select(
        "doc_id", "alone", "place", "block", "first", "last", "hits", "naming",
        F.col("best.name").alias("named"), F.col("best.chance").alias("score"))
    confirmed = F.lit(False)
    for family in TEMPLATES:
        confirmed = confirmed | ((F.col("named") == family) & _possible(family))
    found = marked.select("doc_id", "alone", "place", "block", "first", "last", "score", F.when(
        confirmed & (F.col("score") >= model.threshold), F.col("named")).otherwise(UNKNOWN).alias("family"))
    # Equal rows are counted first: a text that many rows of one id have makes one list. Rows
    # without an id that have one text are rows of their own with one result.
    keys = ("doc_id", "alone", "place", "block")
    counted = found.groupBy(*keys, "first", "last", "family", "score").agg(
        F.when(F.col("alone").isNull(), F.count("*")).otherwise(1).alias("n"))
    lists = counted.groupBy(*keys).agg(F.collect_list(F.struct("first", "last", "family", "score", "n")).alias("all"))
    known = F.filter("all", lambda x: x["family"] != UNKNOWN)
    least = F.filter("known", lambda x: ~F.exists("known", lambda y: _within(y, x)))
    fresh = F.filter("least", lambda x: ~F.exists("least", lambda y: (
        (y["family"] == x["family"]) & _meet(x, y) & (y["first"] < x["first"]))))
    strange = F.filter("all", lambda x: (x["family"] == UNKNOWN) & ~F.exists("least", lambda y: _meet(x, y)))
    alone = F.filter("strange", lambda x: ~F.exists("strange", lambda y: _within(y, x)))
    lists = lists.withColumn("known", known).withColumn("least", least).withColumn("strange", strange)
    return lists.select("doc_id", "alone", F.explode(F.concat(fresh, alone)).alias("x")).select(
        "doc_id", "alone", "x.family", "x.score", "x.n")


def licences(docs: DataFrame, model: Model, made: DataFrame | None = None) -> DataFrame:
    """doc_id, licence, score, n_statements and families for every row of ``docs``.

    ``families`` are the distinct families found, in order and joined by commas;
    ``licence`` is that of the most certain statement, a known family before ``unknown``,
    and ``none`` (score 0) where no statement is found, as in null and empty texts. Rows
    that repeat an id share the result of all of them; rows without an id each have their
    own. An empty table gives an empty result. ``made``: units(docs), if they were made before.
    """
    best = F.max(F.struct((F.col("family") != UNKNOWN).alias("known"), "score", "family"))
    found = statements(docs, model, made).groupBy("doc_id", "alone").agg(
        best.alias("best"), F.sum("n").alias("n"), F.array_sort(F.collect_set("family")).alias("all"))
    return with_facts(docs.select("doc_id", _alone().alias("alone")), found, ["doc_id", "alone"]).select(
        "doc_id", F.coalesce("best.family", F.lit(ORDINARY)).alias("licence"),
        F.coalesce("best.score", F.lit(0.0)).alias("score"),
        F.coalesce("n", F.lit(0)).alias("n_statements"),
        F.coalesce(F.array_join("all", ","), F.lit("")).alias("families"))
