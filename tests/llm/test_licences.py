import re

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF

from tallygrid.llm import licences

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return licences.learn(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def found(docs, model):
    return {r["doc_id"]: r for r in licences.licences(docs, model).collect()}


def test_statements_in_the_tables_are_found_and_nothing_else(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = {"MIT License": "MIT", "Apache License": "Apache", "GNU General": "GPL", "CC BY-NC": "CC-BY-NC"}
    got = found(docs, model)
    for doc, text, *_ in docs.collect():
        wanted = {f for name, f in names.items() if re.search(name, text, re.I)}
        assert set(filter(None, got[doc]["families"].split(","))) == wanted, text


def test_every_template_has_a_cue():
    for line in [t for lines in licences.TEMPLATES.values() for t in lines] + list(licences.GENERAL):
        assert re.search(licences.CUES, line) or "CC BY" in line


def test_statements_inside_longer_text(docs_of, model):
    texts = ["some words. Released under the MIT License. More words", "text\nCopyright 2024 Foo, all rights reserved.\n",
             "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
             "Licensed under the Blue Oak Frobnication License, revision 7.", "she lost her driving and the law was there",
             "Released under the BSD 3-Clause License."]
    got = found(docs_of(*texts), model)
    assert [got[i]["licence"] for i in range(6)] == ["MIT", "unknown", "CC-BY-SA", "unknown", "none", "BSD"]


def test_odd_rows(odd, none, model):
    rows = licences.licences(odd, model).collect()
    assert len(rows) == odd.count() and {r["licence"] for r in rows} == {"none"}
    assert licences.licences(none, model).count() == 0


def test_model_without_documents(none, docs_of):
    model = licences.learn(none)
    assert found(docs_of("Released under the MIT License."), model)[0]["licence"] == "MIT"


def test_long_paragraph_and_single_words(spark, real_docs):
    long = "Released under the MIT License, " + "lorem ipsum dolor sit amet, " * 40_000
    rows = [(1, long), (2, "License"), (3, "License\nLicensed under CC BY 4.0.")]
    out = licences.licences(spark.createDataFrame(rows, "doc_id long, text string"), licences.learn(real_docs))
    found = {r["doc_id"]: (r["licence"], r["n_statements"], r["families"]) for r in out.collect()}
    assert found[1][1] == 1
    assert found[2] == ("unknown", 1, "unknown")
    assert found[3] == ("CC-BY", 2, "CC-BY,unknown")


WRAPPED = {
    "MIT": """Copyright (c) 2019 Foo Bar

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software.""",
    "GPL": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "BSD": """/*
 * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:
 */""",
}


def test_wrapped_licences(docs_of, model):
    ordinary = "The road went on and the others came along.\nNothing was there in the morning.\n"
    texts = [*WRAPPED.values(), *(f"{ordinary}{t}\n{ordinary}" for t in WRAPPED.values())]
    got = found(docs_of(*texts), model)
    assert [got[i]["licence"] for i in range(6)] == [*WRAPPED, *WRAPPED]


def test_short_forms(docs_of, model):
    forms = {
        "Released under GPLv3.": "GPL", "Distributed under GPL-2.0-or-later.": "GPL",
        "Available under the terms of the GNU GPL, version 2.": "GPL", "CC BY 4.0": "CC-BY",
        "Dedicated to CC0 1.0.": "public-domain", "SPDX: Apache-2.0": "Apache"}
    got = found(docs_of(*forms), model)
    assert [got[i]["licence"] for i in range(len(forms))] == list(forms.values())


def test_ordinary_sentences_with_cues(docs_of, model):
    texts = ["She asked her mother for permission and went out.", "It was not permitted to be there in the morning."]
    taught = licences.learn(docs_of(*(f"{t} It was day {i}." for i in range(40) for t in texts)))
    assert {r["licence"] for r in found(docs_of(*texts), taught).values()} == {"none"}


def plainly(text, model):
    """licence, score, n_statements and families of one text, with the learned coefficients."""
    place = HashingTF(numFeatures=licences.FEATURES).indexOf
    weights, intercept = model.regression.coefficientMatrix.toArray(), model.regression.interceptVector.toArray()

    def hits_of(unit):
        own = re.findall(licences._WORD, unit.lower())
        return own, [p for p in (f"{a} {b}" for a, b in zip(own, own[1:])) if p in licences._TAUGHT_PAIRS]

    def has(hits, lines):
        return bool(hits) and any(
            len(set(hits) & set(licences._pairs_of(x))) / max(1, len(licences._pairs_of(x))) >= licences.MATCHED for x in lines)

    def possible(unit, family):
        return re.search(licences.NAMES[family], unit) or has(hits_of(unit)[1], licences.TEMPLATES[family])

    def chances(unit):
        own, hits = hits_of(unit)
        known = [w for w in own if w in licences._TAUGHT_WORDS]
        quarters = -(-4 * (len(own) - len(known)) // len(own)) if own else 4
        grams = {*known, *(p for p in hits if p not in licences._FUNCTION_PAIRS), f"other {quarters}"}
        logits = weights[:, sorted({place(g) for g in grams})].sum(axis=1) + intercept
        e = np.exp(logits - logits.max())
        return dict(zip(model.families, e / e.sum()))

    statements = []
    for block in re.split(licences.BLANK, text or "") if text is not None else []:
        pieces = re.split(licences.PIECES, block)
        whole, n = " ".join(pieces), len(pieces)
        spans = {(i, i) for i in range(n)} | {(0, n - 1)}
        if re.search(licences._ANY_NAME, whole) or has(hits_of(whole)[1], licences._LINES):
            spans |= {(i, i + k - 1) for k in licences.WINDOWS if n > k for i in range(n - k + 1)}
        found = []
        for a, b in spans:
            unit = " ".join(pieces[a : b + 1])
            p = chances(unit)
            if 1 - p[licences.ORDINARY] < model.foreign:
                continue
            score, name = max((c, f) for f, c in p.items() if f != licences.ORDINARY)
            sure = name in licences.TEMPLATES and possible(unit, name) and score >= model.threshold
            found.append((a, b, name if sure else licences.UNKNOWN, score))

        def within(x, y):
            return y[0] <= x[0] and x[1] <= y[1] and x[:2] != y[:2]

        def meet(x, y):
            return x[0] <= y[1] and y[0] <= x[1]

        known = [x for x in found if x[2] != licences.UNKNOWN]
        least = [x for x in known if not any(within(y, x) for y in known)]
        strange = [x for x in found if x[2] == licences.UNKNOWN and not any(meet(x, y) for y in least)]
        statements += [x for x in least if not any(y[2] == x[2] and meet(x, y) and y[0] < x[0] for y in least)]
        statements += [x for x in strange if not any(within(y, x) for y in strange)]
    if not statements:
        return licences.ORDINARY, 0.0, 0, ""
    best = max((x[2] != licences.UNKNOWN, x[3], x[2]) for x in statements)
    return best[2], best[1], len(statements), ",".join(sorted({x[2] for x in statements}))


def test_every_column_against_plain_scoring(spark, docs_of, model):
    """Documents of a table, those with licence wording first, and made-up ones."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    texts = sorted((r["text"] for r in docs if r["text"]), key=lambda t: -len(re.findall(licences.CUES, t)))[:60]
    texts += [*WRAPPED.values(), "\n\n".join(WRAPPED.values()), "Copyright.\nRights are reserved. See the license file.", None, "",
              "MIT\n\nGPLv3 or CC BY 4.0.\n\nIt may be used.\nReleased under the MIT License.\nReleased under the MIT License."]
    got = found(docs_of(*texts), model)
    for i, text in enumerate(texts):
        licence, score, n, families = plainly(text, model)
        r = got[i]
        assert (r["licence"], r["n_statements"], r["families"]) == (licence, n, families), text
        assert r["score"] == pytest.approx(score, abs=1e-9)


def test_rows_without_an_id_have_results_of_their_own(docs_of, model):
    texts = ["Released under the MIT License.", "the rain fell on the hills", "Licensed under the Apache License, Version 2.0.",
             "Released under the MIT License."]
    rows = licences.licences(docs_of(*[(None, t, "en", "s") for t in texts]), model).collect()
    assert sorted((r["licence"], r["n_statements"], r["families"]) for r in rows) == [
        ("Apache", 1, "Apache"), ("MIT", 1, "MIT"), ("MIT", 1, "MIT"), ("none", 0, "")]


def test_ordinary_text_is_learned_from_every_document(spark, docs_of):
    """A sentence that looks like a licence, in documents that a sample of 300 by a hash of the text leaves out."""
    sentence = "The author has the rights to the software and to the source code."
    real = spark.read.parquet(f"{FOLDER}/documents.parquet")
    with_it = docs_of(*((10_000_000 + i, f"{sentence} It was day {i}.", "en", "s") for i in range(400))).filter(
        "pmod(xxhash64(text), 1000000) >= 400000").select(*real.columns)
    assert with_it.count() > 200
    assert found(docs_of(sentence), licences.learn(real))[0]["licence"] == "unknown"
    assert found(docs_of(sentence), licences.learn(real.unionByName(with_it)))[0]["licence"] == "none"


def test_training_counts_every_ordinary_unit(spark, docs_of):
    """Against the units of all documents, cut and counted one by one."""
    real = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()
    texts = [r["text"] for r in real] + [
        "An author.\nAn author.\n\nIt was there. The law is the law", "", None, "permission was given", *WRAPPED.values(),
        "no telling word here.\nNor here"] + ["An author of an example.\n\n\nand more"] * 40
    wanted = {}
    for text in texts:
        for block in re.split(licences.BLANK, text) if text is not None else []:
            pieces = re.split(licences.PIECES, block)
            for unit in pieces + [" ".join(pieces)] * (len(pieces) > 1):
                own = re.findall(licences._WORD, unit.lower())
                hits = [p for p in (f"{a} {b}" for a, b in zip(own, own[1:])) if p in licences._TAUGHT_PAIRS]
                known = [w for w in own if w in licences._TAUGHT_WORDS]
                cued = re.search(licences.CUES, unit)

                def has(lines):
                    return any(len(set(hits) & set(licences._pairs_of(x))) / len(licences._pairs_of(x)) >= licences.MATCHED
                               for x in lines if licences._pairs_of(x))

                telling = set(own) & set(licences._TELLING)
                if telling and (re.search(licences._ANY_NAME, unit) or has(licences._LINES) or cued and has(licences.GENERAL)):
                    continue
                quarters = -(-4 * (len(own) - len(known)) // len(own)) if own else 4
                grams = {*known, *(p for p in hits if p not in licences._FUNCTION_PAIRS), f"other {quarters}"}
                key = tuple(sorted(grams)), licences.CUED if telling and cued else 1
                wanted[key] = wanted.get(key, 0) + 1
    rows = len(texts)
    got = {}
    for r in licences._ordinary(licences.units(docs_of(*texts)), rows).collect():
        got[tuple(r["grams"])] = got.get(tuple(r["grams"]), 0) + r["times"]
    weights = {}
    for (grams, share), n in wanted.items():
        weights[grams] = weights.get(grams, 0) + n * min(rows, licences.WEIGHS * share)
    assert rows > 3 * licences.WEIGHS and got == weights
