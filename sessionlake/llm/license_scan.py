"""Licence scans by a trained paragraph classifier.

Word windows of a text are scored by a sparse logistic regression over
hashed word n-grams (one to three words) with one class per licence family and
an ``unknown`` class. The classifier comes first: windows of ``SCALES`` words,
each scale at steps of half its length, go on where ``unknown`` is less likely
than ``MAX_UNKNOWN``. Inside what goes on, template comparison looks for the
exact notice: the share of a template's word pairs that a span holds must reach
``MIN_MATCH``, and the classifier must give the span that template's family with
``MIN_PROBABILITY`` or more.

It is trained here: families from the template texts below and their word-window
variants; ``unknown`` from a bounded sample of corpus lines (the first
``LINE_WORDS`` words of ``CORPUS_LINES`` lines) without a rare licence word, from
decoys in which licence words stand in other order, from notices of licences that
are no family here (``FOREIGN``), and from templates whose licence name is replaced
by another one. Some of these foreign notices and names are left out of the fit;
they and held-out variants fit the temperature of the softmax.

Spans begin and end with a pair of the template, so how long the line is, or how a
notice is wrapped, does not matter. All scoring is DataFrame functions over small,
bounded tables of weights and template pairs.
Notices are numbered by the line of their first word (``paragraph``).

Defined results: a null or empty text has no paragraph and no licence; rows are
scanned one by one, so repeated rows, ties and null ids do not matter; an empty
table gives no rows and trains without corpus lines; other columns are not read.
"""

from __future__ import annotations

import collections
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import cut

#: Public licence notices, by family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS"],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License. See LICENSE in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program."],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this program."],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program."],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
        "which accompanies this distribution, and is available at",
        "Licensed under the Eclipse Public License, Version 2.0."],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "cc-by-nc-sa": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "cc-by-nc-nd": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "proprietary": [
        "All rights reserved.",
        "Copyright, all rights reserved. No part of this work may be reproduced without written permission.",
        "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited."],
}
#: SPDX names by family; the first ones also with -only and -or-later.
SPDX_GNU = {"gpl": ["GPL-2.0", "GPL-3.0"], "lgpl": ["LGPL-2.0", "LGPL-2.1", "LGPL-3.0"], "agpl": ["AGPL-3.0"]}
SPDX = {"apache-2.0": ["Apache-2.0"], "mit": ["MIT"], "bsd": ["BSD-2-Clause", "BSD-3-Clause"], "mpl": ["MPL-2.0"], "isc": ["ISC"],
        "epl": ["EPL-1.0", "EPL-2.0"]}
for _family, _names in SPDX_GNU.items():
    TEMPLATES[_family] += [f"SPDX-License-Identifier: {n}{end}" for n in _names for end in ("", "-only", "-or-later")]
for _family, _names in SPDX.items():
    TEMPLATES[_family] += [f"SPDX-License-Identifier: {n}" for n in _names]
for _family in [f for f in TEMPLATES if f.startswith("cc-")]:
    TEMPLATES[_family] += [f"SPDX-License-Identifier: {_family.upper()}-{v}" for v in ("3.0", "4.0")]
#: What names the licence in a family's templates.
NAMES = {"apache-2.0": r"Apache", "mit": r"MIT", "gpl": r"GNU General|GPL", "lgpl": r"GNU Lesser General|LGPL", "agpl": r"GNU Affero General|AGPL",
         "bsd": r"BSD", "mpl": r"Mozilla|MPL", "isc": r"ISC", "epl": r"Eclipse|EPL"}
#: Names of other licences, and notices of licences that are no family here.
OTHER_NAMES = ["Academic Free", "Educational Community", "Open Software", "Artistic", "Boost Software", "European Union Public", "Python Software Foundation",
               "Microsoft Public", "Common Development and Distribution", "PostgreSQL", "Zope Public", "IBM Public", "Common Public", "Sun Industry",
               "Mulan", "Elastic", "Business Source", "Server Side Public", "Open Font", "Universal Permissive", "Sleepycat", "Ruby"]
FOREIGN = [
    "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL",
    "The contents of this file are subject to the terms of the Common Development and Distribution License (the License). You may not use "
    "this file except in compliance with the License.",
    "This library is free software; you can redistribute it and/or modify it under the same terms as Perl itself, under the Artistic License 2.0",
    "This software is provided 'as-is', without any express or implied warranty. Permission is granted to anyone to use this software for any purpose",
    "This is free and unencumbered software released into the public domain.",
    "Distributed under the Boost Software License, Version 1.0.",
    "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    "This source is subject to the Microsoft Public License.",
    "This software is governed by the CeCILL license under French law and abiding by the rules of distribution of free software.",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "Licensed under the Educational Community License, Version 2.0; you may not use this file except in compliance with the License.",
    "Licensed under the Academic Free License version 3.0",
    "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal.",
    "This database is made available under the Open Database License.",
    "Use of this software is governed by the Business Source License included in the LICENSE file.",
    "Licensed under the Elastic License 2.0; you may not use this file except in compliance with the Elastic License 2.0.",
    "Subject to the terms and conditions of this Agreement, the licensor hereby grants a limited licence to use the software",
    "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written "
    "agreement is hereby granted, provided that the above copyright notice appear in all copies."]
FAMILIES = [*sorted(TEMPLATES), "unknown"]
UNKNOWN = len(FAMILIES) - 1
#: Corpus lines of the unknown class, and variants of each template.
CORPUS_LINES = 2000
LINE_WORDS = 64
VARIANTS = 60
#: Every fourth foreign notice or name is left out of the fit and calibrates it.
LEFT_OUT = 4
#: Words of the windows that the classifier judges first, smallest step, and the
#: probability of ``unknown`` from which a window is dropped.
SCALES = (8, 16, 32, 64, 128)
STEP = 4
MAX_UNKNOWN = 0.9
BUCKETS = 1 << 14
MAX_GRAM = 3
MIN_PROBABILITY = 0.6
MIN_MATCH = 0.6
#: Of a template's length: how far its pairs may be off their places; further words a window may hold.
SHIFT = 0.25
LOOSE = 16

#: A word: letters, digits, and joined versions such as by-nc and 2.0.
TOKEN = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def grams(words: Column) -> Column:
    """Distinct hashed n-grams of one to MAX_GRAM words."""
    def of(n: int) -> Column:
        return F.when(F.size(words) >= n, F.transform(
            F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))) \
            .otherwise(F.array().cast("array<bigint>"))

    made = [of(n) for n in range(1, MAX_GRAM + 1)]
    return F.array_distinct(F.transform(F.concat(*made), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")))


def template_words() -> list[str]:
    return sorted({w for ts in TEMPLATES.values() for t in ts for w in re.findall(r"[\w]+(?:[.-][\w]+)*", t.lower())})


def examples(seed: int = 7) -> list[tuple[str, int, bool]]:
    """(text, family, left out of the fit): template texts, windows of their words
    between other words, decoys, and foreign notices and names."""
    rng = random.Random(seed)
    out, pool = [], [w for ts in TEMPLATES.values() for t in ts for w in t.split()]
    filler = ["project", "code", "file", "see", "notice", "work", "the", "of", "and", "by", "author", "name", "page", "book", "line"]

    def variant(t: str) -> str:
        w = t.split()
        front = rng.choices(filler, k=rng.randint(0, 3))
        back = rng.choices(filler, k=rng.randint(0, 3))
        a, b = (0, len(w)) if len(w) < 8 or rng.random() < 0.5 else (rng.randint(0, len(w) // 5), len(w) - rng.randint(0, len(w) // 5))
        return " ".join([*front, *w[a:b], *back])

    for k, family in enumerate(FAMILIES[:-1]):
        for t in TEMPLATES[family]:
            n = VARIANTS // 4 if t.startswith("SPDX") else VARIANTS
            out += [(variant(t), k, i % 5 == 0) for i in range(n)]
            if re.search(NAMES.get(family, "(?!)"), t):
                for i in range(VARIANTS):
                    at = rng.randrange(len(OTHER_NAMES))
                    out.append((variant(re.sub(NAMES[family], OTHER_NAMES[at], t)), UNKNOWN, at % LEFT_OUT == 0))
    for i, t in enumerate(FOREIGN):
        out += [(variant(t), UNKNOWN, i % LEFT_OUT == 0) for _ in range(VARIANTS)]
    out += [(" ".join(rng.choices(pool, k=rng.randint(2, 14)) + rng.choices(filler, k=rng.randint(0, 6))), UNKNOWN, i % 5 == 0)
            for i in range(VARIANTS * 12)]
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 250, rate: float = 1.0, ridge: float = 1e-4) -> np.ndarray:
    """Softmax regression by gradient descent with momentum; last row: intercepts."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    want = np.eye(len(FAMILIES), dtype=np.float32)[y]
    w, speed = np.zeros((x.shape[1], len(FAMILIES)), np.float32), 0
    for _ in range(rounds):
        speed = 0.9 * speed - rate * (x.T @ (_softmax(x @ w) - want) / len(x) + ridge * w)
        w += speed
    return w


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, float]:
    """The weights (bucket, one weight per family; intercepts in bucket -1) and
    the temperature."""
    spark = docs.sparkSession
    known = F.array(*[F.lit(w) for w in _signal_words()])
    # A hash threshold first, so that a task sorts no more texts than the sample needs.
    share = min(1.0, 4 * CORPUS_LINES / max(1, docs.count()))
    order = F.xxhash64(F.col(id_col), F.xxhash64(text_col))
    corpus = (docs.filter(F.pmod(order, F.lit(1_000_000)) < share * 1_000_000).select(F.col(text_col).alias("text"), order.alias("h"))
              .orderBy("h").limit(CORPUS_LINES)
              .select(F.explode(F.split("text", "\n", -1)).alias("line")).filter(F.col("line") != "")
              .select(F.slice(tokens(F.col("line")), 1, LINE_WORDS).alias("words")).filter(~F.arrays_overlap("words", known)).limit(CORPUS_LINES))
    made = (spark.createDataFrame(examples(), "text string, family int, out boolean")
            .select(tokens(F.col("text")).alias("words"), "family", "out"))
    plain = [(t, -1, False) for ts in TEMPLATES.values() for t in ts] + [(t, -1, False) for i, t in enumerate(FOREIGN) if i % LEFT_OUT]
    plain = (spark.createDataFrame(plain, "text string, family int, out boolean")
             .select(tokens(F.col("text")).alias("words"), "family", "out"))
    corpus = corpus.withColumn("family", F.lit(UNKNOWN)).withColumn("out", F.pmod(F.xxhash64("words"), F.lit(5)) == 0)
    rows = plain.unionByName(made).unionByName(corpus).select(grams(F.col("words")).alias("grams"), "family", "out").collect()
    # The n-grams of the templates and of fitted foreign notices are the features; the rest of a window is unseen.
    used = sorted({g for r in rows if r["family"] < 0 for g in r["grams"]})
    rows = sorted((r["family"], r["out"], sorted(r["grams"])) for r in rows if r["family"] >= 0)
    at = {g: i for i, g in enumerate(used)}
    x = np.zeros((len(rows), len(used)), np.float32)
    for i, (_, _, gs) in enumerate(rows):
        x[i, [at[g] for g in gs if g in at]] = 1
    y = np.array([f for f, _, _ in rows])
    held = np.array([out for _, out, _ in rows])
    w = fit(x[~held], y[~held])
    z = np.hstack([x[held], np.ones((held.sum(), 1), np.float32)]) @ w
    loss = {t: -np.log(_softmax(z / t)[np.arange(len(z)), y[held]] + 1e-12).mean() for t in np.geomspace(0.25, 8, 26)}
    temperature = float(min(loss, key=loss.get))
    weights = [(int(g), [round(float(v), 5) for v in w[i]]) for g, i in at.items() if np.abs(w[i]).max() >= 1e-3]
    weights.append((-1, [round(float(v), 5) for v in w[-1]]))
    return spark.createDataFrame(weights, "bucket int, weights array<double>"), temperature


def _signal_words() -> list[str]:
    """Template words that ordinary prose rarely holds."""
    return [w for w in template_words() if len(w) >= 6 or any(c.isdigit() for c in w)]


def marking_words() -> list[str]:
    """Signal words of which every span with MIN_MATCH of a template's pairs holds
    one: taken greedily until the pairs without any are fewer than that."""
    left = []
    for t in (t for ts in TEMPLATES.values() for t in ts):
        w = re.findall(r"[\w]+(?:[.-][\w]+)*", t.lower())
        pairs = set(zip(w, w[1:]))
        left.append((pairs, len(pairs)))
    signal, chosen = set(_signal_words()), []
    while open_ := [pairs for pairs, n in left if len(pairs) >= MIN_MATCH * n]:
        gain = collections.Counter(w for pairs in open_ for p in pairs for w in set(p) & signal)
        best = min(gain, key=lambda w: (-gain[w], w))
        chosen.append(best)
        left = [({p for p in pairs if best not in p}, n) for pairs, n in left]
    return sorted(chosen)


def template_pairs(spark) -> DataFrame:
    """Hashed word pairs of the templates: pair, family, template, its words and
    distinct pairs, and the places at which the pair stands."""
    rows = [(k, 100 * k + i, t) for k, f in enumerate(FAMILIES[:-1]) for i, t in enumerate(TEMPLATES[f])]
    made = spark.createDataFrame(rows, "family int, template int, text string").withColumn("words", tokens(F.col("text")))
    made = made.select("family", "template", F.size("words").alias("n"),
                       F.posexplode(F.zip_with("words", F.slice("words", 2, F.size("words")), lambda a, b: F.struct(
                           F.xxhash64(a, b).alias("pair"), b.alias("next")))).alias("at", "x")).filter("x.next IS NOT NULL")
    sizes = made.groupBy("template").agg(F.countDistinct("x.pair").alias("n_pairs"))
    return made.join(sizes, "template").select(F.col("x.pair").alias("pair"), "family", "template", "n", "n_pairs", "at")


def numbered_words(text: Column) -> Column:
    """The words of a text with the number of their line."""
    return F.flatten(F.transform(F.split(text, "\n", -1), lambda x, i: F.transform(
        tokens(x), lambda w: F.named_struct(F.lit("line"), i, F.lit("word"), w))))


def _probabilities(gram: DataFrame, key: list[str], weights: DataFrame, temperature: float) -> DataFrame:
    """``key``, and the classifier's scores ``z`` from (key, bucket) of distinct n-grams and the intercept's bucket -1."""
    sums = [F.sum(F.get(F.col("weights"), k)).alias(f"z{k}") for k in range(len(FAMILIES))]
    z = gram.join(F.broadcast(weights), "bucket").groupBy(*key).agg(*sums)
    return z.select(*key, F.array(*[F.col(f"z{k}") / temperature for k in range(len(FAMILIES))]).alias("z"))


def likely(rows: DataFrame, weights: DataFrame, temperature: float) -> DataFrame:
    """The classifier's first pass over (row, text): the cells (row, cell) of STEP
    words covered by a window in which ``unknown`` is less likely than
    MAX_UNKNOWN. A window of n words starts at every n / 2 words; windows without
    a marking word can't hold a match and are not made. A window's n-grams
    come from one row, so its sums are whole before they are shuffled."""
    marked = F.filter(F.transform("words", lambda w, i: F.when(w.isin(marking_words()), i)), lambda i: i.isNotNull())
    at = F.array_distinct(F.flatten(F.transform(marked, lambda p: F.array(*[
        F.struct(F.lit(size).alias("size"), (F.floor(p / (size // 2)) - back).cast("int").alias("j")) for size in SCALES for back in (0, 1)]))))
    placed = (rows.select("row", numbered_words(F.col("text"))["word"].alias("words")).select("row", "words", F.explode(at).alias("w"))
              .filter("w.j >= 0").select("row", "w.size", "w.j", F.slice("words", F.col("w.j") * (F.col("w.size") / 2).cast("int") + 1, F.col("w.size")).alias("words")))
    key = ["row", "size", "j"]
    z = _probabilities(placed.select(*key, F.explode(F.concat(F.array(F.lit(-1)), grams(F.col("words")))).alias("bucket")), key, weights, temperature)
    top = F.array_max("z")
    unknown = F.exp(F.get("z", F.lit(UNKNOWN)) - top) / F.aggregate("z", F.lit(0.0), lambda a, v: a + F.exp(v - top))
    first = (F.col("j") * (F.col("size") / 2) / STEP).cast("int")
    return (z.filter(unknown < MAX_UNKNOWN)
            .select("row", F.explode(F.sequence(first, (first + F.col("size") / STEP - 1).cast("int"))).alias("cell")).distinct())


def windows(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Word windows of (row, text) whose pairs lie in ``cells`` and that hold MIN_MATCH of the pairs of a
    template: row, start, stop (word numbers, inclusive), line of the first
    word, family, pairs held, match. A window is either aligned with the template (pairs at
    most SHIFT of its length off their places) or, for notices with words put in
    or moved, any span of at most LOOSE further words; it begins and ends with a
    pair, so words around a notice are not part of it. Windows run across line
    breaks: marks of comments and blank lines hold no word."""
    words = numbered_words(F.col("text"))
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.named_struct(
        F.lit("line"), a["line"], F.lit("last"), b.isNull(), F.lit("pair"), F.xxhash64(a["word"], b["word"])))
    held = (rows.select("row", F.posexplode(pairs).alias("p", "x")).filter("NOT x.last").select("row", "p", "x.line", "x.pair")
            .join(F.broadcast(template_pairs(rows.sparkSession)), "pair")
            .withColumn("cell", F.floor(F.col("p") / STEP).cast("int")).join(cells, ["row", "cell"], "left_semi"))
    aligned = (F.col("p") - F.col("at")) / (F.floor(F.col("n") * SHIFT) + 0.5)
    loose = F.col("p") / (F.col("n") + F.greatest(F.col("n"), F.lit(LOOSE)) - 1.5)

    def over(order: Column) -> Column:
        # In units of the reach, so that one frame serves templates of all lengths.
        w = Window.partitionBy("row", "template").orderBy(order).rangeBetween(0, 1)
        return F.struct(F.min(F.struct("p", "line")).over(w).alias("first"), F.max("p").over(w).alias("last"),
                        F.size(F.collect_set("pair").over(w)).alias("n_held"))

    spans = (held.withColumn("aligned", over(aligned)).withColumn("loose", over(loose))
             .select("row", "family", "n_pairs", F.explode(F.array("aligned", "loose")).alias("w")))
    return (spans.select("row", F.col("w.first.p").alias("start"), (F.col("w.last") + 1).alias("stop"),
                         F.col("w.first.line").alias("line"), "family", "w.n_held", (F.col("w.n_held") / F.col("n_pairs")).alias("match"))
            .filter(F.col("match") >= MIN_MATCH).groupBy("row", "start", "stop", "line", "family")
            .agg(F.max("n_held").alias("n_held"), F.max("match").alias("match")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and licences, an array of (paragraph,
    family, probability, match) of the confirmed notices."""
    spark = docs.sparkSession
    weights, temperature = train(docs, id_col, text_col)
    # A text without a template word that marks licences can't be confirmed.
    hit = rf"(?i)\b({'|'.join(w.replace('.', '[.]') for w in marking_words())})\b"
    text = F.col(text_col)
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), F.when(F.regexp(text, F.lit(hit)), text).alias("text"))
               .withColumn("row", F.monotonically_increasing_id()))
    some = rows.filter("text IS NOT NULL").select("row", "text")
    held = cut(windows(some, likely(some, weights, temperature)))
    asked = held.groupBy("row").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    found = cut(some.join(asked, "row").select("row", numbered_words(F.col("text"))["word"].alias("words"), F.explode("spans").alias("w"))
                .select("row", "w.start", "w.stop", F.slice("words", F.col("w.start") + 1, F.col("w.stop") - F.col("w.start") + 1).alias("words")))
    key = ["row", "start", "stop"]
    gram = found.select(*key, F.explode(grams(F.col("words"))).alias("bucket")).unionByName(
        found.select(*key, F.lit(-1).alias("bucket")))
    z = _probabilities(gram, key, weights, temperature)
    top = (z.withColumn("best", F.array_max("z"))
           .select(*key, (F.array_position("z", F.col("best")) - 1).cast("int").alias("family"),
                   (1 / F.aggregate("z", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("best")))).alias("probability"))
           .filter((F.col("family") != UNKNOWN) & (F.col("probability") >= MIN_PROBABILITY)))
    names = F.array(*[F.lit(f) for f in FAMILIES])
    # Of windows that overlap, the one that holds most pairs, then the shortest.
    found = F.struct((-F.col("n_held")).alias("rank"), (F.col("stop") - F.col("start")).alias("size"), "start", "stop", F.struct(
        F.col("line").alias("paragraph"), F.get(names, F.col("family")).alias("family"), F.round("probability", 4).alias("probability"),
        F.round("match", 4).alias("match")).alias("licence"))
    per_row = top.join(held, [*key, "family"]).groupBy("row").agg(F.array_sort(F.collect_list(found)).alias("found"))
    kept = F.aggregate("found", F.slice("found", 1, 0), lambda done, x: F.when(
        F.exists(done, lambda y: (y["start"] <= x["stop"]) & (x["start"] <= y["stop"])), done).otherwise(F.concat(done, F.array(x))))
    # Notices of one family that begin in the same line count once: the best one.
    kept = F.aggregate(F.transform(kept, lambda x: x["licence"]), F.slice(F.transform("found", lambda x: x["licence"]), 1, 0),
                       lambda done, x: F.when(F.exists(done, lambda y: (y["paragraph"] == x["paragraph"]) & (y["family"] == x["family"])), done)
                       .otherwise(F.concat(done, F.array(x))))
    per_row = per_row.select("row", F.array_sort(kept).alias("licences"))
    return rows.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id", F.coalesce("licences", F.array().cast(
            "array<struct<paragraph:int,family:string,probability:double,match:double>>")).alias("licences"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_licences, families (distinct, comma-joined) and paragraphs
    (``number:family`` of each, comma-joined)."""
    return scan(docs).select(
        "doc_id", F.size("licences").cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.transform("licences", lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"])), ",").alias("paragraphs"))
