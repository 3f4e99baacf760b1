"""Language ID, mixing and licence scans: held-out accuracy and exact rules."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlake.llm import language_id, license_scan, mixing


def test_language_query(spark, small, llm_queries):
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in llm_queries["op7_language_id"](spark, small).collect()}
    assert got.keys() == truth.keys()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es"}
    held = [i for i, r in got.items() if r.held_out]
    assert np.mean([got[i].lang_pred == truth[i][0] for i in held]) >= 0.95


def test_language_edge_cases(spark, edge, nothing):
    rows = [(i, " ".join(["the cat and the dog went home"] * 3), "en") for i in range(40)]
    rows += [(100 + i, " ".join(["der hund und die katze gehen nach haus"] * 3), "de") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    assert model.languages == ["de", "en"]
    asked = spark.createDataFrame([(1, "the dog and the cat", 1), (2, "die katze und der hund", 2), (3, None, 3), (4, "", 4),
                                   (None, "12 !! 34", 5), (6, "漢字 кириллица", 6)], "doc_id long, text string, score int")
    out = language_id.predict(asked, model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score", "rejected"]
    got = {r.doc_id: r for r in out.collect()}
    assert (got[1].lang_pred, got[1].rejected, got[2].lang_pred, got[2].rejected) == ("en", False, "de", False)
    for i in (3, 4, None):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[6].rejected
    assert language_id.digest(edge).count() == edge.count() and language_id.digest(nothing).count() == 0
    assert language_id.identified(edge).columns == edge.columns and language_id.identified(nothing).count() == 0


def test_long_text_is_counted_whole(monkeypatch):
    text = "Ein langer Text, " * 200 + "zum Schluss."
    whole = language_id.counts([text, "x", text])
    monkeypatch.setattr(language_id, "PIECE", 100)
    assert (language_id.counts([text, "x", text]) == whole).all()


def test_mixing_meets_targets(spark, small, llm_queries):
    rows = llm_queries["op6_mixing"](spark, small).toPandas()
    truth = {r.doc_id: mixing.domain_of for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id").collect()}
    assert set(rows.doc_id) == set(truth) and len(rows) == len(truth)
    labels = spark.read.parquet(f"{small}/labels.parquet")
    domains = sorted(r[0] for r in labels.select(mixing.domain_of().alias("d")).filter("d IS NOT NULL").distinct().collect())
    p = np.stack(rows.posteriors)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5) and (rows.rate >= 0).all()
    got = (p * (rows.n_tokens * rows.rate).to_numpy()[:, None]).sum(axis=0)
    want = np.array([mixing.WEIGHTS[d] for d in domains])
    assert np.allclose(got / got.sum(), want / want.sum(), atol=2e-3)
    assert abs(got.sum() / rows.n_tokens.sum() - 1) < 2e-3
    assert (abs(rows.copies - rows.rate) < 1).all()


def _accelerated(p, n, target, top, rounds=60_000):
    """Plain accelerated projected gradient on the least squares: the smallest miss that it finds."""
    a = (p * n[:, None]).T
    size = 1 / np.linalg.norm(a * np.sqrt(1 / n), 2) ** 2
    r = y = np.minimum(np.ones(len(n)), top)
    t = 1.0
    for _ in range(rounds):
        new = np.clip(y + size * (p @ (target - a @ y)), 0, top)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y, r = new + (before - 1) / t * (new - r), new
    return a @ r


@pytest.mark.parametrize("weights,top", [({"a": 0.7, "b": 0.3, "c": 0.0}, None), ({"a": 0.2, "b": 0.3, "c": 0.5}, None),
                                         ({"a": 0.6, "b": 0.3, "c": 0.1}, 1.0), ({"a": 0.05, "b": 0.05, "c": 0.9}, 1.0)])
def test_rates_meet_targets_as_an_independent_solver_does(spark, weights, top):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 200)
    n = rng.integers(1, 500, 200)
    rows = spark.createDataFrame([(int(i), int(t), [float(x) for x in q]) for i, (t, q) in enumerate(zip(n, p))],
                                 "doc_id long, n_tokens long, posteriors array<double>")
    got = np.array([r.rate for r in mixing.rates(rows, ["a", "b", "c"], weights, top).orderBy("doc_id").collect()])
    w, mass = np.array(list(weights.values())), (p * n[:, None]).sum(axis=0)
    target = w * mass.sum() if top is None else np.minimum(w * mass[w.argmax()] / w.max(), mass)
    limit = np.inf if top is None else top
    assert (got >= 0).all() and (got <= limit).all()
    miss = np.linalg.norm((p * n[:, None]).T @ got - target)
    best = np.linalg.norm(_accelerated(p, n, target, limit) - target)
    assert miss <= best + 1e-4 * mass.sum()
    if miss < 1e-4 * mass.sum():  # within reach: of all solutions the nearest to 1, projections of 1 + p . s
        free = (got > 1e-5) & (got < limit - 1e-5)
        s, *_ = np.linalg.lstsq(p[free], got[free] - 1, rcond=None)
        assert np.allclose(np.clip(1 + p @ s, 0, limit), got, atol=1e-4)


def test_mixing_edge_cases(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (7, 1, 0), (7, 1, 0), (None, 1, 1), (6, None, 1)],
                                   "doc_id long, quality int, toxic int")
    model = mixing.learn(edge, mixing.domains_of(labels))
    assert model.domains == ["q0t0", "q1t0"]
    rows = mixing.rated(edge, model, mixing.WEIGHTS)
    assert rows.count() == edge.count() and rows.filter("n_tokens = 0").count() == 3
    assert mixing.mix(edge, model).columns == edge.columns
    assert mixing.mix(nothing, model).count() == 0
    none = mixing.learn(nothing, mixing.domains_of(labels.limit(0)))
    assert none.domains == ["all"] and mixing.rated(edge, none, {}).filter("rate <> 1").count() == 0


EXACT = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "Released under the MIT License.": "mit", "All rights reserved.": "proprietary",
         "This work is licensed under the GNU General Public License, version 3.": "gpl",
         "Licensed under the Apache License, Version 2.0.": "apache-2.0"}


def test_licence_query_finds_every_notice(spark, small, llm_queries, small_docs):
    got = {r.doc_id: r for r in llm_queries["op2_license_scans"](spark, small).collect()}
    assert len(got) == len(small_docs)
    found = 0
    for i, text in small_docs:
        want = [f"{k}:{EXACT[x]}" for k, x in enumerate((text or "").split("\n")) if x in EXACT]
        assert got[i].paragraphs == ",".join(want) and got[i].n_licences == len(want), i
        found += len(want)
    assert found


def test_licence_edge_cases(spark, edge, nothing):
    rows = [(1, "Distributed under the MIT License"), (2, "Licensed under CC BY-SA 4.0."), (3, "Licensed under CC BY 4.0."),
            (4, "# Licensed under the Apache License, Version 2.0 (the License);"), (5, "license apache the under version"),
            (6, "The license of the car was renewed in version 2.0 of the general public"), (7, None), (None, ""), (8, "all rights")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [x.family for x in r.licences] for r in license_scan.scan(docs).collect()}
    assert got == {1: ["mit"], 2: ["cc-by-sa"], 3: ["cc-by"], 4: ["apache-2.0"], 5: [], 6: [], 7: [], None: [], 8: []}
    assert license_scan.digest(edge).count() == edge.count() and license_scan.digest(nothing).count() == 0
    plan = license_scan.digest(edge)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_native_operators_run_no_python(edge):
    from sessionlake.llm import exact_dedup, line_dedup, quality_rules

    for out in (exact_dedup.decisions(edge), exact_dedup.dedup(edge), line_dedup.digest(edge), quality_rules.digest(edge)):
        plan = out.withColumn("x", F.lit(1))._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_licence_notices_inside_long_lines(spark):
    prose = "the car of the reader was standing by the river in a version of the public house when all rights were sold".split()
    notices = {"Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit",
               license_scan.TEMPLATES["gpl"][1]: "gpl", license_scan.TEMPLATES["bsd"][0]: "bsd", "All rights reserved.": "proprietary",
               "SPDX-License-Identifier: MPL-2.0": "mpl", license_scan.TEMPLATES["cc-by-sa"][1]: "cc-by-sa"}
    rows, want = [], {}
    for n in (100, 1000, 10000):
        for notice, family in notices.items():
            words = [prose[i * 7 % len(prose)] + ("" if i % 3 else "s") for i in range(n)]
            want[len(rows)] = [family]
            rows.append((len(rows), " ".join(["A line before.\n", *words[:n // 2], notice, *words[n // 2:], "\nAnd after."])))
    want[len(rows)] = []
    rows.append((len(rows), " ".join(prose * 500)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.licences for r in license_scan.scan(docs).collect()}
    assert {i: [x.family for x in ls] for i, ls in got.items()} == want
    assert all(x.paragraph == 1 for ls in got.values() for x in ls)


def test_wrapped_licence_notices(spark):
    import textwrap

    rows, want = [], {}
    for family, texts in license_scan.TEMPLATES.items():
        for t in texts:
            for width, mark in ((40, " * "), (72, "# "), (80, "")):
                if len(t) > width:
                    lines = textwrap.wrap(t, width, break_on_hyphens=False)
                    want[len(rows)] = [(2, family)]
                    rows.append((len(rows), "\n".join(["Some words.", "", *(mark + x for x in lines), "", "More words."])))
    want[len(rows)] = [(0, "proprietary"), (1, "proprietary"), (2, "mit"), (2, "proprietary")]
    rows.append((len(rows), "All rights reserved.\nAll rights reserved.\nReleased under the MIT License. All rights\nreserved."))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: sorted((x.paragraph, x.family) for x in r.licences) for r in license_scan.scan(docs).collect()}
    assert got == want


def test_licences_of_one_kin_and_foreign_ones(spark):
    known = {
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public\nLicense as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.": "lgpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "agpl",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": "gpl",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.": "isc",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0": "epl",
        "SPDX-License-Identifier: LGPL-2.1-or-later": "lgpl", "// SPDX-License-Identifier: AGPL-3.0-only": "agpl",
        "SPDX-License-Identifier: ISC": "isc", "SPDX-License-Identifier: CC-BY-NC-SA-4.0": "cc-by-nc-sa",
        "Licensed under CC BY-ND 4.0.": "cc-by-nd", "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "cc-by-nd",
    }
    # Not among the notices that the classifier learns as foreign.
    foreign = ["Licensed under the Zope Public License, Version 2.0.", "SPDX-License-Identifier: Zlib", "Released under the Vim License.",
               "Licensed under the Solderpad Hardware License, Version 2.1 (the \"License\"); you may not use this file.",
               "This Source Code Form is subject to the terms of the Nokia Open Source License, v. 1.0.",
               "This work is licensed under the Free Art License, version 1.3.",
               # Of the kin of a learned foreign notice.
               "Permission to use, copy, modify, and distribute this software and its documentation for any purpose and without fee is hereby "
               "granted, provided that the above copyright notice appear in all copies.",
               *[t for i, t in enumerate(license_scan.FOREIGN) if i % license_scan.LEFT_OUT == 0]]
    texts = [*known, *foreign]
    docs = spark.createDataFrame([(i, f"Some words.\n{t}\nMore words.") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {texts[r.doc_id]: [x.family for x in r.licences] for r in license_scan.scan(docs).collect()}
    assert got == {t: [f] for t, f in known.items()} | {t: [] for t in foreign}


def test_marking_words_touch_every_match():
    for t in (t for ts in license_scan.TEMPLATES.values() for t in ts):
        w = license_scan.re.findall(r"[\w]+(?:[.-][\w]+)*", t.lower())
        pairs = set(zip(w, w[1:]))
        free = [p for p in pairs if not set(p) & set(license_scan.marking_words())]
        assert len(free) < license_scan.MIN_MATCH * len(pairs), t


def test_unseen_language_is_rejected(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").filter("text RLIKE '[A-Za-z]{3}'").cache()
    for unseen in ("de", "en"):
        out = language_id.predict(docs, language_id.learn(docs.filter(F.col("lang") != unseen)))
        share = {r.u: r.s for r in out.groupBy((F.col("lang") == unseen).alias("u")).agg(F.avg(F.col("rejected").cast("int")).alias("s")).collect()}
        assert share[True] >= 0.9 and share[False] <= 0.05, (unseen, share)


def test_too_many_classes_are_an_error(spark):
    docs = spark.createDataFrame([(i, f"some words {i}", f"l{i % 40}", f"d{i % 40}") for i in range(400)], "doc_id long, text string, lang string, domain string")
    with pytest.raises(ValueError, match="30 languages"):
        language_id.learn(docs, max_languages=30)
    with pytest.raises(ValueError, match="39 domains"):
        mixing.learn(docs, docs.select("doc_id", "domain"), max_domains=39)
    assert len(mixing.learn(docs, docs.select("doc_id", "domain"), max_domains=40).domains) == 40


def test_limits_of_rounds_are_told(spark, monkeypatch):
    from sessionlake.llm import components

    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    monkeypatch.setattr(components, "MAX_ROUNDS", 1)
    with pytest.raises(RuntimeError, match="1 rounds"):
        components.components(chain)
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, int(t), [float(x) for x in q]) for i, (t, q) in enumerate(
        zip(rng.integers(1, 500, 50), rng.dirichlet([0.3, 0.3, 0.3], 50)))], "doc_id long, n_tokens long, posteriors array<double>")
    monkeypatch.setattr(mixing, "MAX_ROUNDS", 1)
    with pytest.warns(UserWarning, match="not fitted in 1 rounds"):
        mixing.rates(rows, ["a", "b", "c"], {"a": 0.9, "b": 0.1, "c": 0.0})
