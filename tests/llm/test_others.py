"""Operators 1, 4, 6, 7, 8 and 10 against brute force, held-out rows and awkward rows."""
import random
from collections import defaultdict

import numpy as np
import pytest

import cases
from cases import SF
from kinlink.llm import (bitsliced_topk as B, kn_langid as L, license_rules as C, mixing as M, queries,
                         sparse_suffix as P, weak_quality as W)

SF2 = "/root/testdata/sf0.01"


def test_least_hashed(spark):
    from pyspark.sql import functions as F
    from kinlink.llm.common import least_hashed
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    want = df.orderBy(F.xxhash64("id"), "id").limit(40).collect()
    assert least_hashed(df, "id", 40).collect() == want
    assert least_hashed(df.limit(3), "id", 40).count() == 3 and least_hashed(df.limit(0), "id", 40).count() == 0
    assert least_hashed(df.union(df), "id", 5000).count() == 5000


# ---------------------------------------------------------------------- 1 --
def test_weak_labels(spark, awkward, empty):
    got = W.quality_scores(awkward).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in cases.awkward())
    assert all(0 <= r.score <= 1 and len(r.votes) == 10 for r in got)
    assert W.quality_scores(empty).collect() == []
    score = {r.doc_id: r for r in queries.op1_quality(spark, SF2).collect()}
    labelled = spark.read.parquet(f"{SF2}/labels.parquet").collect()     # never seen by the operator
    assert np.mean([score[r.doc_id].kept for r in labelled if r.quality]) > 0.98
    assert np.mean([score[r.doc_id].kept for r in labelled if not r.quality]) < 0.15


def test_samples_with_null_and_repeated_ids(spark):
    from pyspark.sql import functions as F
    from kinlink.llm.common import least_hashed
    df = spark.range(20000).withColumn("k", F.col("id") % 200)
    assert least_hashed(df, "k", 100).count() == 100
    texts = spark.range(600).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("some words of text number "), F.expr("repeat('word ', 1 + cast(id % 300 as int))")).alias("text"))
    got = W.quality_scores(texts, max_train=50).collect()
    assert len(got) == 600 and all(0 <= r.score <= 1 for r in got)
    assert not W.fit_scorer([], np.zeros(0)).any()


def test_every_word_shape_counts():
    text = " ".join("a1" * k + "-" * (k % 3) for k in range(1, 90))
    words, values = W.shares(text)
    start, whole = W.hashed_features(text, words, values), W.hashed_features(text + " Zz9Zz9Zz9", words, values)
    assert len(whole[0]) == len(start[0]) + 1 and len(start[0]) > 70


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.7
    rates = [0.95, 0.9, 0.8, 0.7]
    votes = np.stack([np.where(rng.random(20000) < 0.3, 0, np.where(rng.random(20000) < a, 1, -1) * np.where(truth, 1, -1)) for a in rates], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    assert np.allclose(W.VoteModel(patterns, counts.astype(float)).accuracies, rates, atol=0.05)


# ---------------------------------------------------------------------- 4 --
def test_language(spark, awkward, empty):
    got = queries.op4_language(spark, SF2).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF2}/documents.parquet").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and len(held) > 100
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    rows = L.identify(awkward).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in cases.awkward())
    for r in rows:
        assert r.lang_pred in ("en", "fr", "und") and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (4, 5, 6, 12) or r.lang_pred == "und" and r.doc_id is None)
    assert L.identify(empty).collect() == []
    nothing = cases.frame(spark, [(1, "some text", None, None, None), (None, "text", "en", None, None)])
    assert {(r.lang_pred, r.score) for r in L.identify(nothing).collect()} == {("und", 0.0)}


def test_kneser_ney_sums_to_one():
    texts = {"x": ["the cat sat on the mat and the rat ran", "that is it"], "y": ["un chat est sur le tapis avec un rat"]}
    m = L.LanguageModels({k: L.counted(v, 3) for k, v in texts.items()})
    known = sorted({int(c) for v in texts.values() for t in v for c in L.symbols(t)})
    for context in ("th", "at", "un", "  ", "zq"):
        rows = np.stack([np.array([*map(ord, context), s], np.uint64) for s in [*known, 0x4E00]])
        p = np.stack([np.exp(m._log_probs(r, 3, np.array([2]))[0].astype(float)) for r in rows])
        assert np.allclose(p[:-1].sum(axis=0) + 1000 * p[-1], 1, atol=1e-6)     # what no text has shares one symbol's place


def test_counts_of_parts_add_up():
    texts = [cases.words(50, i) for i in range(6)]
    whole, parts = L.counted(texts), [L.counted(texts[:2]), L.counted(texts[2:])]
    for n in range(L.ORDER):
        total = defaultdict(int)
        for part in parts:
            for h, c in zip(part[n][0].tolist(), part[n][1].tolist()):
                total[h] += c
        assert total == dict(zip(whole[n][0].tolist(), whole[n][1].tolist()))


def test_language_rejection(spark):
    import string
    r = random.Random(3)
    rows = [(i, cases.words(40, i) if i % 2 else cases.words(40, i)[::-1].replace("t", "z"), "ab"[i % 2], "s", 1) for i in range(400)]
    rows += [(1000 + i, "".join(r.choices(string.ascii_lowercase + " ", k=200)), None, "s", 1) for i in range(20)]
    rows += [(2000, "совсем другой язык без общих букв", None, "s", 1), (2001, "\u65e5\u672c\u8a9e", None, "s", 1)]
    got = L.identify(cases.frame(spark, rows), per_language=100).collect()
    own = [x for x in got if x.doc_id < 1000]
    assert all(x.lang_pred == "ab"[x.doc_id % 2] for x in own)
    assert np.mean([x.rejected for x in own]) < 0.02 and all(x.score > 0.5 for x in own if not x.rejected)
    strange = [x for x in got if x.doc_id >= 1000]
    assert len(strange) == 22 and all(x.rejected and x.score < 0.5 for x in strange)


# ---------------------------------------------------------------------- 6 --
def plain_passages(rows, width=50):
    """Words in windows that another text has, and in windows that only this text has, twice."""
    texts, where = defaultdict(int), defaultdict(set)
    for _, t, *_ in rows:
        texts[t] += 1
    for t in texts:
        w = (t or "").encode().split()
        for s in range(len(w) - width + 1):
            where[tuple(w[s:s + width])].add((t, s))
    out = []
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        other, own = set(), set()
        for s in range(len(w) - width + 1):
            places = where[tuple(w[s:s + width])]
            if len({x for x, _ in places}) > 1 or texts[t] > 1:
                other |= set(range(s, s + width))
            elif len(places) > 1:
                own |= set(range(s, s + width))
        out.append((str(i), len(w), sorted(other), sorted(own)))
    return sorted(out)


def inside(spans, n):
    have = set()
    for s in filter(None, spans.split(",")):
        a, b = map(int, s.split(":"))
        have |= set(range(a, b))
    assert len(have) == n
    return sorted(have)


def covered(got):
    return sorted((str(r.doc_id), r.n_words, inside(r.spans, r.n_repeated), inside(r.own_spans, r.n_own)) for r in got)


def test_passages(spark, awkward, empty):
    assert covered(P.repeated_passages(awkward).collect()) == plain_passages(cases.awkward())
    assert P.repeated_passages(empty).collect() == []
    r = random.Random(5)
    passage, other = cases.words(55, 11), cases.words(49, 12)
    rows = []
    for i in range(40):
        text = f"{cases.words(r.randint(0, 90), 100 + i)} {passage if i % 3 == 0 else other} {cases.words(r.randint(0, 90), 200 + i)}"
        rows.append((i, text, "en", "a", 1))
    rows += [(50, rows[0][1], "en", "a", 1), (51, cases.words(70, 13) + " " + cases.words(70, 13), "en", "a", 1)]
    assert covered(P.repeated_passages(cases.frame(spark, rows)).collect()) == plain_passages(rows)


@pytest.mark.parametrize("letters, partitions", [(1, 3), (2, 5), (3, 16), (40, 7)])
def test_passages_few_words(spark, letters, partitions):
    """Texts cut from one another: matches of every length to both sides, frequent seeds, many ranges."""
    r = random.Random(letters)
    base = [f"w{r.randrange(letters)}" for _ in range(160)]
    rows = []
    for i in range(60):
        a, b = sorted((r.randrange(161), r.randrange(161)))
        c = r.randrange(120)
        new = [f"w{r.randrange(letters)}" for _ in range(r.randrange(40))]
        rows.append((i, " ".join(base[a:b] + new + base[c:c + r.randrange(60)] + ["x" * (60 + i)]), "en", "a", 1))
    wanted = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        assert covered(P.repeated_passages(cases.frame(spark, rows)).collect()) == plain_passages(rows)
        got = P.repeated_passages(cases.frame(spark, rows), min_words=20, seed=8).collect()
        assert covered(got) == plain_passages(rows, 20)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_passages_of_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert covered(queries.op6_passages(spark, SF).collect()) == plain_passages(rows)


# ---------------------------------------------------------------------- 7 --
def plain_top(rows, every, k):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, a) in enumerate(ok):
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for n, (i, b) in enumerate(ok) if n != at)[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string, _row string, own string, v string")


def test_top_k(spark):
    r = random.Random(1)
    rows = [(i, [np.float32(r.uniform(-1, 1)).item() for _ in range(7)]) for i in range(300)]
    rows += [(i, rows[i][1]) for i in range(0, 50, 7)] + [(400, rows[3][1]), (401, rows[3][1])]     # repeated rows, ties
    rows += [(500, [0.0] * 7), (550, [1.0, -1.0]), (600, []), (650, None), (700, [None] * 7), (750, [float("nan")] * 7),
             (800, [float("inf")] * 7), (None, rows[0][1]), (850, [3e4] * 7), (-50, rows[9][1])]
    df = vectors(spark, [(i, v, 1, "x", "x", "x", "x") for i, v in rows])
    for blocks in ({}, {"block_rows": 64, "stripes": 2}, {"block_rows": 64, "stripes": 1}):
        got = sorted((a, b, c, d) for a, b, c, d in B.top_k(df, every=50, k=5, **blocks).collect())
        assert got == plain_top(rows, 50, 5)
    few = vectors(spark, [(i, v, 1, "x", "x", "x", "x") for i, v in rows[50:53]])
    assert [tuple(r) for r in B.top_k(few).orderBy("rank").collect()] == plain_top(rows[50:53], 50, 5)
    assert B.top_k(df.limit(0)).collect() == []


def test_top_k_of_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, queries.op7_topk(spark, SF).collect())) == plain_top(rows, 50, 5)


# ---------------------------------------------------------------------- 8 --
MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. More."""


def test_licenses(spark, awkward, empty):
    assert all(any(s in k for s in C.STEMS) for k in C.SENTENCES)
    assert {i for _, run in C.RULES for i in run} <= set(C.SENTENCES.values())
    texts = {1: MIT, 2: "x |\nAll rights reserved.", 3: "Licensed under the Apache License, Version 2.0.\nAll Rights  Reserved. Released under the MIT License!",
             4: "no licence here; permission denied", 5: "Licensed under CC BY-NC 4.0."}
    got = {r.doc_id: r for r in C.find_licenses(cases.frame(spark, [(i, t, "en", "a", 1) for i, t in texts.items()])).collect()}
    assert {i: r.licenses for i, r in got.items()} == {1: "MIT", 2: "Proprietary", 3: "MIT,Apache-2.0", 4: "", 5: "CC-BY-NC-4.0"}
    assert got[1].sentence_ids == "mit-grant,mit-condition,mit-warranty"
    assert {(r.n_sentences, r.sentence_ids, r.licenses) for r in C.find_licenses(awkward).collect()} == {(0, "", "")}
    assert C.find_licenses(awkward).count() == awkward.count() and C.find_licenses(empty).collect() == []
    plan = C.find_licenses(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ordinary_notices(spark):
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions\n"
           "are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following\n   disclaimer.\n"
           "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in\n"
           "the documentation and/or other materials provided with the distribution.\n")
    name = ("3. Neither the name of Acme Inc. nor the names of its\ncontributors may be used to endorse or promote products derived from this software "
            "without specific prior written permission.\n")
    gnu = "This {} is free software: you can redistribute it and/or\nmodify it under the terms of the GNU {} Public License as published by the Free Software\nFoundation, either version {} of the License, or (at your option) any later version."
    texts = [("This project is licensed under the MIT License.", "MIT"), ("Foo is released under the MIT licence - see LICENSE for details.", "MIT"),
             ("# SPDX-License-Identifier: Apache-2.0\nimport x", "Apache-2.0"), ("// SPDX-License-Identifier: (MIT OR GPL-2.0-or-later)\n", "MIT,GPL-2.0-or-later"),
             ("/* SPDX-License-Identifier: LGPL-2.1+ */", "LGPL-2.1-or-later"), ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0"),
             ("SPDX-License-Identifier: MIT-0", ""), (gnu.format("library", "Lesser General", "2.1"), "LGPL-2.1-or-later"),
             (gnu.format("program", "Affero General", "3"), "AGPL-3.0-or-later"), (gnu.format("program", "General", "2"), "GPL-2.0-or-later"),
             ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("Distributed under the GPLv3 or later.", "GPL-3.0-or-later"),
             ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies it", "EPL-2.0"),
             ("The origin of this software must not be misrepresented; you must not claim it.", "Zlib"),
             ("Distributed under the Boost Software License, Version 1.0. (See http://x)", "BSL-1.0"),
             ("To the extent possible under law, Jane Doe has waived all copyright and related or neighboring rights to Foo.", "CC0-1.0"),
             ("Copyright (c) 2020, Acme Corp.\nAll rights reserved.\n\n" + bsd + name, "BSD-3-Clause"),
             ("Copyright 2020 X. All rights reserved. Use of this source code is governed by a BSD-style license that can be found", ""),
             ("Copyright 2020 X. All rights reserved.", "Proprietary"),
             (bsd + name.replace("Acme Inc.", "the " + "very " * 40 + "long name, Inc."), "BSD-3-Clause"),
             (bsd + name.replace("Acme Inc. nor the names of its", "Acme Inc. or") + "x " * 20000, "BSD-2-Clause"),
             ("SPDX-License-Identifier: MIT OR Apache-2.0 OR BSD-3-Clause OR ISC OR Zlib OR BSL-1.0 OR (MPL-2.0 AND EPL-2.0 AND GPL-2.0-or-later)\n",
              "MIT,BSD-3-Clause,Apache-2.0,ISC,GPL-2.0-or-later,MPL-2.0,Zlib,BSL-1.0,EPL-2.0"),
             ("MIT License\n\nCopyright", "MIT"), ("# The MIT License (MIT)\n", "MIT"), ("The MIT License server is down", ""),
             ("Licensed under MIT.", "MIT"), ("Released under MIT.", "MIT"), ("Licensed under MIT Press rules", ""), ("Licensed under MIT or Apache-2.0 at your option", "MIT,Apache-2.0"),
             ("Licensed under either of the Apache License, Version 2.0 or the MIT license at your option.", "MIT,Apache-2.0"),
             ("This is available under the MIT License, or the ISC license, and the GPLv2 or later.", "MIT,ISC,GPL-2.0-or-later"),
             (bsd + name, "BSD-3-Clause"), (bsd, "BSD-2-Clause"), (bsd + name.replace("Acme Inc.", "the University of X"), "BSD-3-Clause"),
             (MIT + "\n\nLicensed under the Apache License, Version 2.0\nand further text without an end", "MIT,Apache-2.0"),
             ("It is not licensed under the MIT License.", ""), ("Permission denied by the licence server", "")]
    got = C.find_licenses(cases.frame(spark, [(i, t, "en", "a", 1) for i, (t, _) in enumerate(texts)])).collect()
    assert [(texts[r.doc_id][0][:90], r.licenses) for r in got if r.licenses != texts[r.doc_id][1]] == []
    assert all(any(s in k for s in C.MORE_STEMS) for k in C.MORE)


# --------------------------------------------------------------------- 10 --
def test_mixing(spark, awkward, empty, labels, no_labels):
    from pyspark.sql import functions as F
    got = queries.op10_mixing(spark, SF2).toPandas()
    p, w = np.array(got.posterior.tolist()), got.n_tokens.to_numpy()
    domains = sorted(queries.TARGETS)
    mixed = (p * (w * got.rate.to_numpy())[:, None]).sum(axis=0) / w.sum()
    assert np.allclose(mixed, [queries.TARGETS[d] for d in domains], atol=2e-3) and (got.rate >= 0).all()
    assert np.allclose(p.sum(axis=1), 1)
    assert ((got.copies - got.rate).abs() < 1).all() and abs(got.copies.mean() - got.rate.mean()) < 0.05
    truth = {r[0]: r[1] for r in queries.labelled_domains(spark, SF2).collect()}
    assert np.mean([truth[i] == d for i, d in zip(got.doc_id, got.domain) if i in truth]) > 0.9

    named = lambda x: x.select("doc_id", F.when(F.col("quality") > 0, "good").when(F.col("quality") == 0, "poor").alias("domain"))
    rates = M.domain_rates(awkward, named(labels), {"good": 0.9, "poor": 0.1}).collect()
    assert sorted(str(r.doc_id) for r in rates) == sorted(str(r[0]) for r in cases.awkward())
    out = M.mix(awkward, named(labels), {"good": 0.9, "poor": 0.1})
    assert out.columns == awkward.columns and out.count() == sum(r.copies for r in rates)
    flat = M.domain_rates(awkward, named(no_labels), {"good": 1.0}).collect()
    assert {(r.domain, r.rate, r.copies) for r in flat} == {("all", 1.0, 1)}
    assert M.mix(empty, named(labels), {"good": 1.0}).collect() == [] and M.domain_rates(empty, named(labels), {}).collect() == []


def test_unreachable_targets_give_the_nearest_totals(spark):
    rows = spark.createDataFrame([(10, 1.0, 0.0), (10, 0.5, 0.5)], "n long, a double, b double")
    steps = M.solve(rows, "n", ["a", "b"], [0.0, 1.0])
    r = [x[0] for x in rows.select(M.rate(steps, ["a", "b"])).collect()]
    # least of (s_a)^2/15 + (s_b - 20)^2/5 over rates >= 0: the first document goes, the second has rate 3
    assert r[0] < 1e-3 and abs(r[1] - 3) < 0.01


def best_squares(t, p, want, w):
    """Least squares over nonnegative rates, by an active-set method on the documents' token vectors."""
    a = (p * t[:, None]).T / np.sqrt(w)[:, None]
    b = want / np.sqrt(w)
    r, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(2000):
        slope = a.T @ (b - a @ r)
        slope[free] = -np.inf
        j = int(np.argmax(slope))
        if slope[j] <= 1e-11:
            break
        free[j] = True
        while True:
            z = np.zeros_like(r)
            z[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if (z[free] > 0).all():
                r = z
                break
            bad = free & (z <= 0)
            r += (r[bad] / (r[bad] - z[bad])).min() * (z - r)
            free &= r > 1e-14
            r[~free] = 0
    return ((a @ r - b) ** 2).sum() / 2


@pytest.mark.parametrize("k", [4, 8, 20])
def test_rates_reach_the_nonnegative_optimum(spark, k):
    rng = np.random.default_rng(k)
    skew = np.array([0.014 / (k - 1)] * (k - 1) + [0.986])
    for case, want in enumerate((skew, rng.dirichlet(np.ones(k)), np.eye(k)[0], np.array([0.5, 0.5] + [0.0] * (k - 2)))):
        p = rng.dirichlet(np.full(k, 0.2 if case % 2 else 2.0), 400)       # even posteriors: most targets out of reach
        t = np.floor(rng.lognormal(4, 1, 400))
        t[:5] = 0
        names = [f"p{i}" for i in range(k)]
        rows = spark.createDataFrame([(int(n), *map(float, x)) for n, x in zip(t, p)], "n long, " + ", ".join(f"{c} double" for c in names))
        r = np.maximum(0, 1 - p @ np.array(M.solve(rows, "n", names, want.tolist())))
        share = (p * (t * r)[:, None]).sum(axis=0) / t.sum()
        w = np.maximum((p * t[:, None]).sum(axis=0) / t.sum(), 1e-6)
        got, least = ((share - want) ** 2 / w).sum() / 2, best_squares(t / t.sum(), p, want, w)
        assert got - least < 1.1e-8, (case, got, least)


def test_rates_that_fall_short_are_an_error(spark):
    rows = spark.createDataFrame([(10, 0.7, 0.3), (10, 0.5, 0.5)], "n long, a double, b double")
    with pytest.raises(ArithmeticError):
        M.solve(rows, "n", ["a", "b"], [0.0, 1.0], close=-1.0)
