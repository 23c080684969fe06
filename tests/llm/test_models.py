"""Language ID by held-out accuracy and exact sums; licence scans by planted statements; mixing by a plain version."""

import itertools
import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from emberline.llm import langid, licenses, mixing

from .texts import ROWS, frame

DOCS = "/root/testdata/sf0.01/documents.parquet"


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    e, moves, start = rng.normal(size=(2, 5, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    n = np.array([5, 3])
    got, pairs = langid.forward_backward(e, n, moves, start, pairs=True)
    want_pairs = np.zeros((3, 3))
    for c in range(2):
        total, marg, pair = 0.0, np.zeros((5, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n[c])):
            w = math.exp(start[path[0]] + sum(e[c, t, s] for t, s in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += w
            for t, s in enumerate(path):
                marg[t, s] += w
            for a, b in zip(path, path[1:]):
                pair[a, b] += w
        assert np.allclose(got[c, : n[c]], marg[: n[c]] / total)
        want_pairs += pair / total
    assert np.allclose(pairs, want_pairs)


def plain_chain(e, moves, start):
    """Marginals of one chain, word after word."""
    e, a = np.exp(e - e.max(axis=1, keepdims=True)), np.exp(moves)
    alpha, beta = [e[0] * np.exp(start)], [np.ones(e.shape[1])]
    for x in e[1:]:
        now = (alpha[-1] @ a) * x
        alpha.append(now / now.sum())
    for x in e[:0:-1]:
        now = (x * beta[-1]) @ a.T
        beta.append(now / now.sum())
    both = np.array(alpha) * np.array(beta[::-1])
    return both / both.sum(axis=1, keepdims=True)


def test_a_long_text_is_one_chain():
    rng = np.random.default_rng(4)
    labels, vocab = ["a", "b", "c"], [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    m = langid.Model(labels, rng.normal(size=(langid.BUCKETS, 3)).astype(np.float32) * 0.3, {}, np.zeros((1, 3), np.float32), (rng.normal(size=(3, 3)) * 2 + 3 * np.eye(3)).astype(np.float32), rng.normal(size=3).astype(np.float32))
    texts = [[vocab[i] for i in rng.integers(0, 400, n)] for n in (200, 0, 64, 1, 65, 128, 1000, 63)]
    post, n = langid.Tagger(m).marginals(texts)
    parts = np.split(post, np.cumsum(n)[:-1])
    for own, got in zip(texts, parts):
        assert len(got) == len(own)
        if own:
            assert np.allclose(got, plain_chain(m.emissions(own).astype(float), m.moves.astype(float), m.start.astype(float)), atol=2e-4)


def test_language_of_a_text_is_the_mean_over_its_distinct_words(model):
    rng = np.random.default_rng(2)
    vocab = sorted(model.lexicon)[::7]
    for size in (1, 30, 300):
        own = [vocab[i] for i in rng.integers(0, min(len(vocab), 50), size)]
        p = plain_chain(model.emissions(own).astype(float), model.moves.astype(float), model.start.astype(float))
        mean = np.mean([p[[i for i, w in enumerate(own) if w == kind]].mean(axis=0) for kind in sorted(set(own))], axis=0)
        (lang,), (score,) = langid.Tagger(model).languages([" ".join(own)])
        assert lang == model.labels[int(mean.argmax())] and abs(score - mean.max()) < 1e-3


def test_tagged_words_of_hard_rows(spark, model):
    got = langid.tag_words(frame(spark, ROWS, ("words", "langs", "value")), model)
    assert got.columns == ["doc_id", "words", "langs", "probs"]
    rows = got.collect()
    assert sorted((str(r.doc_id), r.words) for r in rows) == sorted((str(i), langid.words(t)) for i, t, *_ in ROWS)
    assert all(len(r.words) == len(r.langs) == len(r.probs) and all(0 <= p <= 1.0001 for p in r.probs) for r in rows)
    assert langid.tag_words(frame(spark, []), model).count() == 0
    nothing = langid.fit([], [])
    assert [(r.langs, r.probs) for r in langid.tag_words(frame(spark, ROWS[:2]), nothing).collect()] == [([], [])] * 2


def test_grams_touch_word_ends():
    hashes, begins = langid.grams(["ab", "b", "ab"])
    parts = np.split(hashes, begins[1:])
    assert sorted(parts[0]) == sorted(parts[2]) and len(parts[1]) == 3 + 2 + 1 and len(parts[0]) == 4 + 3 + 2 + 1


@pytest.fixture(scope="module")
def model(spark):
    return langid.learn(spark.read.parquet(DOCS))


def test_language_held_out(spark, model):
    docs = spark.read.parquet(DOCS).where(langid.held_out(F.col("doc_id")))
    rows = langid.identify(docs.drop("source"), model).collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_never_sees_labels(spark, model):
    docs = spark.read.parquet(DOCS).limit(50)
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "doc_id": -F.col("doc_id")})
    a = [(r.lang_pred, r.score) for r in langid.identify(docs, model).collect()]
    assert a == [(r.lang_pred, r.score) for r in langid.identify(other, model).collect()]


def test_language_edges(spark, model):
    got = langid.identify(frame(spark, ROWS, ("score", "lang_pred", "value")), model)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "value", "lang_pred", "score"]
    for r in got.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == langid.UNKNOWN) == (not letters) and (letters or r.score == 0)
    assert langid.identify(frame(spark, []), model).count() == 0
    nothing = langid.learn(frame(spark, [(1, "abc", None, None, None)]))
    assert [r.lang_pred for r in langid.identify(frame(spark, ROWS[:1]), nothing).collect()] == [langid.UNKNOWN]


def test_code_switched_words(spark, model):
    by = {r.lang: r.text for r in spark.read.parquet(DOCS).where("length(text) BETWEEN 900 AND 4000").orderBy("doc_id").collect()}
    a, b = langid.words(by["en"])[:40], langid.words(by["de"])[:40]
    row = langid.tag_words(spark.createDataFrame([(1, " ".join(a + b))], "doc_id long, text string"), model).first()
    want = ["en"] * len(a) + ["de"] * len(b)
    assert sum(x == y for x, y in zip(row.langs, want)) / len(want) > 0.9


@pytest.fixture(scope="module")
def scanner(spark):
    return licenses.learn(spark.read.parquet(DOCS))


def test_license_families(spark, scanner):
    planted = {
        "apache-2.0": "Licensed under the Apache License, Version 2.0.", "mit": "Released under the MIT License.", "gpl": "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3.",
        "cc-by-nc": "Licensed under CC BY-NC 4.0.", "cc-by": "Licensed under CC BY 4.0", "mpl-2.0": "Licensed under the Mozilla Public License, version 2.0.",
    }
    noise = "zorp quil vant " * 60
    rows = [(i, f"{noise}\n{text} \nmore words", None, None, None) for i, text in enumerate(planted.values())] + [(50 + i, noise + t + " " + noise, None, None, None) for i, t in enumerate(planted.values())]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, rows), scanner).collect()}
    for i, family in enumerate(planted):
        assert got[i].licences == family and got[i].n_paragraphs == 3 and got[i].hits[0].paragraph == 1, (family, got[i])
        assert got[50 + i].licences == family, (family, got[50 + i])


def test_license_unknown_and_none(spark, scanner):
    rows = [(1, "Distributed under the Sleepycat Public License, version 9.", None, None, None), (2, "The officer asked the driver for the license of the car.", None, None, None), *[(i or 999, t, None, None, None) for i, t, *_ in ROWS if (i or 999) > 2]]
    got = licenses.scan(frame(spark, rows, ("hits", "score")), scanner).collect()
    by = {r.doc_id: r for r in got}
    assert by[1].n_unknown == 1 and by[1].licences == ""
    assert all(r.n_licences == 0 and r.n_unknown == 0 for r in got if r.doc_id != 1)
    assert licenses.scan(frame(spark, []), scanner).count() == 0


def test_license_on_documents(spark, scanner):
    docs = spark.read.parquet(DOCS)
    marks = "Apache License, Version 2.0|MIT License|GNU General Public License|CC BY-NC 4.0"
    truth = {r.doc_id: r.y for r in docs.select("doc_id", F.col("text").rlike(marks).alias("y")).collect()}
    got = {r.doc_id: r.n_licences > 0 for r in licenses.scan(docs, scanner).collect()}
    assert sum(truth[i] == got[i] for i in truth) / len(truth) > 0.995


def spark_hash(i):
    seed = xxhash.xxh64_intdigest((mixing.SEED).to_bytes(4, "little", signed=True), 42)
    return xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), seed) if i is not None else seed


def plain_mix(rows):
    sizes = {}
    for i, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    left, want = 1.5 * sum(sizes.values()), dict.fromkeys(order, 0.0)
    open_ = [s for s in order if sizes[s]]
    while open_:
        unit = left / sum(w[s] for s in open_)
        over = [s for s in open_ if w[s] * unit > 2 * sizes[s]]
        if not over:
            want.update({s: w[s] * unit for s in open_})
            break
        want.update({s: 2.0 * sizes[s] for s in over})
        left -= sum(2.0 * sizes[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    taken = {}
    for s in order:
        whole = int(want[s] // sizes[s]) if sizes[s] else 0
        budget, cells = want[s] - whole * sizes[s], {}
        for i, t, _, src, _ in rows:
            if src == s:
                cells.setdefault(spark_hash(i) >> 16, []).append((i, len((t or "").encode().split())))
        run = 0
        for h in sorted(cells):
            own = sum(n for _, n in cells[h])
            add = budget > 0 and abs(run + own - budget) < abs(run - budget) if run + own > budget else budget > 0
            for i, n in cells[h]:
                taken.setdefault((i, s), []).append(n * (whole + (1 if add and run <= budget else 0)))
            run += own
    return sizes, want, taken


@pytest.mark.parametrize("rows", [ROWS, [(i, "w " * (i % 50 + 1), None, f"s{i % 7 if i % 3 else 0}", 0) for i in range(900)]])
def test_mixing(spark, rows):
    got = mixing.mix(frame(spark, rows, ("size", "h", "target", "s")).withColumnRenamed("n_chars", "prefix")).collect()
    sizes, want, taken = plain_mix(rows)
    by_id = {}
    for r, in [(r,) for r in got]:
        by_id.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.taken <= 2 * r.size
    assert len(got) == len(rows)
    for i, t, _, s, _ in rows:
        match = [r for r in by_id[i] if r.size == len((t or "").encode().split())]
        assert match and all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 for r in match)
        assert sorted(r.taken for r in match) == sorted(taken[i, s]), (i, s)
    assert sorted(map(tuple, mixing.mix(frame(spark, rows)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_mixing_of_many_sources_without_broadcast(spark):
    rows = [(i, "w " * (i % 9 + 1), None, f"s{i % 300}" if i % 3 else "hot", 0) for i in range(1500)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = sorted(map(tuple, mixing.mix(frame(spark, rows)).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = mixing.mix(frame(spark, rows))
        assert sorted(map(tuple, df.collect())) == want and "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sizes, target, _ = plain_mix(rows)
    by_id = {i: s for i, _, _, s, _ in rows}
    assert all(abs(r[3] - target[by_id[r[0]]]) < 1e-6 and r[2] == sizes[by_id[r[0]]] for r in want)


def test_mixing_is_near_its_targets(spark):
    docs = spark.read.parquet(DOCS)
    got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert all(abs(r.taken - r.target) <= r.most / 2 + 1 for r in got)


def test_mixing_edges(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(frame(spark, [(1, None, None, "a", 0), (2, " ", None, None, 0)])).collect()] == [0, 0]
    sources = spark.createDataFrame([("a", 10, 3.0), ("b", 10, 1.0), ("c", 0, 2.0)], "source string, size long, weight double")
    assert [r.target for r in mixing.with_targets(sources).orderBy("source").collect()] == [20.0, 10.0, 0.0]
    full = mixing.with_targets(sources.where("size > 0"), share=5.0)
    assert [r.target for r in full.orderBy("source").collect()] == [20.0, 20.0]
    docs = frame(spark, ROWS, ("copies", "row"))
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns
    often = {(r.doc_id, r.size): r.copies for r in mixing.mix(docs).collect()}
    for (i, size), n in often.items():
        assert kept.where(F.col("doc_id").eqNullSafe(F.lit(i))).count() == sum(1 for r in ROWS if r[0] == i) * n


def test_words_counted_in_bytes(spark):
    import pyarrow as pa

    texts = [None, "", " ", "a", " a\tb\x0bc ", "é\u00a0ü x", "\n\n", "end "]
    want = [0, 0, 0, 1, 3, 2, 0, 1]
    assert mixing.count_words(pa.array(texts, pa.string())).tolist() == want
    assert mixing.count_words(pa.array(["zz z", *texts], pa.string()).slice(1)).tolist() == want


def test_language_needs_a_letter(spark):
    model = langid.fit(["the old house and the river", "la vieille maison et la forêt"], ["en", "fr"])
    docs = spark.createDataFrame([(1, "½ ² Ⅷ 12"), (2, "½ house"), (3, "…")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    assert got[1] == got[3] == (langid.UNKNOWN, 0.0) and got[2][0] == "en"


WRAPPED = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify and merge.",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
    "gpl": " * This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation; either version 2 of the License, or",
    "cc-by": "This work is licensed under a Creative\r\nCommons Attribution 4.0\r\nInternational License.",
}


def test_license_wrapped_over_lines(spark, scanner):
    rows = [(i, f"A heading\n\n{text}\n\nThe end.", None, None, None) for i, text in enumerate(WRAPPED.values())]
    rows += [(50, "Released under the MIT\n\nLicense.", None, None, None), (51, f"{'zorp quil vant ' * 60}\n{WRAPPED['bsd']}", None, None, None)]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, rows), scanner).collect()}
    for i, (family, text) in enumerate(WRAPPED.items()):
        r = got[i]
        assert (r.licences, r.n_licences, r.n_unknown, r.hits[0].paragraph) == (family, 1, 0, 1) and r.n_paragraphs == 3 + text.count("\n"), (family, r)
    assert got[50].licences == "" and got[50].n_paragraphs == 2
    assert got[51].licences == "bsd" and got[51].hits[0].paragraph == 1


def test_license_counter_examples_are_not_wrapped_statements(spark):
    text = "\n\n".join(WRAPPED.values()) + "\n\na plain line\nand one more"
    docs = frame(spark, [(1, text, None, None, None)])
    assert [x for t in [text] for x in licenses.blocks(t)][-1] == ["a plain line", "and one more"]
    r = licenses.scan(docs, licenses.learn(docs)).first()
    assert r.licences == "mit,bsd,gpl,cc-by", r


def plain_chance(m, text):
    """The greatest probability of a licence over the windows of each line, without any gate."""
    base, joined, best = len(m.vocab) + 1, [dict(zip(k.tolist(), w)) for k, w in zip(m.keys, m.weights)], 0.0
    for line in text.split("\n"):
        ids = [m.vocab.get(w, 0) for w in licenses.words(line)]
        for size in licenses.WINDOWS:
            for a in range(0, max(1, len(ids) - size // 2), size // 2):
                own, z = ids[a : a + size], m.bias.copy()
                found = {(n, sum(x * base ** (n - 1 - j) for j, x in enumerate(g))) for n in (1, 2, 3) for i in range(len(own) - n + 1) if all(g := own[i : i + n])}
                hit = [joined[n - 1][k] for n, k in found if k in joined[n - 1]]
                z = z + sum(hit, 0 * z) / math.sqrt(max(8, len(own)))
                either = np.exp(np.array([np.log(np.exp(z[:-1]).sum()), z[-1]]) / m.temperature[0])
                best = max(best, either[0] / either.sum()) if hit else best
    return best


def test_license_scores_every_line(spark, scanner):
    texts = ["MIT License", "BSD License", "License: MIT", "Released under GPL", "the terms of a person and the public software", "zorp quil", f"{'the quil vant ' * 30} license\n\nthe mit gpl license bsd"]
    got = licenses.scan(frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), scanner).collect()
    for r in got:
        assert abs(r.score - plain_chance(scanner, texts[r.doc_id])) < 2e-6, (texts[r.doc_id], r)
    assert max(r.score for r in got if r.doc_id < 2) > 0.001 and got[5].score == 0


def test_license_calibration(scanner):
    for t, gap in zip(scanner.temperature, scanner.reliability):
        assert licenses.TEMPERATURES[0] < t < licenses.TEMPERATURES[-1] and 0 <= gap < 0.25
    # held-out scores that are right three times in four are given that chance
    z, y = np.tile([[4.0, 0.0], [0.0, 4.0]], (400, 1)), np.tile([0, 1], 400)
    wrong = np.arange(800) % 8 < 2
    t, gap = licenses.calibrated(np.where(wrong[:, None], z[:, ::-1], z), y)
    assert abs(1 / (1 + math.exp(-4 / t)) - 0.75) < 0.02 and gap < 0.02


def test_unseen_licenses_are_unknown(spark, scanner):
    texts = ["Distributed under the Sleepycat Public License, version 9.", "Licensed under the Quux Public License, version 1.2.", "This file is released under the terms of the Frobnicate license.", "Use of this software is governed by the Zlib/Vim license agreement."]
    got = licenses.scan(frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), scanner).collect()
    assert all((r.licences, r.n_unknown) == ("", 1) for r in got), got


def test_license_sample_does_not_depend_on_the_order_of_rows(spark):
    docs = spark.read.parquet(DOCS)
    a, b = licenses.learn(docs), licenses.learn(docs.orderBy(F.desc("doc_id")).repartition(5))
    assert a.temperature == b.temperature and all(np.array_equal(x, y) for x, y in zip(a.weights, b.weights))


def test_license_families_of_one_line(spark, scanner):
    noise = "zorp quil vant " * 60
    a, m, g = "Licensed under the Apache License, Version 2.0", "released under the MIT License", "released under the GNU General Public License version 2 or later"
    rows = [f"{a}, or {m}.", f"{a}. {noise} {m}. {noise} {g}. {noise} {m}.", f"{noise} {m} or {g}", f"{a}\n{m}\n{a} or {g}", "Licensed under CC BY-NC 4.0 or released under the BSD license."]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, [(i, t, None, None, None) for i, t in enumerate(rows)]), scanner).collect()}
    want = [{"apache-2.0", "mit"}, {"apache-2.0", "mit", "gpl"}, {"mit", "gpl"}, {"apache-2.0", "mit", "gpl"}, {"cc-by-nc", "bsd"}]
    for i, families in enumerate(want):
        r = got[i]
        assert set(r.licences.split(",")) == families and r.n_unknown == 0, r
        assert r.n_licences == len(r.hits) == (4 if i == 3 else len(families)) and all(h.similarity >= licenses.CONFIRMED for h in r.hits)
    assert [(h.paragraph, h.family) for h in got[3].hits][:2] == [(0, "apache-2.0"), (1, "mit")]
