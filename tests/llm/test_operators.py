"""The ten operators against brute force on small tables, with their edge cases."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from math import log10
from zlib import crc32

import numpy as np
import pytest

import corpus_pipeline
from glebe.llm import decontaminate, hmm, html, language, licences, mixing, near, privacy, quality, urls
from glebe.llm.queries import ORACLES, QUERIES
from tests.compare import ROOT, difference, duck

SF = f"{ROOT}/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, bands string, print string"
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
ROWS = [
    (1, None, None, None, None, "a", "b", "c"),
    (2, "", "en", "s", 0, "a", "b", "c"),
    (3, "   \n\t ", "en", "s", 6, None, None, None),
    (4, "one two three four five six seven", "en", None, 33, "a", "b", "c"),
    (4, "one two three four five six seven", "en", None, 33, "a", "b", "c"),
    (5, LONG, None, "t", len(LONG), "a", "b", "c"),
    (None, "ONE two three four five six seven", "en", "t", 33, "a", "b", "c"),
    (7, "mail x@y.zz and 1.2.3.4 please", "de", "t", 30, "a", "b", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    rel = duck(SF).sql(ORACLES[name])
    df = QUERIES[name](spark, SF)
    assert difference(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall()) is None


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_empty_tables(spark, odd, stage):
    out = stage(spark, odd, SF)
    assert out.columns == odd.columns
    assert out.dtypes == odd.dtypes
    assert {r["doc_id"] for r in out.collect()} <= {r[0] for r in ROWS}
    assert stage(spark, odd.limit(0), SF).count() == 0


def test_near_copies_equal_brute_force(spark, docs):
    found = {r["id"]: r["class"] for r in near.NearCopies(spark.read.parquet(f"{SF}/documents.parquet")).classes().collect()}
    bags = {}
    for r in docs:
        w = spaced(lower(r.text))
        bags[r.doc_id] = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None
    parent = {i: i for i in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(bags)
    for i in ids:
        for j in ids:
            if i < j and bags[i] and bags[j]:
                both = sum((bags[i] & bags[j]).values())
                if both >= 0.8 * sum((bags[i] | bags[j]).values()):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    assert found == {i: root(i) for i in ids}


def test_near_copies_of_odd_rows(odd):
    kept = near.deduplicate(odd)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.collect()) in (
        [(False, 0), (True, 1), (True, 2), (True, 3), (True, 5), (True, 7)], [(True, 1), (True, 2), (True, 3), (True, 4), (True, 5), (True, 7)])


def test_bag_minhash_is_unbiased():
    a = {k: 1 + k % 7 for k in range(400)}
    b = {k: 1 + (k * 3) % 7 for k in range(100, 500)}
    both = sum(min(a.get(k, 0), b.get(k, 0)) for k in {*a, *b}) / sum(max(a.get(k, 0), b.get(k, 0)) for k in {*a, *b})
    row = np.repeat([0, 1], [len(a), len(b)])
    value = np.array([*a, *b], np.uint64)
    sign = near.bag_minhash(row, value, np.array([*a.values(), *b.values()]), 2, 4096)
    assert abs((sign[0] == sign[1]).mean() - both) < 0.03


def test_cascade_order_does_not_change_verdicts(odd):
    forward, n = quality.judge(odd, rules=quality.RULES)
    backward, _ = quality.judge(odd, rules=quality.RULES[::-1])
    kept = [sorted(str(r["doc_id"]) for r in d.collect() if r[n[0]] is None) for d in (forward, backward)]
    assert kept[0] == kept[1] == ["5"]


def test_mix_meets_targets(spark):
    out = QUERIES["op3_mix_sources"](spark, f"{ROOT}/sf0.01").toPandas()
    assert (out.taken <= 2 * out["size"]).all()
    by = out.groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"))
    assert (abs(by.taken / by.target - 1) < 0.02).all()
    again = QUERIES["op3_mix_sources"](spark, f"{ROOT}/sf0.01").toPandas()
    assert out.sort_values("doc_id").values.tolist() == again.sort_values("doc_id").values.tolist()


def test_base_spans_equal_patterns(spark, docs):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d))) % 10 == 0

    def base(t):
        out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) < 256 for x in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            d = re.sub("[^0-9]", "", m[0])
            out += [(m.start(), 2, m.end())] * (14 <= len(d) <= 19 and luhn(d))
        out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        return ",".join(f"{privacy.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))

    texts = [r.text for r in docs] + [
        "a@b.c_d@e.f x", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "4111 1111 1111 1111- 2 --4111-1111-1111-1111", "é\U0001d4b3 x@y.zz 4111111111111111",
        "1 " * 5000, "7" * 100_000, "a" * 50_000 + "@", "+1 (434) 555-2368 +1-2", "", "..@x.y 1.1.1.1.1.1.1.1",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(privacy.digest(privacy.base_spans(df.t))).collect()] == [base(t) for t in texts]


def test_terms_that_reveal_an_entity(spark):
    rows = [(i, f"call zorblax now{i} at x@y.zz thanks {'please ' * i}") for i in range(6)] + [(i, f"plain words number {i} thanks call at please") for i in range(6, 400)]
    found, (_, terms) = privacy.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    seen = {r["doc_id"]: [s["value"] for s in r[terms]] for r in found.collect()}
    assert all(seen[i] == ["zorblax"] for i in range(6)) and all(not seen[i] for i in range(6, 400))
    cleaned = privacy.sanitize(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id = 0").first()["text"]
    assert cleaned == "call <TERM> now0 at <EMAIL> thanks "


def test_rare_words_beside_an_entity_stay(spark):
    lone = "quaint umbrellas fold sideways mail x@y.zz beneath marble"
    rows = [(0, lone), (1, lone), (2, lone), (3, lone), (4, "odd bob@y.zz lanterns"), (5, "bob@y.zz lanterns glow")]
    rows += [(i, f"plain words {i}") for i in range(6, 300)]
    found, (_, terms) = privacy.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert not any(r[terms] for r in found.collect())


def test_disclosing_terms_equal_brute_force(spark):
    import random

    rng = random.Random(4)
    names = [f"name{c}" for c in "abcdefgh"]
    texts = [f"{' '.join(rng.choice(['red', 'green', 'blue', 'grey', 'pink']) for _ in range(rng.randrange(9)))} number{'x' * (i % 50)}" for i in range(500)]
    for k, name in enumerate(names):
        for i in rng.sample(range(500), 3 * k + 1):
            texts[i] += f" {name if rng.random() < 0.9 else ''} {name}@mail.org"
    texts += texts[:40]
    plain = set(texts)
    held = {}
    for t in plain:
        for e in re.findall(r"\S+@\S+", t):
            held.setdefault("0:" + e, set()).add(t)
    words = {t: set(re.findall("[a-z]+", re.sub(r"\S+@\S+", " ", t))) for t in plain}
    count = Counter(w for t in plain for w in set(re.findall("[a-z]+", t)))
    want = set()
    for e, inside in held.items():
        for w in set().union(*(words[t] for t in inside)):
            both = sum(w in words[t] for t in inside)
            least = both - 1.5 * both**0.5
            if least > 0 and np.log(least * len(plain) / (len(inside) * count[w])) / -np.log(both / len(plain)) >= 0.75:
                want.add((e, w))
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = privacy.disclosing(docs.withColumn("spans", privacy.base_spans(docs.text)), "text", "spans")
    assert {(r["entity"], r["term"]) for r in got.collect()} == want and len(want) >= 5


def test_language_is_learned(spark):
    found = QUERIES["op4_language_id"](spark, f"{ROOT}/sf0.01").toPandas()
    true = spark.read.parquet(f"{ROOT}/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    held = found.merge(true).query("held_out")
    assert (held.lang == held.lang_pred).mean() > 0.98 and found.score.between(0, 1).all()
    model = language.LanguageModel(["a"], np.ones((1, language.SLOTS)), np.ones(1))
    assert model.predict(None) == model.predict("12 34 !") == ("und", 0.0)


def test_rare_language_wins_with_short_texts():
    text = "zwq zwq zwq zwq zwq"
    counts = np.full((2, language.SLOTS), 100.0)
    for piece in language.slots(text):
        counts[1][piece] *= 2
    model = language.LanguageModel(["big", "rare"], counts, np.array([9999.0, 1.0]))
    lang, score = model.predict(text)
    sums = sum(model.matrix[piece].sum(axis=0) for piece in language.slots(text)) + model.prior
    assert sums[1] > sums[0] and lang == "rare" and 0.5 < score < 1


def test_urls(spark):
    assert urls.split_url("HTTP://A.Example.NET/en/x?q#f") == ("a.example.net", "/en/x")
    assert urls.split_url("no scheme") == ("", "") and urls.split_url("x://h?q/p") == ("h", "")
    df = spark.createDataFrame([(u,) for u in ("HTTP://A.Example.NET/en/x?q#f", None, "no", "x://h?q/p", "a://b://c/d")], "u string")
    h, p = urls.host_and_path(df.u)
    assert [tuple(r) for r in df.select(h, p).collect()] == [("a.example.net", "/en/x"), ("", ""), ("", ""), ("h", ""), ("b:", "//c/d")]
    rules = urls.Rules([("block", "net/"), ("allow", "example.net/en/")])
    assert rules.find("a.example.net", "/en/x")[1] == "allow" and rules.find("a.example.net", "/de/")[1] == "block" and rules.find("x.net", "") == (None, None)
    model = urls.UrlModel([*urls.BLOCKED, *urls.ALLOWED], [1] * len(urls.BLOCKED) + [0] * len(urls.ALLOWED))
    assert model.score("www.casino-win.example.org", "/en/14") > 0.5 > model.score("blog.tiontion.example.com", "/en/853")


def test_main_text():
    page = ('<body><header>Top</header><div class="cookie-notice">We use cookies</div><div id="main"><h1>T &amp; x</h1><p>Long  text here\n'
            'of the article which goes on and on.<p>Short.<ul><li>one<li>two</ul></div><div class="comments"><p>nice</p></div><footer>f</footer>')
    assert html.main_text(page).split("\n\n") == ["T & x", "Long text here of the article which goes on and on.", "Short.", "one", "two"]
    assert html.main_text(None) == html.main_text("<nav>x</nav>") == ""


def test_main_text_is_whole():
    long, short = "Many words without any tag in them. " * 17, "A short paragraph."
    section = f"<section><p>{long}</p><p>{long}</p></section>"
    rest = f"<h1>Title</h1><p>{short}</p><p>{short}</p>"
    want = ["Title", short, short, long.strip(), long.strip(), "End."]
    for page in (
        f"<body><nav>Menu</nav><article>{rest}{section}<section><p>End.</p></section></article></body>",
        f"<body><div><a href=x>Menu</a></div><div>{rest}{section}<section><p>End.</p></section></div></body>",
        f"<body><div class='layout has-sidebar with-comments'><div class='sidebar'>Side</div><div>{rest}{section}<p>End.</p></div></div></body>",
        f"<html><head><title>t</title><meta charset=utf-8><body><main>{rest}{section}<p>End.</p></main></body>",
    ):
        assert html.main_text(page).split("\n\n") == want


def test_main_text_of_wrapped_pages():
    said = "Many words without any tag in them. " * 12
    body = f"<h1>Title</h1><p>{said}</p><p>Short one.</p><p>{said}</p>"
    want = ["Title", said.strip(), "Short one.", said.strip()]
    reader = f"<p>{said}</p>" * 6
    for page in (
        f"<body><nav>Menu</nav><form action=x>{body}<input name=y></form></body>",
        f"<body><div class='widget'>{body}</div></body>",
        f"<body><div id=header>Top</div><dialog open>{body}</dialog></body>",
        f"<body><form><div class='comments'>{reader}</div>{body}</form></body>",
        f"<body><article>{body}</article><div class='user-comments'>{reader}</div></body>",
        f"<body><div>{body}</div><div class='comments'>{reader}</div></body>",
        f"<body><div>{body}</div><form><p>Your name and your address, please.</p><button>Send now</button></form></body>",
    ):
        assert html.main_text(page).split("\n\n") == want, page[:60]
    two = f"<body><main><article><h2>A</h2><p>{said}</p></article><article><h2>B</h2><p>{said}</p></article></main></body>"
    assert html.main_text(two).split("\n\n") == ["A", said.strip(), "B", said.strip()]
    assert html.main_text(f"<body><div class=comments><p>{said}</p></div></body>") == said.strip()


def test_deep_pages_take_linear_time():
    import time

    took = []
    for n in (20_000, 100_000):
        for tag in ("font", "div", "ul><li"):
            began = time.process_time()
            assert html.main_text(f"<{tag}>word and more " * n).startswith("word and more")
            took.append(time.process_time() - began)
    assert max(took[3:]) < 12 * max(took[:3]) and max(took) < 30


def test_licences(spark, odd):
    model = licences.train(odd)
    rows = [(1, "text\nReleased under the MIT License.\nAll rights reserved."), (2, "All rights are fine"), (3, None)]
    found, (n, families, lines, _) = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), model)
    assert {r["doc_id"]: (r[n], r[families], r[lines]) for r in found.collect()} == {1: (2, ["mit", "proprietary"], [1, 2]), 2: (0, [], []), 3: (0, [], [])}


def test_wrapped_and_several_licences(spark, odd):
    texts = {
        "gpl-3.0": "# x\n#\n# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n",
        "bsd-3-clause": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:\n",
        "mit": "// Permission is hereby granted, free of charge, to any person\n// obtaining a copy of this software and associated\n// documentation files (the \"Software\")",
        "apache-2.0,mit": "SPDX-License-Identifier: MIT OR Apache-2.0",
        "isc,mpl-2.0": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "cc-by-sa-4.0": "Text.\nLicensed under CC BY-SA 4.0.\nmore", "cc-by-4.0": "This work is licensed under a Creative Commons\nAttribution 4.0 International License.",
        "": "you can modify the terms of this work\nwith or without fee, to any person",
    }
    df = spark.createDataFrame([(f, t) for f, t in texts.items()], "want string, text string")
    found, (n, families, lines, _) = licences.scan(df, licences.train(odd))
    got = {r["want"]: r for r in found.collect()}
    assert {k: ",".join(r[families]) for k, r in got.items()} == {k: k for k in texts}
    assert got["gpl-3.0"][n] == 1 and got["gpl-3.0"][lines] == [2] and got["cc-by-sa-4.0"][lines] == [1]


def test_partial_containment(spark):
    words = [f"w{i}" for i in range(10)]
    docs = spark.createDataFrame([(1, " ".join(["a", *words[:4], "zz", *words[5:], "b"])), (2, "w0 w1 w2")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(words)), (6, None)], "item_id long, text string")
    part, (_, _, items) = decontaminate.search(docs, bench, containment=0.9)
    whole, _ = decontaminate.search(docs, bench, block_words=1)
    assert {r["doc_id"]: r[items] for r in part.collect()} == {1: ["5"], 2: []}
    assert all(not r[items] for r in whole.collect())


def test_scores_equal_brute_force(spark, docs):
    out = {r["doc_id"]: r for r in QUERIES["op10_lm_score"](spark, SF).collect()}
    tokens = {r.doc_id: [*spaced(lower(r.text)), "\n"] for r in docs}
    count = Counter(w for i, ws in tokens.items() if crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        assert (out[i]["n_tokens"], out[i]["n_known"], out[i]["train_tokens"]) == (len(ws), sum(count[w] > 0 for w in ws), n)
        assert out[i]["base_score"] == pytest.approx(sum(log10((count[w] + 1) / (n + v + 1)) for w in ws))
    held = [r for r in out.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_blocks_and_shards_do_not_matter(spark, monkeypatch):
    rows = [(i, " ".join(f"a{(i * 7 + j) % 40} b{(i * 5 + j) % 40}" for j in range(100))) for i in range(12)] + [(12, "a1 b2 never"), (13, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for block, long in ((1 << 20, 1 << 16), (700, 64)):
        monkeypatch.setattr(hmm, "BLOCK", block)
        monkeypatch.setattr(hmm, "LONG", long)
        out, names, *_ = hmm.score(docs, docs.doc_id < 10)
        found.append({r["doc_id"]: [r[n] for n in names] for r in out.collect()})
    a = found[0]
    assert a.keys() == set(range(14)) and a[10][3] > a[10][2] + 20
    for b in found[1:]:
        for i in a:
            assert a[i] == pytest.approx(b[i], rel=1e-4)


def test_forward_sums_all_paths():
    rng = np.random.default_rng(1)
    move, emit, first = rng.dirichlet(np.ones(2), 2), rng.dirichlet(np.ones(3), 2).T, np.array([0.3, 0.7])
    m = hmm.Model(first, move, emit)
    ids = np.array([0, 2, 1, 1])
    total = 0.0
    for path in np.ndindex(2, 2, 2, 2):
        p = first[path[0]] * emit[ids[0], path[0]]
        for t in range(1, 4):
            p *= move[path[t - 1], path[t]] * emit[ids[t], path[t]]
        total += p
    assert hmm.forward(ids, np.array([0]), np.array([4]), m)[0] == pytest.approx(log10(total))


def every_path(ids, m):
    """Expected first states, moves and emissions, over all paths of states."""
    s, weight, total = len(m.first), [np.zeros(len(m.first)), np.zeros_like(m.move), np.zeros_like(m.emit)], 0.0
    for path in np.ndindex(*[s] * len(ids)):
        p = m.first[path[0]] * np.prod([m.emit[i, q] for i, q in zip(ids, path)]) * np.prod([m.move[a, b] for a, b in zip(path, path[1:])])
        total += p
        weight[0][path[0]] += p
        for a, b in zip(path, path[1:]):
            weight[1][a, b] += p
        for i, q in zip(ids, path):
            weight[2][i, q] += p
    return [w / total for w in weight]


def test_expected_counts_sum_all_paths():
    rng = np.random.default_rng(3)
    m = hmm.Model(np.array([0.5, 0.2, 0.3]), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(4), 3).T)
    texts = [[0, 1, 3, 2, 1, 0, 0], [2, 2, 1], [3]]
    want = [sum(x) for x in zip(*(every_path(t, m) for t in texts))]
    for got, w in zip(hmm.expected(np.concatenate(texts), np.array([0, 7, 10]), np.array([7, 3, 1]), m), want):
        assert got == pytest.approx(w)
    for every in (1, 2, 3, 7, 100):
        for t in texts:
            for got, w in zip(hmm.expected_long(np.array(t), m, every), every_path(t, m)):
                assert got == pytest.approx(w)


def test_packed_numbers():
    ids = np.array([0, 5, 65534, 65535, 65536, 1 << 30, 7])
    assert hmm.unpacked(hmm.packed(ids)).tolist() == ids.tolist() and hmm.unpacked(hmm.packed(ids[:0])).size == 0


def test_training_likelihood_does_not_fall(spark, monkeypatch):
    monkeypatch.setattr(hmm, "BLOCK", 3000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).repartition(3)
    scores = []
    for passes in (0, 1, 3):
        found, names, *_ = hmm.score(docs, docs.doc_id.isNotNull(), passes=passes)
        scores.append(sum(r[names[3]] for r in found.collect()))
    assert scores[0] < scores[1] < scores[2]


def test_scores_of_odd_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(hmm, "LONG", 1000)
    for training in (odd.doc_id != 7, odd.doc_id < 0):
        found, names, vocab, _ = hmm.score(odd.withColumn("score", odd.lang), training)
        got = found.collect()
        assert found.columns == [c for c in odd.columns if c != "text"] + ["score", *names] and len(got) == len(ROWS)
        assert sorted(r[names[0]] for r in got) == sorted(len(spaced(r[1])) + 1 for r in ROWS)
        assert all(np.isfinite(r[names[3]]) and r[names[3]] <= 1e-9 for r in got)
    assert hmm.score(odd.limit(0), odd.doc_id > 0)[0].count() == 0


def test_digests_are_of_item_lists(spark):
    row = QUERIES["op8_decontaminate"](spark, SF).filter("n_items = 0").first()
    assert row["items_sha256"] == hashlib.sha256(b"").hexdigest()
