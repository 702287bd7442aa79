import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordspace.llm import fingerprints, license_texts, licenses, quality, topk

from .conftest import words

VEC = "vec_id long, embedding array<float>, label int, rank string, ib string"


def brute_top(rows, k, queries):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in {i: v for i, v in usable if queries(i)}.items():
        scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in usable if i != q and len(v) == len(qv))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_is_exact(ready, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)], 0, "x", "x") for i in range(700)]
    rows += [(700 + i, rows[0][1], 0, "x", "x") for i in range(40)]  # ties
    rows += [(900, None, 0, "x", "x"), (901, [float("nan")] * 8, 0, "x", "x"), (902, [None] * 8, 0, "x", "x"), (903, [], 0, "x", "x"), (904, [1.0], 0, "x", "x"), (None, [0.1] * 8, 0, "x", "x"), (950, [0.0] * 8, 0, "x", "x"), (5, rows[5][1], 0, "x", "x")]
    df = ready.createDataFrame(rows, VEC)
    monkeypatch.setattr(topk, "BLOCK", 100)
    got = sorted(tuple(r) for r in topk.top_k(df, df.filter("vec_id % 50 = 0"), 5).collect())
    assert got == brute_top(rows, 5, lambda i: i % 50 == 0)
    assert topk.top_k(df.limit(0), df.limit(0), 5).count() == 0
    few = ready.createDataFrame(rows[:3], VEC)
    assert topk.top_k(few, few.filter("vec_id = 0"), 5).count() == 2


def test_a_query_id_with_several_vectors_asks_with_the_least(ready):
    rows = [(i, [0.1 * i, 1.0 - 0.1 * i], 0, "x", "x") for i in range(1, 8)]
    twice = [(50, [0.5, -0.5], 0, "x", "x"), (50, [-0.5, 0.5], 0, "x", "x"), (50, [-0.5, 0.25], 0, "x", "x")]
    want = brute_top([*rows, (50, [-0.5, 0.25], 0, "x", "x")], 5, lambda i: i == 50)
    for order in (twice, twice[::-1]):
        df = ready.createDataFrame(rows + order, VEC).repartition(4)
        got = sorted(tuple(r) for r in topk.top_k(df, df.filter("vec_id = 50"), 5).collect())
        assert got == want


def test_index_processes_segments_in_impact_order_and_is_exact():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-90, 90, (3000, 16))
    index = topk.ImpactIndex(np.arange(3000), vectors)
    for q in rng.integers(-90, 90, (20, 16)):
        at, score = index.search(q, 5, -1)
        exact = vectors @ q
        assert at.tolist() == np.lexsort((np.arange(3000), -exact))[:5].tolist() and (score == exact[at]).all()


def test_index_has_no_limit_but_that_of_the_scores():
    rng = np.random.default_rng(1)
    for high, dims in ((90, 5000), (1 << 18, 64), (1 << 24, 8), (1 << 29, 8)):
        vectors, q = rng.integers(-high, high, (300, dims)), rng.integers(-high, high, dims)
        exact = [sum(int(a) * int(b) for a, b in zip(v, q, strict=True)) for v in vectors]
        at, score = topk.ImpactIndex(np.arange(300), vectors).search(q, 5, -1)
        best = sorted(range(300), key=lambda i: (-exact[i], i))[:5]
        assert at.tolist() == best and score.tolist() == [exact[i] for i in best]
    with pytest.raises(OverflowError):
        topk.ImpactIndex(np.arange(2), np.full((2, 4), 1 << 40)).search(np.full(4, 1 << 40), 1, -1)


def simhash_brute(spark, text):
    """Votes of the same term hashes, counted one by one."""
    row = fingerprints.term_hashes(spark.createDataFrame([(text or "",)], "t string"), "t").selectExpr("transform(terms, x -> struct(x AS a, xxhash64(x, 1) AS b)) AS h").first()["h"]
    out = []
    for part in ("a", "b"):
        bits = sum(1 << b for b in range(64) if 2 * sum((x[part] >> b) & 1 for x in row) > len(row))
        out.append(f"{bits:016x}")
    return "".join(out)


def test_fingerprints_of_texts_and_edits(ready, docs_of):
    rows = [(i, words(i, 30 + i, 500)) for i in range(0, 40, 2)] + [(101, None), (102, ""), (103, "é ö ü"), (104, words(4, 34, 500)), (None, "no id at all here"), (2, words(99, 70, 500))]
    df = docs_of(rows, extra=True)
    got = fingerprints.edited_fingerprints(df).collect()
    assert len(got) == len(rows)
    order = sorted(range(len(rows)), key=lambda i: -(rows[i][0] if rows[i][0] is not None else -(1 << 63)))
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    unique = [i for i in order if sum(rows[j][0] == rows[i][0] for j in order) == 1]
    for at, i in enumerate(order):
        after = order[(at + 1) % len(order)]
        if i not in unique or after not in unique:
            continue
        k, text = rows[i][0], rows[i][1] or ""
        third, follow = len(text) // 3, rows[after][1] or ""
        edited = text[: len(text) - third] + follow[:third]
        (r,) = by[k]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if at % 5 == 0:
            a, b, c = (simhash_brute(ready, t) for t in (text, edited, follow))
            same = lambda x, y: 1 - bin(int(x, 16) ^ int(y, 16)).count("1") / 128
            assert (r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) == (a, b, same(a, b), same(a, c))
    assert by[4][0].fingerprint == by[104][0].fingerprint  # equal texts
    assert by[101][0].fingerprint == "0" * 32 == by[102][0].fingerprint
    assert fingerprints.edited_fingerprints(docs_of([])).count() == 0
    (alone,) = fingerprints.edited_fingerprints(docs_of([(1, "one two three four five six")])).collect()
    assert alone.near_next == 1.0


def test_long_text_does_not_overflow(ready, monkeypatch):
    monkeypatch.setattr(fingerprints, "STRETCH", 7)
    df = ready.createDataFrame([(1, words(3, 400, 90))], "doc_id long, text string")
    (r,) = fingerprints.simhash(df, ["doc_id"]).select(fingerprints.hex_of("hi", "lo").alias("f")).collect()
    assert r.f == simhash_brute(ready, words(3, 400, 90))


def test_near_pairs_equal_brute_force(ready):
    rng = random.Random(8)
    base = [rng.getrandbits(128) for _ in range(6)]
    prints = [b ^ sum(1 << rng.randrange(128) for _ in range(rng.randint(0, 4))) for b in base for _ in range(12)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = ready.createDataFrame([(i, signed(p >> 64), signed(p & (1 << 64) - 1)) for i, p in enumerate(prints)] + [(999, None, None)], "doc_id long, hi long, lo long")
    pairs, members = fingerprints.near_pairs(df, 3)
    classes = {}
    for i, p in enumerate(prints):
        classes.setdefault(p, i)
    want = {(min(a, b), max(a, b), d) for (p, a), (q, b) in itertools.combinations(classes.items(), 2) if (d := bin(p ^ q).count("1")) <= 3}
    assert {tuple(r) for r in pairs.collect()} == want
    assert {tuple(r) for r in members.collect()} == {(i, classes[p]) for i, p in enumerate(prints)}


def test_licences(ready, docs_of):
    mit = licenses.KNOWN[0][1]
    rows = [
        (1, "Copyright (c) 2020 Someone\n\n" + mit.upper()), (2, "Some words\nreleased under  the MIT licence!\nmore"), (3, "Licensed under CC BY-NC 4.0.\n\nLicensed under the Apache License, Version 2.0"),
        (4, None), (5, ""), (6, "Released under the MIT License. And more"), (2, "Some words\nreleased under  the MIT licence!\nmore"), (None, "Licensed under CC0 1.0"), (7, "(c) 2001 me\n© you"),
    ]
    got = licenses.scan(docs_of(rows, extra=True)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].license == "MIT" and by[2].license is None and by[2].notices == "MIT"
    assert by[3].notices == "Apache-2.0,CC-BY-NC-4.0" and by[3].n_notices == 2
    assert by[6].notices == "" and by[None].license == "CC0-1.0"
    assert by[4].text_digest == by[5].text_digest == by[7].text_digest == hashlib.sha256(b"").hexdigest() and by[4].license is None
    assert licenses.scan(docs_of([])).count() == 0


def test_whole_licenses_and_those_inside_documents(docs_of):
    files = dict(license_texts.whole_texts()[::-1])
    isc, bsd = (next(t for k, t in licenses.KNOWN if k == x) for x in ("ISC", "BSD-3-Clause"))
    flat = "\n".join(x for x in bsd.split("\n") if x)  # other paragraphs, the same lines
    rows = [
        *enumerate(license_texts.FILES),
        (20, "# Tool\n\nSome words.\n\n## License\n\nCopyright (c) 2020 Someone\n\n" + licenses.KNOWN[0][1] + "\n\nMore words.\n\nThe end."),
        (21, "/*\n * " + isc.replace("\n", "\n * ") + "\n */\nint x;\n" + flat + "\nint y;"),
        (22, "words\n" + files["GPL-3.0-only"] + "\nReleased under the MIT License.\n" + files["CC0-1.0"].replace("\n\n", "\n")),
        (23, licenses.KNOWN[0][1].replace("sublicense", "lend") + "\n\nLicensed under CC BY 4.0. And more"),
        (24, "gnu general public license\n" * 500),
    ]
    rows = [(i, files[t] if i < 20 else t) for i, t in rows]
    by = {r.doc_id: r for r in licenses.scan(docs_of(rows)).collect()}
    for i, name in enumerate(license_texts.FILES):
        assert by[i].license == name and name in by[i].notices.split(",")
    assert by[20].notices == "MIT" and by[20].license is None and by[21].notices == "BSD-3-Clause,ISC"
    assert by[22].notices == "CC0-1.0,GPL-3.0-only,MIT" and by[23].notices == by[24].notices == ""


def test_only_copyright_statements_are_left_out(docs_of):
    long = "Copyright 2020 " + "word " * 80 + "end. More"
    rows = [
        ("Copyright 2020 X. Licensed under the MIT License.", "Licensed under the MIT License."), ("All rights reserved. Released under the MIT License.", "Released under the MIT License."),
        ("© 2020 X | Licensed under CC BY 4.0.", "Licensed under CC BY 4.0."), ("(c) 2020 me. (c) 2021 you. Text goes on. And on", "Text goes on. And on"),
        ("copyright (c) 2020 Foo Inc. See LICENSE", "See LICENSE"), ("All rights reserved. all rights reserved. " * 20_000 + "words", "words"),
        ("  (c) You must retain notices", "c you must retain notices"), (long, long.replace(".", "")), ("All rights reserved to nobody here", "all rights reserved to nobody here"),
        ("Copyright (c) 2015-2020 John Q. Public", ""), ("# Copyright (C) 2007 Acme, Inc. and others <https://a.b/>", ""), ("/* Copyright © Acme, Inc. All rights reserved. */", ""), ("All rights reserved.", ""),
    ]
    got = {r.doc_id: r for r in licenses.scan(docs_of([x for i, (a, b) in enumerate(rows) for x in ((2 * i, a), (2 * i + 1, b))])).collect()}
    assert [i for i in range(len(rows)) if got[2 * i].text_digest != got[2 * i + 1].text_digest] == []
    assert [got[2 * i].license for i in range(4)] == ["MIT", "MIT", "CC-BY-4.0", None] and got[24].text_digest == hashlib.sha256(b"").hexdigest()


def corpus(n):
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = words(i, 60, 300)
        rows.append((i, text.replace(" ", "%%% ") + " $$$" if bad else text + "."))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_quality_held_out(ready, docs_of):
    rows, labels = corpus(300)
    docs = docs_of(rows + [(1000, None), (1001, ""), (5, rows[5][1]), (None, "plain words here.")], extra=True)
    known = ready.createDataFrame([x for x in labels if x[0] % 3] + [(None, 1, 0), (2, None, 0), (77777, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, known)
    scored = quality.classify(ready, docs, model)
    assert scored.columns == [*docs.columns, *quality.COLUMNS] and scored.count() == 304
    kept = {r.doc_id for r in quality.keep(scored).collect()}
    held = [i for i, *_ in labels if i % 3 == 0]
    assert all((i in kept) == (i % 5 != 0) for i in held)
    assert quality.classify(ready, docs_of([]), model).count() == 0
    no_labels = quality.fit(docs, known.limit(0))
    assert no_labels == quality.NO_MODEL and quality.keep(quality.classify(ready, docs, no_labels)).count() == 304


def test_sites_shrink_toward_priors(ready):
    good, bad = "Plain words in a row here.", "### $$$ %%% @@@ ### $$$"
    rows = [(i, good if i % 10 else bad, "big") for i in range(200)] + [(300 + i, bad, "spam") for i in range(100)] + [(500, bad, "tiny")]
    df = ready.createDataFrame([(k, t, "en", s) for k, t, s in rows], "doc_id long, text string, lang string, source string")
    labels = ready.createDataFrame([(k, int(t == good), 0) for k, t, _ in rows[::2]], "doc_id long, quality int, toxic int")
    out = quality.classify(ready, df, quality.fit(df, labels))
    mean = {r.source: r.m for r in out.groupBy("source").agg(F.max("_qc_path_mean").alias("m")).collect()}
    assert mean["spam"] < mean["tiny"] < mean["big"]


def test_posteriors_by_hand(ready, docs_of):
    """Hosts, paths, pulls and posteriors computed anew, document by document."""
    import math
    from collections import defaultdict

    rng = np.random.default_rng(4)
    rows = []
    for i in range(160):
        host, lang = f"h{min(rng.integers(0, 6), rng.integers(0, 6))}", ["en", "de", None][rng.integers(0, 3)]
        bad = rng.random() < (0.9 if host == "h1" else 0.2)
        rows.append((i, " ".join(f"word{k}" + ("%%%" if bad else "") for k in range(int(rng.integers(3, 30)))), lang, host if i % 11 else None, bad))
    df = ready.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string").selectExpr("*", "'x' AS _qc_host", "1 AS _QC_good", "2 AS n", "3 AS _qc_logit")
    labels = ready.createDataFrame([(r[0], int(not r[4]), 0) for r in rows[::3]] + [(0, 1, 0), (0, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(df, labels)
    got = {r.doc_id: r for r in quality.classify(ready, df, model).collect()}
    assert all(r._qc_host == "x" and r["_QC_good"] == 1 and r.n == 2 for r in got.values())
    good = {i: math.floor(1e6 / (1 + math.exp(-r._qc_logit)) + 0.5) / 1e6 for i, r in got.items()}
    site = {r[0]: (r[3] or "", r[2] or "") for r in rows}
    hosts, paths = defaultdict(list), defaultdict(list)
    for i, (h, p) in site.items():
        hosts[h].append(good[i])
        paths[h, p].append(good[i])
    overall = sum(good.values()) / len(good)

    def pull(groups, prior):
        n = {g: len(v) for g, v in groups.items()}
        total = sum(n.values())
        mean = sum(n[g] * prior[g] for g in groups) / total
        ss = sum(n[g] * (sum(v) / n[g] - prior[g]) ** 2 for g, v in groups.items())
        spread = (ss - (len(n) - 1) * mean * (1 - mean)) / (total - sum(x * x for x in n.values()) / total)
        return min(max(mean * (1 - mean) / spread - 1, 1.0), 1e6) if spread > 0 else 1e6

    k_host = pull(hosts, dict.fromkeys(hosts, overall))
    mean = {h: (sum(v) + k_host * overall) / (len(v) + k_host) for h, v in hosts.items()}
    k_path = pull(paths, {g: mean[g[0]] for g in paths})
    for i, r in got.items():
        h, p = site[i]
        host_mean = (sum(hosts[h]) - good[i] + k_host * overall) / (len(hosts[h]) - 1 + k_host)
        path_mean = (sum(paths[h, p]) - good[i] + k_path * host_mean) / (len(paths[h, p]) - 1 + k_path)
        odds = r._qc_logit - math.log(model.share / (1 - model.share)) + math.log(path_mean / (1 - path_mean))
        assert (r._qc_host_mean, r._qc_path_mean, r._qc_posterior) == pytest.approx((host_mean, path_mean, 1 / (1 + math.exp(-odds))), abs=1e-9)
