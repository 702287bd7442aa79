import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wordspace.llm import components, jaccard, substring

from .conftest import words

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def split(text):
    return [w for w in SPACE.split(text or "") if w]


def brute_components(rows, k, num, den):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    sets = []
    for d, t in rows:
        w = split(lower(t))
        sets.append((d, frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    lists = defaultdict(list)
    for i, (d, s) in enumerate(sets):
        for j, both in Counter(j for x in s for j in lists[x]).items():
            if den * both >= num * (len(s) + len(sets[j][1]) - both):
                a, b = root(d), root(sets[j][0])
                up[max(a, b)] = min(a, b)
        for x in s:
            lists[x].append(i)
    return sorted((d, len(s), root(d)) for d, s in sets)


def near_copies(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = split(words(i % (n // 4), 120, 4000))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = f"new{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    shared = words(777, 60, 4000)
    rows += [(n + i, shared + " " + words(5000 + i, 40, 4000)) for i in range(n // 4)]  # a passage, no links
    return rows + [(9000, None), (9001, ""), (9002, " \n"), (9003, "One two"), (9004, "one TWO"), (9005, "Ünder x"), (9006, "ünder x"), (9007, "a\x0bb\x0cc")]


@pytest.mark.parametrize(("k", "num", "den", "chunk"), [(3, 90, 100, 10**6), (3, 90, 100, 400), (5, 8, 10, 500)])
def test_components_equal_brute_force(ready, docs_of, k, num, den, chunk):
    rows = near_copies(80)
    got = jaccard.jaccard_components(ready, docs_of(rows, extra=True), k, num, den, chunk_hashes=chunk)
    assert sorted(map(tuple, got.collect())) == brute_components(rows, k, num, den)


def test_components_of_odd_rows(ready, docs_of):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "z z z q"), (4, words(1, 50)), (5, words(1, 50))]
    got = sorted((tuple(r) for r in jaccard.jaccard_components(ready, docs_of(rows), 3, 90, 100).collect()), key=repr)
    n = brute_components(rows[4:], 3, 90, 100)[0][1]
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 2, None), (4, n, 4), (5, n, 4)], key=repr)
    assert jaccard.jaccard_components(ready, docs_of([]), 3, 90, 100).count() == 0
    kept = jaccard.one_of_each(ready, docs_of(rows, extra=True))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 4, None, None], key=repr)


@pytest.mark.parametrize("long_list", [0, 5, 10**6])
def test_divide_skip_solves_t_occurrence(monkeypatch, long_list):
    monkeypatch.setattr(jaccard, "LONG_LIST", long_list)
    rng = np.random.default_rng(2)
    for _ in range(50):
        lists = [np.flatnonzero(rng.random(60) < p) for p in rng.choice([0.05, 0.3, 0.9], 30)]
        lists = [x for x in lists if len(x)]
        size = np.array([len(x) for x in lists])
        least = int(rng.integers(1, len(lists) + 1))
        want = [d for d, c in sorted(Counter(np.concatenate(lists).tolist()).items()) if c >= least]
        assert jaccard.divide_skip(np.concatenate(lists), np.cumsum(size) - size, size, least).tolist() == want


def test_components_of_links(ready):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(300, i) for i in range(301, 400)]
    links = [x for x in links if x[0] != x[1]]
    got = dict(map(tuple, components.components(ready.createDataFrame(links, "a long, b long")).collect()))
    up = {x: x for link in links for x in link}

    def root(x):
        return x if up[x] == x else root(up[x])

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in up}
    assert components.components(ready.createDataFrame([], "a long, b long")).count() == 0


def brute_removed(rows, window=50):
    first = {}
    for k, t in rows:
        w = split(t)
        for i in range(len(w) - window + 1):
            if k is not None:
                key = tuple(w[i : i + window])
                first[key] = min(first.get(key, k), k)
    out = []
    for k, t in rows:
        w = split(t)
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if k is not None and first[tuple(w[i : i + window])] < k:
                keep[i : i + window] = [False] * window
        left = [x for x, y in zip(w, keep, strict=True) if y]
        out.append((k, len(w), len(w) - len(left), hashlib.sha256(" ".join(left).encode()).hexdigest()))
    return out


def repeats():
    p, q = words(1, 70, 5000), words(2, 55, 5000)
    rows = [(10, words(3, 30, 5000) + "\n" + p), (11, p + " " + words(4, 80, 5000) + "\t" + q), (5, q), (12, p[:300] + " " + q + " " + p), (13, words(4, 80, 5000)), (14, words(3, 30, 5000) + "\n" + p)]
    rows += [(20, "same " * 300), (21, "same " * 60), (22, "same " * 49), (30, None), (31, ""), (32, words(9, 49, 5000)), (33, words(9, 49, 5000)), (34, words(9, 50, 5000)), (35, words(9, 50, 5000))]
    rows += [(40 + i, words(50 + i, 20 * i, 5000) + " " + p + " " + words(60 + i, 5, 5000)) for i in range(20)]
    return rows + [(11, p + " " + words(4, 80, 5000) + "\t" + q), (40, "other words " + q), (None, p)]


def test_removed_words_equal_brute_force(ready, docs_of):
    rows = repeats()
    got = substring.removed_words(ready, docs_of(rows, extra=True).repartition(3))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_removed(rows), key=repr)
    assert substring.removed_words(ready, docs_of([])).count() == 0


def test_text_without_repeats(ready, docs_of):
    rows = [r for r in repeats() if r != (40, "other words " + words(2, 55, 5000))]
    out = substring.without_repeats(ready, docs_of(rows, extra=True))
    assert out.columns == docs_of(rows, extra=True).columns
    want = sorted((k, s) for k, _, _, s in brute_removed(rows) if k is not None)
    assert sorted((r.doc_id, hashlib.sha256(" ".join(split(r.text)).encode()).hexdigest()) for r in out.collect() if r.doc_id is not None) == want
    assert all(r.text is None or r.n_chars == len(r.text) for r in out.collect())
    assert {r.text for r in out.filter("doc_id = 10").collect()} == {rows[0][1]}  # untouched, white space too


def test_factors_end_where_the_source_changes():
    doc, seq = np.array([1, 1, 1, 1, 1, 1, 1, 2, 2]), np.array([7] * 9)
    pos, source = np.array([3, 4, 4, 5, 6, 9, 10, 10, 11]), np.array([0, 0, 0, -1, -1, 0, 0, 0, 0])
    at = np.array([8, 9, 9, 1, 2, 20, 22, 22, 23])
    first, length = substring.parse(doc, seq, pos, source, seq, at, 4)
    assert list(zip(doc[first], pos[first], length, strict=True)) == [(1, 3, 5), (1, 5, 5), (1, 9, 4), (1, 10, 4), (2, 10, 5)]
    whole, words_ = substring.spans(doc[first], seq[first], pos[first], length)
    assert list(zip(doc[first][whole], pos[first][whole], words_, strict=True)) == [(1, 3, 11), (2, 10, 5)]
    assert len(substring.parse(*[x[:0] for x in (doc, seq, pos, source, seq, at)], 4)[0]) == 0
    assert len(substring.spans(doc[:0], seq[:0], pos[:0], pos[:0])[0]) == 0


def test_each_factor_is_one_substring_of_its_source(ready, docs_of):
    rows = [(k, t) for k, t in dict(repeats()).items() if k is not None]
    rows.append((90, words(2, 55, 5000) + " " + words(1, 70, 5000) + " " + words(3, 30, 5000)))
    docs = substring._text_rows(docs_of(rows), "doc_id", "text")
    sketch = substring.sketches(docs, 50, 17).selectExpr("doc_id", "s1", "anchors wanted")
    hits = substring.found_windows(ready, docs, sketch, 50, 17).orderBy("doc_id", "s1", "pos").toPandas()
    first, length = substring.parse(*[hits[c].to_numpy() for c in hits.columns], 50)
    split_words = {k: split(t) for k, t in rows}
    covered = {k: set() for k in split_words}
    for i, n in zip(first, length, strict=True):
        hit = hits.iloc[i]
        a, b = int(hit.pos), int(hit.source_pos)
        assert hit.source < hit.doc_id and n >= 50
        assert split_words[hit.doc_id][a : a + n] == split_words[hit.source][b : b + n]
        covered[hit.doc_id] |= set(range(a, a + n))
    assert sorted((k, len(covered[k])) for k in covered) == sorted((k, n) for k, _, n, _ in brute_removed(rows))
    assert (np.diff(first) > 1).any() and max(length) > 50


def test_repeated_ids_with_different_texts_are_one_document(ready, docs_of):
    a, b = words(1, 60, 400), words(2, 60, 400)
    rows = [(1, a), (5, a), (5, b), (7, b + " end"), (9, words(3, 60, 400)), (11, ""), (12, b), (12, ""), (None, b)]
    got = jaccard.jaccard_components(ready, docs_of(rows), 3, 90, 100).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(1, 1), (5, 1), (5, 1), (7, 1), (9, 9), (11, 11), (12, 1), (12, 1)]
    assert [r.component_id for r in got if r.doc_id is None] == [1]
