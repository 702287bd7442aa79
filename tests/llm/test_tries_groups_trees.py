"""Prefix trie, source divergence and cover trees against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from wordspace.llm import cover_tree, divergence, prefix_trie

CONV = "conv_id long, turn long, role string, text string"


# ---- prefix trie -----------------------------------------------------------------
def trie_brute(rows):
    """Rows of the trie, node by node."""
    own = defaultdict(list)
    tie = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, tie(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        full[c] = own.get(base, [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
        ends[tuple(full[c])].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in children
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted((m[0], len(n), members[n[:-1]][0] if n else None, len(m), children[n], leaves[n], saved[n], sha(ends[n])) for n, m in members.items())


def trie_rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in df.select(*names).collect())


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_brute_force(ready, seed, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 8)  # conversations of several stretches
    rnd = random.Random(seed)
    rows, seen = [], []
    for c in rnd.sample(range(-150, 450), 60):
        n = rnd.choice([1, 2, 3, 5, 8, 9, 12, 40])
        if seen and rnd.random() < 0.7:  # a copy, a prefix, or one that leaves another inside a block
            old = rnd.choice(seen)
            new = old[: rnd.randint(1, len(old))] + [(rnd.choice("ua"), rnd.choice("xyz") * rnd.randint(0, 3)) for _ in range(rnd.choice([0, 0, 1, 2, 6]))]
        else:
            new = [(rnd.choice("ua"), rnd.choice("xyz") * rnd.randint(0, 3)) for _ in range(n)]
        seen.append(new)
        rows += [(c, k * 3 - 5, r, t) for k, (r, t) in enumerate(new)]
    rnd.shuffle(rows)
    assert trie_rows(prefix_trie.prefix_trie(ready.createDataFrame(rows, CONV))) == trie_brute(rows)


def test_trie_odd_rows(ready):
    long = "ü" * 200_000
    rows = [
        (100, None, None, None), (100, 0, "u", long), (100, 0, "u", long), (100, 1, "", ""), (101, 5, "u", "a"), (101, 5, "a", "b"),
        (None, 0, "u", "lost"), (102, None, "u", None), (7, 0, "a", "b"), (205, 0, "x", "y"), (300, 1, "r", "s"), (300, 1, "r", "s"), (-5, 2, "u", "neg"),
    ]
    rows += [(1000 + k, t, "u", f"same {t}") for k in range(30) for t in range(9)]
    df = ready.createDataFrame(rows, CONV).selectExpr("*", "'x' AS pos", "1 AS blk", "'y' AS conv", "2 AS depth", "3 AS _stretch")
    assert trie_rows(prefix_trie.prefix_trie(df)) == trie_brute(rows)
    assert trie_rows(prefix_trie.prefix_trie(df.repartition(7, "turn"))) == trie_brute(rows)


def test_trie_of_nothing(ready):
    assert prefix_trie.prefix_trie(ready.createDataFrame([], CONV)).collect() == []
    assert prefix_trie.prefix_trie(ready.createDataFrame([(None, 1, "u", "x")], CONV)).collect() == []


# ---- divergence ------------------------------------------------------------------
def divergence_brute(rows, least, top):
    import re

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    having, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        having[lang].update(set(terms))
        count[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in having[lang].items() if n >= least]
        est = lambda table: {t: 1 + 10**9 * (table[t] + 5) // (sum(table[x] for x in kept) + 5 * len(kept)) for t in kept}
        p = {s: est(count[lang, s]) for s in sources}
        q = est(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, cut in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:cut])]
    return sorted(out)


DOC = "doc_id long, text string, lang string, source string"
AUDIT = ["lang", "source", "part", "item", "value", "rank"]


def audit_rows(df):
    return sorted(tuple(r) for r in df.select(*AUDIT).collect())


@pytest.mark.parametrize("small", [False, True])
def test_divergence_equals_brute_force(ready, small, monkeypatch):
    rnd = random.Random(5)
    vocabulary = ["Straße", "été", "été", "İx", "don't", "a1b", "AA", "aa", "漢字", "𝒳"] + [f"w{chr(97 + k)}" for k in range(26)]
    rows = []
    for _ in range(400):
        s = min(rnd.randrange(9), rnd.randrange(9))
        some = vocabulary[s : s + 24]
        rows.append((" ".join(rnd.choice(some) for _ in range(rnd.randrange(12))), rnd.choice(["en", "en", "de", None]), rnd.choice([f"s{s}", f"s{s}", None])))
    rows += [(None, "xx", "only"), ("words few", "yy", "a"), ("", "yy", None), (None, None, None), ("z " * 3, "en", "s0"), ("z " * 3, "en", "s0")]
    if small:  # many index blocks, row blocks, slices and pieces
        for name, value in (("HELD", 20), ("PIECE", 3), ("SCATTER", 7)):
            monkeypatch.setattr(divergence, name, value)
    df = ready.createDataFrame([(None if k % 3 else 1, *r) for k, r in enumerate(rows)], DOC).selectExpr("*", "'x' AS term", "1 AS g", "2 AS n", "3 AS p", "'y' AS item")
    if small:
        original = divergence.distances
        monkeypatch.setattr(divergence, "distances", lambda a, b: original(a, b, index_rows=40, row_groups=2))
    got = audit_rows(divergence.divergence(df, min_docs=6, top_terms=4))
    assert got == divergence_brute(rows, 6, 4)


def test_divergence_of_nothing(ready):
    assert divergence.divergence(ready.createDataFrame([], DOC)).collect() == []


def test_estimates_are_exact_for_huge_counts(ready):
    from pyspark.sql import functions as F

    cases = [(10**15 + 7, 3 * 10**15 + 1, 12345), (0, 0, 1), (9 * 10**17, 9 * 10**17, 1)]
    df = ready.createDataFrame(cases, "n long, total long, v long")
    got = [r[0] for r in df.select(divergence._estimate(F.col("n"), F.col("total"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (n + 5) // (t + 5 * v) for n, t, v in cases]


# ---- cover tree ------------------------------------------------------------------
def clustered(seed, n, dim, centers=25):
    rnd = np.random.default_rng(seed)
    at = rnd.normal(size=(centers, dim))[rnd.integers(0, centers, n)]
    return at + rnd.normal(size=(n, dim)) * np.exp(rnd.uniform(-9, 0, size=(n, 1)))


def linked(points, cosine):
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    return unit @ unit.T >= cosine


@pytest.mark.parametrize("dim", [2, 5, 64])
def test_tree_covers_and_halves(dim):
    points = clustered(dim, 1200, dim)
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    tree = cover_tree.build(unit, np.arange(len(unit)), np.ones(len(unit), np.int64))
    n = tree.nodes
    assert sorted(tree.ids) == list(range(len(unit)))
    for i in range(len(n)):
        far = cover_tree.distance(tree.unit[n["lo"][i] : n["hi"][i]] @ tree.unit[n["center"][i]])
        assert far.max() <= n["radius"][i] + 1e-6
        kids = np.arange(n["first"][i], n["last"][i])
        if len(kids):
            assert n["lo"][kids[0]] == n["lo"][i] and n["hi"][kids[-1]] == n["hi"][i] and (n["lo"][kids[1:]] == n["hi"][kids[:-1]]).all()
            assert n["center"][kids[0]] == n["center"][i]
            assert (n["radius"][kids] <= n["radius"][i]).all() and len(kids) > 1


@pytest.mark.parametrize("dim,cosine", [(2, 0.9), (3, 0.99), (16, 0.9), (64, 0.8)])
def test_traversal_counts_all_links(dim, cosine):
    points = np.concatenate([clustered(1, 900, dim), clustered(1, 60, dim) * 2.0])
    size = np.random.default_rng(2).integers(1, 5, len(points))
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    want, half = linked(points, cosine), 500
    np.fill_diagonal(want, True)
    a = cover_tree.build(unit[:half], np.arange(half), size[:half])
    b = cover_tree.build(unit[half:], np.arange(half, len(unit)), size[half:])
    own, both = cover_tree.DualTraversal(a, a, cosine), cover_tree.DualTraversal(a, b, cosine)
    assert (own.count_a == (want[:half, :half] @ size[:half])[a.ids]).all()
    assert (both.count_a == (want[:half, half:] @ size[half:])[a.ids]).all()
    assert (both.count_b == (want[half:, :half] @ size[:half])[b.ids - half]).all()
    x, y = both.links()
    assert want[:half].any() and len(x) < len(unit)
    assert both.compared < half * (len(unit) - half)


def near_brute(rows, cosine):
    n = len(rows)
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and good[i] and good[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in (i, j))
                link[i, j] = a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine
    comp = list(range(n))
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(link[todo.pop()]):
                if j not in seen:
                    seen.add(int(j))
                    todo.append(int(j))
        comp[i] = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
    return sorted(((rows[i][0], int(link[i].sum()), comp[i], rows[i][0] == comp[i]) for i in range(n)), key=repr)


@pytest.mark.parametrize("chunk", [8192, 40])
def test_near_duplicates_equal_brute_force(ready, chunk):
    points = np.concatenate([clustered(3, 150, 6, 12), clustered(4, 40, 3)[:, [0, 1, 2, 0, 1, 2]]]).tolist()
    rows = [(k * 7 % 191, p) for k, p in enumerate(points)]
    rows += [(500 + k, points[3]) for k in range(60)] + [(600, [2 * x for x in points[3]]), (601, [x * 1e300 for x in points[5]]), (602, [x * 1e-300 for x in points[5]])]
    rows += [(700, None), (701, []), (702, [0.0] * 6), (703, [1.0, None, 0.0]), (704, [float("nan")] * 6), (705, [float("inf"), 1.0]), (706, [1.0, 0.0]), (707, [1.0, 0.1]), (708, [1.0]), (708, [-1.0])]
    rows += [(None, points[3]), (None, [5.0, 0.0, 0.0, 1.0]), (709, points[9]), (709, points[9]), (710, points[1]), (710, points[30])]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS label", "'x' AS node", "2 AS unit", "3 AS cell", "4 AS chunk", "5 AS size")
    got = cover_tree.near_duplicates(ready, df, 0.9, chunk=chunk, sample=100)
    assert sorted((tuple(r) for r in got.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr) == near_brute(rows, 0.9)


def test_near_duplicates_of_nothing(ready):
    empty = ready.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.near_duplicates(ready, empty).collect() == []
    only = ready.createDataFrame([(1, None), (None, [0.0])], "vec_id long, embedding array<float>")
    assert sorted((tuple(r) for r in cover_tree.near_duplicates(ready, only).collect()), key=repr) == [(1, 0, 1, True), (None, 0, None, True)]


def test_trees_are_read_where_they_lie(ready, monkeypatch):
    """a copy of both trees was shuffled for every pair of chunks."""
    plans, dropped = {}, []

    def written(df, name, path=None):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name, path)

    real, drop, before = cover_tree.written, cover_tree.drop_path, ready.conf.get(cover_tree.AT_ONCE)
    monkeypatch.setattr(cover_tree, "written", written)
    monkeypatch.setattr(cover_tree, "drop_path", lambda spark, path: (dropped.append(path), drop(spark, path)))
    monkeypatch.setattr(cover_tree, "BATCH_BYTES", 1)  # a pair of trees at a time
    monkeypatch.setattr(cover_tree, "GROUPS", 2)
    monkeypatch.setattr(cover_tree, "GROUP_TREES", 3)
    rows = [(k, p) for k, p in enumerate(clustered(5, 200, 4, 9).tolist())]
    got = cover_tree.near_duplicates(ready, ready.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.9, chunk=12, sample=50)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == near_brute(rows, 0.9)
    assert "CartesianProduct" in plans["links"] and "CoGroup" not in plans["links"]
    assert len(dropped) == 2 and ready.conf.get(cover_tree.AT_ONCE) == before
