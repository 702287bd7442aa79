"""Source divergence audit by Gustavson row accumulation.

Method. A language's groups (sources) and kept terms form a sparse matrix of
counts. Its term-major index lists, for every term, the groups that have it. The
distance of a group to all peers is one row of a sparse product: the group walks
through its own terms, and each term's list is scattered into one dense
accumulator with an entry per peer. Pairs of postings are never emitted.

Absent terms do not have a zero estimate but the smoothed baseline z of their
group, so the accumulators hold corrections to ``V * |z_g - z_h|``: every term of
g alone adds ``|p_g - z_h| - |z_g - z_h|`` (for all peers at once, from sorted
prefix sums), every shared term ``|p_g - p_h| - |p_g - z_h| - |z_g - p_h| +
|z_g - z_h|`` (scattered). A pair's distance is its baseline, both groups' own
corrections and the shared one.

On the cluster the index is cut into blocks of terms (about ``INDEX_ROWS``
postings) and the rows into blocks of groups (``ROW_GROUPS``); a task holds one
index block and the accumulator of one row, and its rows' accumulators are added
up over the blocks. Term counts are summed per task while texts are read (tables
of at most ``HELD`` entries) and then by a shuffle, so no group is collected.

All arithmetic is in integers. Defined results: null text, language and source
are empty strings; repeated rows and rows without an id count like any other;
a language without kept terms has distances 0; an empty table has no rows; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import slices

MIN_DOCS = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP_TERMS = 50
HELD = 400_000  # entries of a task's tables before they are passed on
PIECE = 4 << 20  # bytes of a text that are cut into terms at a time
INDEX_ROWS = 1_000_000  # postings of an index block
ROW_GROUPS = 256  # rows of a task
SCATTER = 1 << 20  # postings that are scattered at a time

#: bytes of terms stay (A-Z lowered), all others become spaces
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = "lang string, source string, term string, n long"


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, piece by piece; a piece ends where a term does."""
    at = 0
    while at < len(text):
        to = at + PIECE
        if to < len(text):
            end = re.compile(rb"[^A-Za-z\x80-\xff]").search(text, to)
            to = end.start() if end else len(text)
        yield text[at:to].translate(_TERM_BYTES).split()
        at = to


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n): occurrences by source; with a null source, the
    number of the language's documents that have the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], Counter] = {}
        having: dict[str, Counter] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), table in [*counts.items(), *(((lang, None), t) for lang, t in having.items())]:
                n = len(table)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(list(table), pa.binary()).cast(pa.string()), pa.array(list(table.values()), pa.int64())],
                        names=["lang", "source", "term", "n"],
                    )
            counts.clear()
            having.clear()

        for whole in batches:
            for batch in slices(whole, 200, text=2):
                texts = batch.column(2).cast(pa.binary()).to_pylist()
                for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                    own, seen = counts.setdefault((lang, source), Counter()), set()
                    for terms in _pieces(text):
                        own.update(terms)
                        seen.update(terms)
                    having.setdefault(lang, Counter()).update(seen)
                if sum(map(len, counts.values())) + sum(map(len, having.values())) > HELD:
                    yield from passed_on()
        yield from passed_on()

    return docs.select("lang", "source", "text").mapInArrow(run, _COUNTS)


def _estimate(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * kept)), exact; null
    if the language keeps no term."""
    big = lambda c: c.cast("decimal(20,0)")
    over, under = big(F.lit(SCALE)) * big(count + PRIOR), big(total + PRIOR * kept)
    return F.when(kept > 0, ((over - F.pmod(over, under)) / under).cast("long") + 1)


def distances(postings: DataFrame, groups: DataFrame, index_rows: int = INDEX_ROWS, row_groups: int = ROW_GROUPS) -> DataFrame:
    """(lang, g, h, value) of every ordered pair of a language's groups, less
    the baseline. ``postings``: (lang, term, g, p); ``groups``: (lang, g, z), g
    from 0 without gaps."""
    sizes = postings.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / index_rows).alias("t_blocks"))
    wide = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / row_groups).alias("g_blocks"))
    grid = materialize(sizes.join(wide, "lang"))
    blocks = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    index = postings.join(grid, "lang").withColumn("t_block", F.pmod(F.xxhash64("term"), F.col("t_blocks")))
    index = index.select("lang", "t_block", blocks("g_blocks").alias("g_block"), F.col("g_blocks").alias("g_step"), F.xxhash64("term").alias("t"), "term", "g", "p")
    peers = groups.join(grid, "lang").select("lang", "g", "z", "g_blocks", blocks("t_blocks").alias("t_block")).select(
        F.col("lang").alias("lang"), "t_block", blocks("g_blocks").alias("g_block"), F.col("g").alias("peer"), "z"
    )

    def rows_of_block(key: tuple, index: pa.Table, peers: pa.Table) -> pa.Table:
        z = np.zeros(peers.num_rows, np.int64)
        z[peers.column("peer").to_numpy()] = peers.column("z").to_numpy()
        block = key[2].as_py()
        empty = {"lang": pa.array([], pa.string()), "g": pa.array([], pa.int64()), "h": pa.array([], pa.int64()), "value": pa.array([], pa.int64())}
        if not index.num_rows:
            return pa.table(empty)
        step = index.column("g_step")[0].as_py()
        term = index.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.lexsort((index.column("g").to_numpy(), term))  # term-major
        term, h, p = term[order], index.column("g").to_numpy()[order], index.column("p").to_numpy()[order]
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1], [True]]))
        out_g, out_h, out_v = [], [], []
        by_row = np.argsort(h, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], h[by_row][1:] != h[by_row][:-1]]))
        for a, b in zip(starts, [*starts[1:], len(h)], strict=True):
            g = int(h[by_row[a]])
            if g % step != block:
                continue
            mine = by_row[a:b]  # this row's entries: its terms and estimates
            # own terms against every peer's baseline
            own = np.sort(p[mine])
            sums = np.concatenate([[0], np.cumsum(own)])
            below = np.searchsorted(own, z)
            alone = z * below - sums[below] + (sums[-1] - sums[below]) - z * (len(own) - below) - len(own) * np.abs(z[g] - z)
            # shared terms: their lists scattered into the accumulator
            row = np.zeros(len(z), np.int64)
            spans = first[term[mine] + 1] - first[term[mine]] if len(mine) else np.zeros(0, np.int64)
            cut = np.flatnonzero(np.diff(np.cumsum(spans) // SCATTER, prepend=0))
            for part in np.split(np.arange(len(mine)), cut):
                size = spans[part]
                ends = np.cumsum(size)
                at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[term[mine[part]]] - ends + size, size)
                peer, theirs, ours = h[at], p[at], np.repeat(p[mine[part]], size)
                np.add.at(row, peer, np.abs(ours - theirs) - np.abs(ours - z[peer]) - np.abs(z[g] - theirs) + np.abs(z[g] - z[peer]))
            others = np.flatnonzero(np.arange(len(z)) != g)
            here = np.full(len(others), g)
            out_g += [here, others]
            out_h += [others, here]
            out_v += [alone[others] + row[others], alone[others]]
        if not out_g:
            return pa.table(empty)
        g, h, v = map(np.concatenate, (out_g, out_h, out_v))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(g), pa.string()), "g": g, "h": h, "value": v})

    key = ["lang", "t_block", "g_block"]
    parts = index.groupBy(*key).cogroup(peers.groupBy(*key)).applyInArrow(rows_of_block, "lang string, g long, h long, value long")
    return parts.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far every source of a
    language is from its other sources, and its most overused terms."""
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(none("lang").alias("lang"), none("source").alias("source"), none("text").alias("text"))
    summed = materialize(term_counts(rows).groupBy("lang", "term", "source").agg(F.sum("n").alias("n")))
    kept = summed.filter(F.col("source").isNull() & (F.col("n") >= min_docs)).select("lang", "term")
    counts = materialize(summed.filter("source IS NOT NULL").join(kept, ["lang", "term"]))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
    z = F.coalesce(_estimate(F.lit(0), F.col("total"), F.col("v")), F.lit(0)).alias("z")
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long").alias("g")
    groups = materialize(groups.select("lang", "source", number, "total", "v", z))

    estimated = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", "g", "v", "n", _estimate(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    estimated = materialize(estimated)
    found = distances(estimated.select("lang", "term", "g", "p"), groups.select("lang", "g", "z"))
    # every pair of a language's groups is a result row
    one = groups.select("lang", "source", "g", "v", "z")
    other = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("h"), F.col("z").alias("z_h"))
    pairs = one.join(other, "lang").filter("g <> h").join(found, ["lang", "g", "h"], "left")
    value = F.col("v") * F.abs(F.col("z") - F.col("z_h")) + F.coalesce("value", F.lit(0))
    by_pair = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")).withColumn("rank", F.row_number().over(by_pair))

    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    lang_total = whole.groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("v"))
    whole = whole.join(lang_total, "lang").select("lang", "term", _estimate(F.col("n"), F.col("total"), F.col("v")).alias("q"))
    over = estimated.join(whole, ["lang", "term"]).filter("n > 0 AND p > q")
    terms = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_pair)).filter(F.col("rank") <= top_terms)
    return pairs.unionByName(terms)


def divergence_sql() -> str:
    """The same rows in DuckDB, over the dense matrix of counts."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS nr, {lower} AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
        t AS (SELECT nr, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT nr) >= {MIN_DOCS}),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
        dense AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
        e AS (SELECT *, 1 + ({SCALE}::HUGEINT * (n + {PRIOR})) // (sum(n) OVER (PARTITION BY lang, source) + {PRIOR} * count(*) OVER (PARTITION BY lang, source)) AS p FROM dense),
        w AS (
            SELECT lang, term, 1 + ({SCALE}::HUGEINT * (n + {PRIOR})) // (sum(n) OVER (PARTITION BY lang) + {PRIOR} * count(*) OVER (PARTITION BY lang)) AS q
            FROM (SELECT lang, term, sum(n) AS n FROM dense GROUP BY 1, 2)
        ), f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM e a JOIN e b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
        r AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
            UNION ALL SELECT lang, source, 'term', term, p - q FROM e JOIN w USING (lang, term) WHERE n > 0 AND p > q
        ), k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM r)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM k WHERE part = 'pair' OR rank <= {TOP_TERMS}
    """
