"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Method. Components are integers (``floor(scale * x)``). Every block of vectors
keeps, for each dimension, its vectors ordered by quantised impact, so that the
vectors of one (dimension, impact level) form one posting segment. For a query,
segments are ranked by their quantised gain (``weight * impact`` over the least
of the dimension) and processed in descending order, a score at a time, into one
accumulator a vector. A vector's dimensions that it has not met yet hold at most
the gain of the next segment each, which bounds its score. After each round the
vectors of the highest bounds are scored exactly; processing stops only when at
least three quarters are proven unable to reach the k-th best of these, or when
no segment is left. All those that may still belong to the result are rescored exactly, so
nothing is lost whatever the point of the stop.

Queries go to the index in blocks; the result of each (query block, index block)
is at most k rows a query, merged by one grouped ranking.

Defined results: vectors that are null or hold null or non-finite components
take no part, neither as query nor as candidate; vectors of another length than
the query's never match it; a row is never its own candidate, and neither are
rows with the same id; repeated candidate rows count each; a query id with
several vectors asks with the least of them (by its first differing integer
component, a shorter one before its extensions); ties go to the smaller id; extra columns are dropped; an empty table gives an empty result;
fewer than k candidates give all of them. Products too large for sums in 64 bits
are scored without the index; a score of the result itself must fit 64 bits
(OverflowError).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 8192  # vectors of an index block
QUERY_BLOCK = 512
LEVEL = 4  # integer values of one impact level
RESCORE = 64  # vectors of the highest bounds that are scored exactly after a round
SAFE = 1 << 60  # sums of products below it are held in 64-bit integers
ROUNDS = (0.52, 0.65, 0.8, 1.0)  # shares of the postings after which a stop is tried

_HITS = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("vec_id", T.LongType()),
    T.StructField("score", T.LongType()),
])


def quantised(df: DataFrame, scale: float, key: str, vector: str) -> DataFrame:
    """(vec_id, v): usable rows with integer components."""
    parts = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    usable = F.col(vector).isNotNull() & (F.size(vector) > 0) & finite & F.col(key).isNotNull()
    return df.filter(usable).select(F.col(key).cast("long").alias("vec_id"), parts.alias("v"))


class ImpactIndex:
    """Posting segments of one block, in impact order within each dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, level: int = LEVEL):
        self.ids, self.vectors, self.level = ids, vectors, level
        n, dims = vectors.shape
        self.largest = max(abs(int(vectors.min())), abs(int(vectors.max())))
        impact = np.floor_divide(vectors, level)
        self.postings, dim, imp, start = [], [], [], []
        for d in range(dims):
            order = np.argsort(impact[:, d], kind="stable")
            levels, first = np.unique(impact[order, d], return_index=True)
            self.postings.append(order)
            dim.append(np.full(len(levels), d))
            imp.append(levels)
            start.append(first + d * n)
        self.postings = np.concatenate(self.postings)
        self.dim, self.impact, self.start = map(np.concatenate, (dim, imp, start))
        self.size = np.diff(np.append(self.start, n * dims))

    def search(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, exact scores) of the k best vectors whose id is not
        ``own``; ties go to the smaller id."""
        n, dims = self.vectors.shape
        if 2 * dims * (self.largest + self.level) * max(abs(int(query.min())), abs(int(query.max()))) >= SAFE:
            return self._scan(query, k, own)
        weight = query[self.dim]
        # the largest contribution that a vector of the segment can make
        bound = weight * (self.impact * self.level + np.where(weight > 0, self.level - 1, 0))
        lowest = np.full(dims, np.iinfo(np.int64).max)
        np.minimum.at(lowest, self.dim, bound)
        gain = bound - lowest[self.dim]  # over the least of the dimension
        most = np.zeros(dims, np.int64)
        np.maximum.at(most, self.dim, gain)
        ranked = np.argsort(-gain, kind="stable")
        cost = np.cumsum(self.size[ranked])
        # gains and the number of dimensions met of each vector
        gained, met, done = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
        wide = int(gain.max()) * dims >= 1 << 53  # sums in doubles would be rounded
        tried = np.zeros(n, bool)
        best = np.zeros(0, np.int64)
        score = np.zeros(n, np.int64)
        for share in ROUNDS:
            stop = min(int(np.searchsorted(cost, share * cost[-1])) + 1, len(ranked))
            at, sizes = self._postings(ranked[done:stop])
            if wide:
                each = np.repeat(gain[ranked[done:stop]], sizes)
                gained += np.bincount(at, each >> 30, n).astype(np.int64) << 30
                gained += np.bincount(at, each & (1 << 30) - 1, n).astype(np.int64)
            else:
                gained += np.bincount(at, np.repeat(gain[ranked[done:stop]].astype(np.float64), sizes), n).astype(np.int64)
            met += np.bincount(at, minlength=n)
            done = stop
            # a vector's dimensions that are still open hold at most the next gain each
            ahead = gain[ranked[done]] if done < len(ranked) else 0
            untouched = most <= ahead
            upper = lowest.sum() + gained + most[untouched].sum() + (dims - untouched.sum() - met) * ahead
            fresh = np.argpartition(-upper, RESCORE)[:RESCORE] if n > RESCORE else np.arange(n)
            fresh = fresh[~tried[fresh]]
            best = self._exact(query, k, own, np.concatenate([best, fresh]), fresh, score, tried)
            floor = score[best[-1]] if len(best) == k else -np.inf
            open_ = np.flatnonzero((upper >= floor) & ~tried)
            if len(open_) <= max(RESCORE, n // 4) or done == len(ranked):
                break
        best = self._exact(query, k, own, np.concatenate([best, open_]), open_, score, tried)
        return best, score[best]

    def _scan(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """``search`` with unbounded integers, without the index."""
        score = self.vectors.astype(object) @ query.astype(object)
        among = np.flatnonzero(self.ids != own).tolist()
        best = sorted(among, key=lambda i: (-score[i], self.ids[i]))[:k]
        if any(not -(1 << 63) <= score[i] < 1 << 63 for i in best):
            raise OverflowError("a score does not fit 64 bits")
        return np.array(best, np.int64), np.array([score[i] for i in best], np.int64)

    def _exact(self, query, k, own, among, fresh, score, tried) -> np.ndarray:
        score[fresh] = self.vectors[fresh] @ query
        tried[fresh] = True
        among = among[self.ids[among] != own]
        return among[np.lexsort((self.ids[among], -score[among]))[:k]]

    def _postings(self, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.size[segments]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0)
        at += np.repeat(self.start[segments] - ends + sizes, sizes)
        return self.postings[at], sizes


def _search_blocks(key: tuple, index: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    out: list[np.ndarray] = []
    if len(index) and len(queries):
        for dims, rows in index.groupby(index.v.map(len)):
            asked = queries[queries.v.map(len) == dims]
            if len(asked):
                block = ImpactIndex(rows.vec_id.to_numpy(), np.stack(rows.v.to_numpy()).astype(np.int64))
                for own, q in zip(asked.vec_id.to_numpy(), asked.v, strict=True):
                    at, score = block.search(np.asarray(q, np.int64), k, own)
                    out.append(np.stack([np.full(len(at), own), block.ids[at], score], 1))
    rows = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
    return pd.DataFrame(rows, columns=_HITS.names)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for every
    distinct id of ``queries``."""
    index = quantised(vectors, scale, key, vector)
    asked = quantised(queries, scale, key, vector).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-index.count() // BLOCK))
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = lambda col, n: F.pmod(F.xxhash64(col), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # a stated query set against all rows, in blocks of bounded size
    left = index.withColumn("ib", block("vec_id", blocks)).withColumn("qb", every(query_blocks))
    right = asked.withColumn("qb", block("vec_id", query_blocks)).withColumn("ib", every(blocks))
    hits = left.groupBy("ib", "qb").cogroup(right.groupBy("ib", "qb")).applyInPandas(lambda key, a, b: _search_blocks(key, a, b, k), _HITS)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
