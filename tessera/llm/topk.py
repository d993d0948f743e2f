"""Exact top-k inner products: no-random-access aggregation over sorted component lists."""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import read_table, saved

#: Rows of a block of candidates, and queries that meet it in one task.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 256
#: The lists are read down to these shares of their length, with a look at the bounds after each.
DEPTHS = (1 / 16, 1 / 4, 1)


class SortedLists:
    """A block of integer vectors as one list for each component, its rows sorted by value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self.n = ids, vectors, len(ids)
        rows = np.ascontiguousarray(np.argsort(-vectors, axis=0, kind="stable").T)
        self.values = np.take_along_axis(vectors.T, rows, axis=1)
        place = np.empty(rows.shape, np.int32)
        np.put_along_axis(place, rows, np.arange(self.n, dtype=np.int32)[None, :], axis=1)
        self.place = np.ascontiguousarray(place.T)
        self.most = int(np.abs(vectors).max(initial=0))

    def top(self, queries: np.ndarray, owns: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """Each query's k best (score, id): larger scores first, smaller ids first among ties, rows of its own id left out.

        All lists are read in step, each from the end that the query's component
        favours.  What is read of a row puts its score between two bounds: an
        unread part adds at least the list's last and at most the last read
        product.  Rows whose upper bound is below the k-th lower bound can't
        qualify.  Reading stops when few other rows are left, whose scores are
        then resolved exactly; queries that have more go on to the next depth.
        """
        out: list[list[tuple[int, int]]] = [[] for _ in owns]
        reach = self.most * int(np.abs(queries).max(initial=0)) * max(1, queries.shape[1])
        open_, depths = np.arange(len(owns)), DEPTHS if reach < 1 << 52 and self.n > 4 * k else ()
        for share in depths:
            depth = ceil(self.n * share)
            # Sums of integers that the type holds exactly, in whatever order they are added.
            low, high = self._bounds(queries[open_], depth, np.float32 if reach < 1 << 24 else np.float64)
            own = self.ids[None, :] == owns[open_][:, None]
            low[own] = high[own] = -np.inf
            kth, more = np.partition(low, self.n - k, axis=1)[:, self.n - k], []
            for at, maybe in zip(open_.tolist(), high >= kth[:, None]):
                left = np.flatnonzero(maybe)
                if len(left) > 4 * k and depth < self.n:
                    more.append(at)
                else:
                    out[at] = self._best(queries[at], owns[at], left, k)
            open_ = np.array(more, np.int64)
            if not more:
                return out
        for at in open_.tolist():
            out[at] = self._best(queries[at], owns[at], np.arange(self.n), k)
        return out

    def _bounds(self, queries: np.ndarray, depth: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores, a row a query, of what the lists' first ``depth`` entries tell."""
        up, down = self.place < depth, self.place >= self.n - depth
        weights = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1).astype(kind)

        def scores(ups: np.ndarray, downs: np.ndarray) -> np.ndarray:
            rows = np.concatenate([np.where(up, self.vectors, ups), np.where(down, self.vectors, downs)], axis=1)
            return weights @ rows.astype(kind).T
        low = scores(self.values[:, -1], self.values[:, 0])
        return low, low if depth == self.n else scores(self.values[:, depth - 1], self.values[:, self.n - depth])

    def _best(self, query: np.ndarray, own: int, left: np.ndarray, k: int) -> list[tuple[int, int]]:
        left = left[self.ids[left] != own]
        score = self.vectors[left] @ query
        best = np.lexsort((self.ids[left], -score))[:k]
        return [(int(score[b]), int(self.ids[left[b]])) for b in best]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS,
                       block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows of ``vectors``; both are (vec_id, v array<long>).

    Rows are dealt by hash into blocks of about ``block_rows``, queries into
    blocks of about ``block_queries``; a task has one block of each, reads the
    rows' sorted lists, and passes on k rows a query.  Block sizes hold at any
    input size, only their number grows.  Ties go to the smaller id, a row
    never answers its own id, shorter vectors count as ending in zeros; fewer
    than k rows give fewer results.  Sums are 64-bit integers.
    """
    blocks = max(1, ceil(vectors.count() / block_rows))
    teams = max(1, ceil(queries.count() / block_queries))
    deal = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cands = vectors.select(deal(blocks, 1).alias("block"), every(teams).alias("team"), "vec_id", "v")
    asked = queries.select(deal(teams, 2).alias("team"), every(blocks).alias("block"), "vec_id", "v")

    def run(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(c) and len(q):
            width = max(c["v"].map(len).max(), q["v"].map(len).max())
            lists = SortedLists(c["vec_id"].to_numpy(np.int64), _matrix(c["v"], width))
            owns = q["vec_id"].to_numpy(np.int64)
            for own, best in zip(owns.tolist(), lists.top(_matrix(q["v"], width), owns, k)):
                out += [(own, i, s) for s, i in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = cands.groupBy("block", "team").cogroup(asked.groupBy("block", "team")).applyInPandas(
        run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def integer_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): each vector's components as floor(scale * x), x as double.

    Rows without id, vector or with a NULL or non-finite component, or one too
    large for 64 bits, are left out.  Of rows that share an id the one with the
    smallest vector is taken.
    """
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).try_cast("bigint"))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > 9e15 / scale))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    return rows.groupBy("vec_id").agg(F.min(x).alias("v"))


def op5_topk(spark, sf_dir: str) -> DataFrame:
    vectors = saved(integer_vectors(read_table(spark, sf_dir, "embeddings")), "vectors")
    return top_inner_products(vectors, vectors.where("vec_id % 50 = 0"))


#: DuckDB SQL of op5's contract.
SQL_TOPK = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
