"""Exact top-k search by no-random-access aggregation (operator 2).

Every dimension is a list of the candidates sorted by that component.  A query reads all its lists from the end its own
component favours (a component of 0 needs no list) to the same depth, which grows step by step, and keeps for every
candidate

* what has been read of it;
* an upper bound: that and, for the unread part, the smaller of the sum of the frontiers (the values last read) and the
  product of the norms of the unread parts (Cauchy-Schwarz; the squares read so far are taken from a candidate's norm);
* a lower bound: that and the larger of the lists' other ends and the negative product of the norms.

A candidate whose upper bound is below the query's k-th best lower bound cannot qualify and is dropped, whether it has
been read anywhere or not.  A query stops when no outsider can qualify, that is when few candidates are left; the lists
are then read to the end for these only, which gives their exact scores.

Lists are read for a block of queries at once: what is read, what is open and the bounds of all its queries and
candidates are matrix products of the queries with the candidates cut at the frontiers.  Queries that have stopped leave
the block.  How deep the others read depends on the vectors: where few components carry most of a product, lists end
early; for directions spread evenly over many dimensions no bound excludes much before nearly everything is read.

Distribution: candidates are dealt to blocks of at most about ``candidate_block`` rows and queries to
blocks of ``query_block``; every query block meets every candidate block in a task of its own, and the
block results (k rows a query) are merged by a window over the query.  Nothing is broadcast or
collected.  Work grows with queries times candidates, which the exact search of a stated query set needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import written

#: Candidates, as a multiple of k, that are few enough to resolve; the depths at which bounds are made, as shares.
FEW = 4
DEPTHS = (1 / 64, 1 / 12, 1 / 4, 1 / 2, 3 / 4, 7 / 8, 19 / 20)


class Lists:
    """The sorted lists of some candidates, whose rows are in the order of their ids."""

    def __init__(self, values: np.ndarray):
        self.values, self.sorted = values, np.sort(values, axis=0)

    def bounds(self, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores when all lists have been read to ``depth``; candidates that share the
        value last read count as read."""
        c, n = self.values, len(self.values)
        top, bottom = self.sorted[n - depth], self.sorted[depth - 1]
        from_top, from_bottom = c >= top, c <= bottom
        both = lambda a, b: np.concatenate((a, b), axis=1)  # noqa: E731  lists read from their last and from their first entry
        q = both(np.maximum(queries, 0), np.minimum(queries, 0))
        seen = both(from_top, from_bottom)
        twice = both(c, c)
        done = q @ np.where(seen, twice, 0).T
        ahead = q @ np.where(seen, 0, np.concatenate((top, bottom))).T
        worst = q @ np.where(seen, 0, np.concatenate((self.sorted[0], self.sorted[-1]))).T
        open_q = (q * q) @ (~seen).astype(c.dtype).T
        open_c = (q != 0).astype(c.dtype) @ np.where(seen, 0, twice * twice).T
        norms = np.sqrt(open_q) * np.sqrt(open_c) * c.dtype.type(1 + 1e-5) + c.dtype.type(1)
        return done + np.maximum(worst, -norms), done + np.minimum(ahead, norms)

    def top(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, int, int]]:
        """For each query, rows and scores of the k best candidates, the positions read and the candidates resolved; a row
        flagged in the query's row of ``own`` takes no part.  All values are integers that their type holds exactly."""
        n = len(self.values)
        out: list = [None] * len(queries)
        lists = (queries != 0).sum(axis=1)

        def resolve(i: int, alive: np.ndarray, depth: int) -> None:
            left = np.flatnonzero(alive)
            scores = self.values[left] @ queries[i]  # what is left of the lists, for these only
            best = np.lexsort((left, -scores))[:k]
            out[i] = left[best], scores[best], int(lists[i]) * depth, len(left)

        active, alive, depth = np.arange(len(queries)), ~own, 0
        for share in DEPTHS:
            stop = (alive.sum(axis=1) <= FEW * k) | (lists[active] == 0)
            for i, a in zip(active[stop], alive[stop], strict=True):
                resolve(i, a, depth)
            active, alive = active[~stop], alive[~stop]
            if not len(active) or int(n * share) <= depth:
                continue
            depth = int(n * share)
            lower, upper = self.bounds(queries[active], depth)
            lower[own[active]] = -np.inf
            floor = np.partition(lower, n - k, axis=1)[:, n - k]
            alive = alive & (upper >= floor[:, None])
        for i, a in zip(active, alive, strict=True):
            resolve(i, a, depth)
        return out


def top_k_block(queries: np.ndarray, query_ids: np.ndarray, cands: np.ndarray, ids: np.ndarray,
                k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query position, candidate position, score, positions read, candidates resolved) of the k best candidates of each
    query, equal scores by smaller id; a candidate with the query's own id takes no part."""
    n, dim = cands.shape
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(cands).max(initial=0)) * max(dim, 1)
    square = max(float(np.abs(x).max(initial=0)) ** 2 * max(dim, 1) for x in (queries, cands))
    if max(most, square) >= 2.0**50:
        i, j, score = _by_integers(queries, query_ids, cands, ids, k)
        return i, j, score, np.full(len(i), n * dim), np.full(len(i), n)
    kind = np.float32 if max(most, square) < 2.0**23 else np.float64  # sums of integers stay exact
    rank = np.argsort(ids, kind="stable")
    lists = Lists(cands[rank].astype(kind))
    out = []
    for i in range(0, len(queries), 128):
        own = query_ids[i:i + 128, None] == ids[rank][None, :]
        for j, (rows, scores, read, resolved) in enumerate(lists.top(queries[i:i + 128].astype(kind), own, k), i):
            out.append((np.full(len(rows), j), rank[rows], scores.astype(np.int64), np.full(len(rows), read), np.full(len(rows), resolved)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 5


def _by_integers(queries, query_ids, cands, ids, k):
    """Scores too large for doubles: Python integers."""
    rest = np.argsort(ids, kind="stable")
    score = queries.astype(object) @ cands[rest].astype(object).T
    where, which, out = [], [], []
    for i, row in enumerate(score):
        open_ = [j for j in range(len(rest)) if ids[rest[j]] != query_ids[i]]
        for j in sorted(open_, key=lambda j: -row[j])[:k]:
            where.append(i), which.append(rest[j]), out.append(row[j])
    return np.array(where, dtype=np.int64), np.array(which, dtype=np.int64), np.array(out, dtype=object)


def floor_256(vec: Column) -> Column:
    """Components as floor(256 x) with x as double; null for vectors that are null or hold null or
    non-finite components."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(finite, F.transform(vec, lambda x: F.floor(F.lit(256) * x.cast("double")).cast("long")))


def nra_top_k(vectors: DataFrame, vec_id: str, components: Column, is_query: Column, k: int = 5,
              candidate_block: int = 16384, query_block: int = 256) -> DataFrame:
    """The k rows of ``vectors`` with the largest integer inner product for every query row:
    (query_id, rank from 1, vec_id, score, n_read, n_resolved), ties to the smaller id.  ``n_read`` counts the list
    positions the query read in the result's block of candidates, ``n_resolved`` the candidates it resolved there.

    ``components``: array of integers.  Rows where it is null, or whose id is null, take no part.
    Repeated rows (equal id and vector) count once; rows with the query's id are never its results.
    Vectors of different lengths have no inner product and do not meet; empty vectors score 0 with
    each other.  Other columns are ignored, and an empty table gives no rows.
    """
    rows = vectors.select(F.col(vec_id).alias("id"), components.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).groupBy("id", "v").agg(F.max("q").alias("q"))
    rows = written(rows.withColumn("dim", F.size("v")), "nra")
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("q").alias("nq"))
    sizes = sizes.select("dim", F.ceil(F.col("n") / candidate_block).alias("nc"), F.greatest(F.lit(1), F.ceil(F.col("nq") / query_block)).alias("nb"))
    rows = rows.join(sizes, "dim")  # one row a vector length; AQE broadcasts it
    h = F.xxhash64("id")
    cands = rows.select("dim", "id", "v", F.pmod(h, "nc").cast("int").alias("cb"), F.explode(F.sequence(F.lit(0), F.col("nb").cast("int") - 1)).alias("qb"))
    cands = cands.select(*[F.col(c).alias(c) for c in cands.columns])  # columns apart from those of the queries
    asks = rows.where("q").select("dim", "id", "v", F.explode(F.sequence(F.lit(0), F.col("nc").cast("int") - 1)).alias("cb"), F.pmod(F.xxhash64("id", F.lit(1)), "nb").cast("int").alias("qb"))

    columns = ["query_id", "vec_id", "score", "n_read", "n_resolved"]

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in columns}).astype("int64")
        ask, ids = left["id"].to_numpy(), right["id"].to_numpy()
        made = lambda s: np.stack(s.to_list()).reshape(len(s), -1).astype(np.int64)
        i, j, score, read, resolved = top_k_block(made(left["v"]), ask, made(right["v"]), ids, k)
        return pd.DataFrame(dict(zip(columns, (ask[i], ids[j], score.astype(np.int64), read, resolved), strict=True)))

    schema = ", ".join(f"{c} long" for c in columns)
    found = asks.groupBy("dim", "qb", "cb").cogroup(cands.groupBy("dim", "qb", "cb")).applyInPandas(meet, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.groupBy("query_id", "vec_id", "score").agg(F.max("n_read").alias("n_read"), F.max("n_resolved").alias("n_resolved"))
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score", "n_read", "n_resolved")
