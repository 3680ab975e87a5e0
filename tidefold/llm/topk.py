"""Exact top-k by the threshold algorithm over sorted per-dimension lists.

Vectors become integers, ``floor(scale * x)``.  Queries and candidates are dealt into blocks,
and each task answers a block of queries on a block of candidates (a grid, so no task holds
all queries or all candidates).  For its candidates a task keeps one list per dimension,
sorted by value; a query reads it from the top where its weight is positive and from the bottom
where it is negative.  Rounds of sorted access double the depth.  After each round

* the candidates newly met by a query that goes on are scored (random access: their rows are gathered and multiplied with
  those queries as one matrix product); no others are,
* the threshold is the score of an imagined candidate that has the frontier value in every list,
* a query stops when its threshold is below its kth score: no candidate that it hasn't met
  can enter its result, not even on a tie.

The k best of each tile meet in a window per query, which keeps the k best by score, ties to the smaller id.

Defined results: vectors that are null or empty or hold null or non-finite components, and rows
with a null id, take no part; vectors of different length are never compared; a row is no
candidate for a query with its own id; an id that repeats is asked once (its least vector) and stays a candidate with each
of its rows; fewer candidates than k give fewer rows.  Scores are exact as long as they fit in 53 bits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

RESULT = "query_id long, vec_id long, score long"


def random_access(queries: np.ndarray, candidates: np.ndarray, own: np.ndarray, ids: np.ndarray, kind: type) -> np.ndarray:
    """The score of each query with each candidate; a query's own id gets none."""
    scores = queries.astype(kind) @ candidates.T.astype(kind)
    scores[own[:, None] == ids[None, :]] = -np.inf
    return scores


def threshold_search(queries: np.ndarray, candidates: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, first_depth: float = 1 / 16) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the (rows of candidates, scores) of its k best, in any order.

    own: the id of each query, which is left out; ids: of the candidates.  Of equal scores those with the smaller id win.
    """
    n, dims = candidates.shape
    by_id = np.argsort(ids, kind="stable")  # then the earlier of equal scores has the smaller id
    candidates, ids = candidates[by_id], ids[by_id]
    order = np.argsort(candidates, axis=0, kind="stable")
    lists = np.take_along_axis(candidates, order, axis=0)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(n)[:, None], axis=0)
    bits = [np.uint64(1) << np.arange(min(64, dims - d), dtype=np.uint64) for d in range(0, dims, 64)]

    def packed(flags: np.ndarray) -> list[np.ndarray]:
        return [(flags[:, 64 * i : 64 * i + 64] * b).sum(axis=1, dtype=np.uint64) for i, b in enumerate(bits)]

    up, down = packed(queries > 0), packed(queries < 0)
    large = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * dims
    kind = np.float32 if large < 2**24 else np.float64
    scores = np.full((len(queries), n), -np.inf, kind)
    scored = np.zeros(n, bool)
    found: list = [None] * len(queries)
    active = np.arange(len(queries))
    depth = max(k, int(n * first_depth))
    while len(active):
        depth = min(depth, n)
        near_top, near_bottom = packed(place >= n - depth), packed(place < depth)
        met = np.zeros((len(active), n), bool)
        for u, d, t, b in zip(up, down, near_top, near_bottom, strict=True):
            met |= ((u[active, None] & t[None, :]) | (d[active, None] & b[None, :])) != 0
        if depth == n:
            met[:] = True  # a query of zeros reads no list
        fresh = np.flatnonzero(met.any(axis=0) & ~scored)
        if len(fresh):
            scores[np.ix_(active, fresh)] = random_access(queries[active], candidates[fresh], own[active], ids[fresh], kind)
            scored[fresh] = True
        seen = np.where(met, scores[active], -np.inf)
        kth = np.partition(seen, n - k, axis=1)[:, n - k] if n > k else np.full(len(active), -np.inf, kind)
        q = queries[active]
        bound = np.maximum(q, 0) @ lists[n - depth] + np.minimum(q, 0) @ lists[depth - 1]
        done = (bound < kth) | (depth == n)
        for row in np.flatnonzero(done):
            s, least = seen[row], kth[row]
            best = np.flatnonzero(s > least)
            if len(best) < k:
                best = np.concatenate([best, np.flatnonzero((s == least) & np.isfinite(s))[: k - len(best)]]) if np.isfinite(least) else np.flatnonzero(np.isfinite(s))
            found[active[row]] = (by_id[best], s[best])
        active = active[~done]
        depth *= 2
    return found


def integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, lambda x: bad(x.cast("double"))), F.lit(False))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    candidate_block: int = 4096,
    query_block: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``vectors`` for which ``is_query`` holds."""
    rows = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col), scale).alias("v"), is_query.alias("q"))
    rows = materialise(rows.withColumn("dims", F.size("v")), "vectors")
    asked = rows.where("q").groupBy("id").agg(F.min("v").alias("v")).withColumn("dims", F.size("v"))
    n_candidates, n_queries = rows.count(), asked.count()
    wide, tall = max(1, -(-n_candidates // candidate_block)), max(1, -(-n_queries // query_block))

    def dealt(table: DataFrame, mine: str, blocks: int, other: str, times: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")
        return table.select("dims", block.alias(mine), F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias(other), "id", "v")

    left = dealt(rows, "c", wide, "q", tall).groupBy("dims", "c", "q")
    right = dealt(asked, "q", tall, "c", wide).groupBy("dims", "c", "q")

    def answer(candidates, queries):
        import pyarrow as pa

        if not candidates.num_rows or not queries.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in ("query_id", "vec_id", "score")})
        matrix = lambda t: t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        ids, own = candidates.column("id").to_numpy(), queries.column("id").to_numpy()
        found = threshold_search(matrix(queries), matrix(candidates), own, ids, k)
        rows = np.concatenate([r for r, _ in found])
        score = np.concatenate([s for _, s in found]).astype(np.int64)
        return pa.table({"query_id": np.repeat(own, [len(r) for r, _ in found]), "vec_id": ids[rows], "score": score})

    best = left.cogroup(right).applyInArrow(answer, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
