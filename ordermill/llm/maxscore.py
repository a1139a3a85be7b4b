"""Exact top-k inner products over integer vectors with MaxScore.

Vectors are quantized, dealt into shards by hash of the id, and each query
block meets each shard in one task.  There every dimension is a query term
whose posting list is the shard's column.  A contribution is measured from
the smallest the shard allows, so it is never negative, and its bound is
known from the column's range.  Terms are taken by falling bound: the
essential ones (those without which a vector could still not reach the
threshold) are traversed for all vectors, the others are probed in steps,
only for vectors whose score so far plus the bounds left is still
competitive (ties included).  The best k of each shard merge by score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD, QUERY_BLOCK, STEP = 8192, 4096, 16
EXACT = float(1 << 53)
LONGS = float(1 << 63)


def quantized(vectors: DataFrame, id_col="vec_id", vec_col="embedding", scale=64) -> DataFrame:
    """vec_id, v: floor(scale * x) of every component; vectors that are null or
    hold null, NaN or infinite components are left out."""
    x = F.col(vec_col)
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double"))
                     & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    return vectors.where(x.isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v"))


def _matrix(table, dims):
    lists = table.column("v").combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    if len(size) and (size == dims).all():
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _search(cand, ids, query, own, k):
    """Best k (score, row) of one query; ``cand`` is dimension-major."""
    dims, n = cand.shape
    lo, hi = cand.min(axis=1), cand.max(axis=1)
    least = np.minimum(query * lo, query * hi)
    bound = np.maximum(query * lo, query * hi) - least
    terms = np.argsort(-bound, kind="stable")
    left = np.r_[np.cumsum(bound[terms][::-1])[::-1], 0]        # bounds of terms from here on
    base = least.sum()
    out = ids == own
    if n - out.sum() <= 0:
        return np.zeros(0, np.int64), np.zeros(0)
    first = terms[:STEP]
    part = query[first] @ cand[first] - least[first].sum()
    others = np.flatnonzero(~out)
    seed = others[np.argpartition(-part[others], min(k, len(others)) - 1)[:k]]
    full = query @ cand[:, seed]
    threshold = full.min() if len(seed) >= k else -np.inf
    # the essential prefix: what the remaining terms add cannot reach the threshold alone
    essential = max(min(STEP, dims), int(np.searchsorted(-(left + base), -threshold, side="left")))
    essential = min(essential, dims)
    rest = terms[STEP:essential]
    if len(rest):
        part = part + (query[rest] @ cand[rest] - least[rest].sum())
    alive = np.flatnonzero((part + base + left[essential] >= threshold) & ~out)
    part, done = part[alive], essential
    while done < dims and len(alive):
        step = terms[done: done + STEP]
        part = part + (query[step] @ cand[np.ix_(step, alive)] - least[step].sum())
        done += len(step)
        go = part + base + left[done] >= threshold
        alive, part = alive[go], part[go]
    score = part + base
    order = np.lexsort((ids[alive], -score))[:k]
    return alive[order], score[order]


def _search_all(cand, ids, query, own, k):
    """``_search`` where its bounds would not fit 63 bits: every score in full.  Sums that wrap
    on the way come out right if the score fits; one that does not is an error, never a wrong rank."""
    rows = np.flatnonzero(ids != own)
    size = np.abs(query.astype(np.float64) @ cand[:, rows].astype(np.float64))
    if size.max(initial=0) >= LONGS * (1 - 1e-9):
        raise OverflowError(f"a score of query {own} does not fit 63 bits")
    score = query @ cand[:, rows]
    order = np.lexsort((ids[rows], -score))[:k]
    return rows[order], score[order]


def _shard(k):
    def run(key, cands, queries):
        out = ([], [], [], [])
        if cands.num_rows and queries.num_rows:
            dims = max(int(np.diff(t.column("v").combine_chunks().offsets.to_numpy()).max()) for t in (cands, queries))
            x, q = _matrix(cands, dims), _matrix(queries, dims)
            big = max(dims, 1)
            for m in (x, q):
                big *= max(float(m.max(initial=0)), -float(m.min(initial=0)))
            if 4 * big < EXACT:                 # doubles hold these integers exactly, and multiply faster
                x, q = x.astype(np.float64), q.astype(np.float64)
            search = _search if 4 * big < LONGS else _search_all
            ids, qids = (t.column("vec_id").to_numpy() for t in (cands, queries))
            qkeys = queries.column("query_key").to_pylist()
            x = np.ascontiguousarray(x.T)
            for row, own, name in zip(q, qids, qkeys):
                if dims:
                    at, score = search(x, ids, row, own, k)
                else:
                    at = np.flatnonzero(ids != own)
                    at = at[np.argsort(ids[at], kind="stable")][:k]
                    score = np.zeros(len(at))
                out[0].extend([int(own)] * len(at))
                out[1].extend([name] * len(at))
                out[2].extend(ids[at].tolist())
                out[3].extend(int(s) for s in score.tolist())
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["query_id", "query_key", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each query vector its k best other
    vectors by inner product, ties to the smaller id.

    Both sides as ``quantized`` returns them.  Shorter vectors count as padded
    with zeros.  Rows that share the query's id are its own and no candidates;
    null ids take no part; repeated candidate rows are candidates each, equal
    query rows answer once.  Scores are exact while they fit 63 bits; one that
    does not fails the query."""
    vectors, queries = (d.where("vec_id is not null") for d in (vectors, queries))
    queries = queries.withColumn("query_key", F.xxhash64("v")).dropDuplicates(["vec_id", "query_key"])
    shards = vectors.count() // SHARD + 1
    blocks = queries.count() // QUERY_BLOCK + 1

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    cands = vectors.select(F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"),
                           every(blocks).alias("block"), "vec_id", "v")
    asks = queries.select(every(shards).alias("shard"),
                          F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int").alias("block"),
                          "vec_id", "v", "query_key")
    best = cands.groupBy("shard", "block").cogroup(asks.groupBy("shard", "block")).applyInArrow(
        _shard(k), "query_id long, query_key long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
