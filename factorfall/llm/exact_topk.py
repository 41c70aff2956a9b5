"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into segments, and each segment is described by its mean and
deviation, at several resolutions. By Cauchy and Schwarz the squared distance of
two vectors is at least the sum over segments of length * ((difference of
means)^2 + (difference of deviations)^2); as |q|^2 and |x|^2 are known exactly,
that bounds the inner product from above. Bounds go from coarse to fine; what is
left after the finest gets its exact score.

Queries and candidates are dealt into blocks by a hash of their row, and every
(query block, candidate block) pair is one group of bounded size. A group gives
its queries' best k, and a last step merges those over candidate blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factorfall.session import stage_table

K = 5
SCALE = 256
SEGMENTS = (4, 8, 16, 32)
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x, copy): components as floor(SCALE * x).

    Left out are null ids, null or empty vectors, and vectors with a null or
    non-finite component. Every row counts, those of one id and of one vector too.
    """
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE))
    finite = F.forall(embedding, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    rows = vectors.filter(F.col(vec_id).isNotNull() & (F.size(embedding) > 0) & finite)
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("x"))
    # Equal rows are told apart by number, the same in any run.
    copies = rows.groupBy("vec_id", "x").agg(F.count("*").alias("n"))
    return copies.select("vec_id", "x", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows of (mean * sqrt(length), deviation * sqrt(length)) per segment: their squares add up to |x|^2."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1]))
    means = np.stack([x[:, p].mean(axis=1) * math.sqrt(len(p)) for p in parts], axis=1)
    spreads = np.stack([x[:, p].std(axis=1) * math.sqrt(len(p)) for p in parts], axis=1)
    return np.concatenate([means, spreads], axis=1)


def exact_scores(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of whole vectors: in doubles while no sum can reach 2^53, else in Python's integers."""
    if np.abs(c).max(initial=0).astype(float) * np.abs(q).astype(float).sum() < 2**52:
        return (c.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return c.astype(object) @ q.astype(object)


def best_of_block(
    q_ids: np.ndarray, q_whole: np.ndarray, c_ids: np.ndarray, c_whole: np.ndarray, k: int = K, own: np.ndarray | None = None
) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of each query's best k in the block; ties to the smaller candidate id.

    Vectors hold whole numbers. A query is no candidate of its own: ``own`` is
    its place among the candidates, -1 where it is not one; without it ids tell.
    """
    q, c = q_whole.astype(np.float64), c_whole.astype(np.float64)
    levels = [s for s in SEGMENTS if s < c.shape[1]]
    q_stats, c_stats = ([segment_statistics(v, s) for s in levels] for v in (q, c))
    out = []
    # Half of (|q|^2 + |x|^2 - lower bound of the distance) is the product of the statistics.
    coarse = q_stats[0] @ c_stats[0].T if levels else None
    q_norm, c_norm = np.sqrt((q * q).sum(axis=1)), np.sqrt((c * c).sum(axis=1))
    for i, q_id in enumerate(q_ids):
        alive = np.flatnonzero(c_ids != q_id if own is None else np.arange(len(c_ids)) != own[i])
        if len(alive) > k and levels:
            # Rounding of the bounds and of the scores they are held against is far below this.
            slack = 1e-9 * (1 + q_norm[i] * c_norm.max())
            upper = coarse[i, alive]
            # Exact scores of the most promising give a score that the best k reach.
            probe = alive[np.argpartition(-upper, k - 1)[:k]]
            reached = (c[probe] @ q[i]).min()
            alive = alive[upper + slack >= reached]
            for level in range(1, len(levels)):
                upper = c_stats[level][alive] @ q_stats[level][i]
                if len(alive) > 4 * k:
                    probe = alive[np.argpartition(-upper, k - 1)[:k]]
                    reached = max(reached, (c[probe] @ q[i]).min())
                alive = alive[upper + slack >= reached]
        scores = exact_scores(c_whole[alive], q_whole[i])
        if len(alive) > k:
            # All that reach the k-th best score, so that ties go by id.
            at_least = np.sort(scores)[len(scores) - k]
            keep = scores >= at_least
            alive, scores = alive[keep], scores[keep]
        order = np.lexsort((c_ids[alive], -scores))[:k]
        out += [(int(q_id), int(c_ids[alive[j]]), int(scores[j])) for j in order]
    return out


def _search(key: tuple, queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    found = []
    if len(queries) and len(candidates):
        # Vectors of different lengths have no product.
        sizes = set(queries["x"].map(len)) & set(candidates["x"].map(len))
        for size in sorted(sizes):
            mine, theirs = (t[t["x"].map(len) == size] for t in (queries, candidates))
            q, c = (np.stack(t["x"].to_list()) for t in (mine, theirs))
            place = {r: at for at, r in enumerate(zip(theirs["vec_id"], theirs["row"]))}
            rows = list(zip(mine["vec_id"], mine["row"]))
            best = best_of_block(np.arange(len(rows)), q, theirs["vec_id"].to_numpy(), c, k, np.array([place.get(r, -1) for r in rows]))
            found += [(*rows[i], c_id, score) for i, c_id, score in best]
    return pd.DataFrame(found, columns=["query_id", "query_row", "vec_id", "score"]).astype("int64")


def top_k(vectors: DataFrame, every: int = 50, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best candidates other than itself.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows but the query's own, so rows of one id are queries and candidates each.
    Vectors are compared with those of their own length. Empty tables give no
    rows; other columns are not read. Equal scores go to the smaller id. Scores
    are exact; one beyond 64 bits is an error.
    """
    clean = integer_vectors(vectors, vec_id, embedding)
    clean = stage_table(clean.select("vec_id", "x", F.xxhash64("vec_id", "x", "copy").alias("row")), "integer-vectors")
    queries = clean.filter(F.col("vec_id") % every == 0)
    n, n_queries = clean.count(), queries.count()
    c_blocks, q_blocks = max(1, math.ceil(n / CANDIDATE_BLOCK)), max(1, math.ceil(n_queries / QUERY_BLOCK))

    def dealt(rows: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod("row", F.lit(blocks)).alias(own)
        return rows.select("vec_id", "row", "x", block, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))).alias(other))

    q = dealt(queries, "q_block", q_blocks, "c_block", c_blocks)
    c = dealt(clean, "c_block", c_blocks, "q_block", q_blocks)
    keys = ("q_block", "c_block")
    pairs = q.groupBy(*keys).cogroup(c.groupBy(*keys))
    found = pairs.applyInPandas(lambda key, left, right: _search(key, left, right, k), "query_id long, query_row long, vec_id long, score long")
    best = W.partitionBy("query_id", "query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
