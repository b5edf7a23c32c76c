"""Exact top-k inner product by exhaustive term-at-a-time accumulation.

A dimension is a term. Candidates of a block are inverted into one posting list
per term (positions and integer weights, zeros left out). For a tile of query
rows every term's postings scatter ``weight x query weight`` into a dense score
array; a partition selection keeps each query's k best of the block, and a
window over the k survivors per block merges the blocks.

Both sides are cut into blocks by a hash of the id and every (query block,
candidate block) pair is one small task, so no side is ever broadcast or held
whole: a task holds two blocks and a score tile.

Defined results: a vector that is null, or holds a null or non-finite
component, takes no part; vectors of different length meet on the dimensions
both have; a candidate is every row with another id than the query (rows that
repeat an id each count as candidates); exact repeats of a query row are
answered once; ties go to the smaller id; a query with fewer than k candidates
gets all of them; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.util import need, pinned

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
TILE = 64

OUT = "query_id long, query_key long, vec_id long, score long"


def quantized(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(id, w array<long>) of the usable rows: floor(scale * x) per component."""
    v = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return (df.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).filter(~bad)
            .select(F.col(vec_id).cast("long").alias("id"), v.alias("w")))


def _matrix(rows: pd.Series) -> np.ndarray:
    dims = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), dims), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def accumulate(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores (candidates x queries), one term's postings after another."""
    terms = min(q.shape[1], c.shape[1])
    peak = terms * int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0))
    kind = np.int32 if peak < 2**31 else np.int64
    scores = np.zeros((len(c), len(q)), dtype=kind)
    for t in range(terms):
        posts = np.flatnonzero(c[:, t])
        asked = np.flatnonzero(q[:, t])
        if not len(posts) or not len(asked):
            continue
        add = np.multiply.outer(c[posts, t].astype(kind), q[asked, t].astype(kind))
        if len(asked) == len(q):
            if len(posts) == len(c):
                scores += add
            else:
                scores[posts] += add
        else:
            scores[np.ix_(posts, asked)] += add
    return scores


def select_best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k best of one score column; ``ids`` ascend, so ties keep the smaller id."""
    ok = np.flatnonzero(ids != own)
    if len(ok) <= k:
        return ok
    s = scores[ok]
    cut = np.partition(s, len(s) - k)[len(s) - k]
    above = np.flatnonzero(s > cut)
    level = np.flatnonzero(s == cut)[: k - len(above)]
    return ok[np.concatenate([above, level])]


def _block_pair(k: int):
    def score(queries: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: np.zeros(0, dtype=np.int64) for c in ("query_id", "query_key", "vec_id", "score")})
        if not len(queries) or not len(cands):
            return empty
        cands = cands.sort_values("id", kind="stable")
        ids, c, q = cands["id"].to_numpy(), _matrix(cands["w"]), _matrix(queries["w"])
        qid, qkey = queries["id"].to_numpy(), queries["key"].to_numpy()
        out = []
        for at in range(0, len(q), TILE):
            scores = accumulate(q[at:at + TILE], c)
            for j in range(scores.shape[1]):
                best = select_best(scores[:, j], ids, qid[at + j], k)
                out.append(pd.DataFrame({"query_id": qid[at + j], "query_key": qkey[at + j],
                                         "vec_id": ids[best], "score": scores[best, j].astype(np.int64)}))
        return pd.concat(out, ignore_index=True) if out else empty

    return score


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256,
                vec_id: str = "vec_id", vector: str = "embedding",
                query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of ``vectors`` for every row of ``queries``."""
    need(vectors, vec_id, vector)
    need(queries, vec_id, vector)
    cands = pinned(quantized(vectors, vec_id, vector, scale))
    asked = pinned(quantized(queries, vec_id, vector, scale).dropDuplicates(["id", "w"])
                   .withColumn("key", F.xxhash64("w")))
    nq, nc = asked.count(), cands.count()
    blocks_q, blocks_c = max(1, math.ceil(nq / query_block)), max(1, math.ceil(nc / candidate_block))
    spread = lambda n: F.pmod(F.xxhash64("id", "w"), F.lit(n)).cast("int")
    left = (asked.withColumn("qb", spread(blocks_q))
            .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(blocks_c - 1)))))
    right = (cands.withColumn("cb", spread(blocks_c))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks_q - 1)))))
    found = (left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(_block_pair(k), OUT))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
