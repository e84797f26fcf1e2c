"""Exact top-k by inner product over an impact-ordered, score-at-a-time index.

Vectors become integers floor(scale * x).  The index deals them into blocks by
a hash of the id; a block keeps its postings (vector, dimension, value) in
segments of equal quantised impact, the bit length of |value|.  A block of
queries reads a block's segments by descending impact and adds each segment to
all its scores.  What the unread segments can still add to a pair is at most
|q| |rest of x|, from the stored lengths of the rests, so after a segment the
queries' k-th best lower bounds show which vectors may still be members.  Reading
stops only when those are few; they alone are rescored exactly, on all
postings.  Block results are merged by a window per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.scratch import written

#: Vectors of an index block, queries of a query block, query blocks that meet an index block in one task.
BLOCK, QUERY_BLOCK, QUERY_GROUP = 2048, 1024, 8
#: Possible members per query below which the rest is rescored instead of read.
FEW = 4
INDEX = "block int, ids array<long>, dims int, places array<binary>, values array<binary>, rests binary"


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v array<long>) of rows with an id and a vector of finite numbers."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~bad)
            .select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v")))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of integers, short ones filled with 0."""
    n = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(n), int(n.max()) if len(n) else 0), np.int64)
    out[np.arange(out.shape[1]) < n[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _segments(table: pa.Table) -> pa.Table:
    """One index block: posting segments by descending impact, and what they leave."""
    table = table.combine_chunks().sort_by("vec_id")
    x = _matrix(table.column("v").combine_chunks())
    flat = x.ravel()
    impact = np.frexp(np.abs(flat).astype(np.float64))[1]
    left = x.astype(np.float64) ** 2
    rest = left.sum(axis=1)
    places, values, rests = [], [], []
    for level in np.unique(impact[flat != 0])[::-1]:
        at = np.flatnonzero((impact == level) & (flat != 0))
        places.append(at.astype("<u4").tobytes())
        values.append(flat[at].astype("<i8").tobytes())
        rest = rest - np.bincount(at // x.shape[1], left.ravel()[at], len(x))
        rests.append(np.sqrt(np.maximum(rest, 0)))
    return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()),
                     "ids": pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                     "dims": pa.array([x.shape[1]], pa.int32()), "places": pa.array([places], pa.list_(pa.binary())),
                     "values": pa.array([values], pa.list_(pa.binary())),
                     "rests": pa.array([np.array(rests, "<f8").tobytes()], pa.binary())})


def build_index(vectors: DataFrame, blocks: int) -> DataFrame:
    """Index blocks of (vec_id, v) rows, ``blocks`` of them (fewer if some stay empty)."""
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(_segments, INDEX)


def best(ids: np.ndarray, dims: int, places: list[bytes], values: list[bytes], rests: np.ndarray, query_ids: np.ndarray,
         queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vec_id, score): of each query, at least all vectors of the block
    that can be among its k best (ties to the smaller id), with exact scores."""
    wide = max(dims, queries.shape[1])
    q = np.zeros((len(queries), wide), np.int64)
    q[:, :queries.shape[1]] = queries
    q = q[:, :dims] if dims else q[:, :0]
    peak = max((int(np.abs(np.frombuffer(v, "<i8")).max()) for v in values), default=0)
    bound = int(np.abs(q).max(initial=0)) * peak * max(dims, 1)
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64  # exact sums of integers
    qk = q.astype(kind)
    own = query_ids[:, None] == ids[None, :]
    score = np.zeros((len(q), len(ids)), kind)
    norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    read = np.zeros(len(ids) * dims, np.int64)
    maybe = ~own
    for level, (place, value) in enumerate(zip(places, values)):
        at, v = np.frombuffer(place, "<u4"), np.frombuffer(value, "<i8")
        read[at] = v
        part = np.zeros(len(ids) * dims, kind)
        part[at] = v
        score += qk @ part.reshape(len(ids), dims).T
        slack = norm[:, None] * rests[level][None, :] * (1 + 1e-6) + 1e-6
        if len(ids) > k and level >= 1 and level + 1 < len(places):
            low = np.where(own, -np.inf, score - slack)
            kth = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k]
            maybe = ~own & (score + slack >= kth[:, None])
            if maybe.sum() <= FEW * k * len(q):
                break
    row, col = np.nonzero(maybe)
    if len(places) and level + 1 < len(places):  # proven: no other vector is a member
        rest = np.zeros(len(ids) * dims, np.int64)
        for place, value in zip(places[level + 1:], values[level + 1:]):
            rest[np.frombuffer(place, "<u4")] = np.frombuffer(value, "<i8")
        full = (read + rest).reshape(len(ids), dims)
        exact = np.empty(len(row), np.int64)
        for a in range(0, len(row), 1 << 16):
            b = slice(a, a + (1 << 16))
            exact[b] = (q[row[b]] * full[col[b]]).sum(axis=1)
    else:
        exact = score[row, col].astype(np.int64)
        if len(ids) > k:  # all are exact: keep the k best, and ties of the last
            masked = np.where(own, -np.inf if kind != np.int64 else np.iinfo(np.int64).min, score)
            kth = np.partition(masked, len(ids) - k, axis=1)[:, len(ids) - k]
            keep = score[row, col] >= kth[row]
            row, col, exact = row[keep], col[keep], exact[keep]
    order = np.lexsort((ids[col], -exact, row))
    row, col, exact = row[order], col[order], exact[order]
    first = np.searchsorted(row, row)
    keep = np.arange(len(row)) - first < k
    return query_ids[row[keep]], ids[col[keep]], exact[keep]


def _meet(k: int):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if index.num_rows and queries.num_rows:
            b = index.to_pylist()[0]
            ids = np.array(b["ids"], np.int64)
            rests = np.frombuffer(b["rests"], "<f8").reshape(len(b["places"]), len(ids))
            x = _matrix(queries.column("v").combine_chunks())
            qid = queries.column("vec_id").to_numpy()
            for a in range(0, len(qid), QUERY_BLOCK):
                out.append(best(ids, b["dims"], b["places"], b["values"], rests, qid[a:a + QUERY_BLOCK],
                                x[a:a + QUERY_BLOCK], k))
        q, v, s = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        return pa.table({"query_id": q, "vec_id": v, "score": s})
    return run


def top_k(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20,
          scale: int = 64, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row whose
    id is divisible by ``every``, by integer inner product, ties to the smaller id.

    Rows with a null id, or a vector that is null or holds a null or non-finite
    number, take no part.  Vectors of other lengths score over their common
    dimensions; an empty vector scores 0.  Rows that repeat an id never meet
    each other; repeated vectors under other ids are results like any other.
    """
    rows = usable(vectors, id_col, vector_col, scale)
    blocks = max(1, -(-rows.count() // block))
    index = written(build_index(rows, blocks), "impact-index")
    groups = max(1, -(-blocks * block // (every * QUERY_BLOCK * QUERY_GROUP)))
    queries = (rows.where(F.col("vec_id") % every == 0)
               .withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int"))
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    spread = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = (spread.groupBy("block", "part").cogroup(queries.groupBy("block", "part"))
             .applyInArrow(_meet(k), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
