"""Hard-negative mining by coordinate pruning in length buckets.

Vectors become integers floor(scale * x).  The index deals them into groups by a
hash of the id; in a group they stand by descending length, cut into buckets,
and each bucket holds a sorted list of every coordinate.  An anchor q asks a
bucket of greatest length l for scores of at least t: the angle to q is then at
most arccos(t / |q| l), which leaves each coordinate a feasible range.  The
ranges of the anchor's focus coordinates (its largest) are looked up in the
sorted lists; the rows in the shortest list that lie in the other ranges too are
verified by their exact inner product.  Buckets that cannot reach t are skipped,
and t rises with what was found.

Two searches: the best rows of the anchor's label (its positives), then, for
each positive, the best rows of other labels whose score is a given share of the
positive's.  Results of the groups are merged by a window per anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.scratch import written

#: Rows of a group and of a length bucket, anchors of a task, focus coordinates of an anchor.
GROUP, BUCKET, PART, FOCUS = 16_384, 1_024, 1_024, 4
INDEX = "grp int, bucket int, dims int, ids binary, labels binary, x binary, orders binary"
#: Widens every range: floating error of the bounds is far below it.
_SLACK = 1e-9


def usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """(vec_id, label, v array<long>) of rows with an id, a label and a vector of finite numbers."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~bad)
            .select("vec_id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v")))


def _matrix(lists: pa.Array, dims: int = 0) -> np.ndarray:
    """Rows of integers, short ones filled with 0."""
    n = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(n), max(dims, int(n.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < n[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _buckets(rows: int):
    def run(table: pa.Table) -> pa.Table:
        """One group: buckets by descending length with the rows in the order of each coordinate."""
        table = table.combine_chunks()
        ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
        x = _matrix(table.column("v").combine_chunks())
        # of rows that repeat an id, the one with the least label, then vector
        order = np.lexsort((*x.T[::-1], labels, ids))
        order = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
        length = (x.astype(np.float64) ** 2).sum(axis=1)
        order = order[np.argsort(-length[order], kind="stable")]
        out = []
        for k, a in enumerate(range(0, len(order), rows)):
            own = order[a:a + rows]
            part = x[own]
            out.append({"grp": table.column("grp")[0].as_py(), "bucket": k, "dims": x.shape[1],
                        "ids": ids[own].astype("<i8").tobytes(), "labels": labels[own].astype("<i8").tobytes(),
                        "x": part.astype("<i8").tobytes(),
                        "orders": np.argsort(part, axis=0, kind="stable").T.astype("<u4").tobytes()})
        return pa.Table.from_pylist(out, pa.schema([("grp", pa.int32()), ("bucket", pa.int32()), ("dims", pa.int32()),
                                                    *[(c, pa.binary()) for c in ("ids", "labels", "x", "orders")]]))
    return run


class Bucket:
    def __init__(self, row: dict, wide: int):
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        n, dims = len(self.ids), row["dims"]
        self.x = np.zeros((n, wide), np.int64)
        self.x[:, :dims] = np.frombuffer(row["x"], "<i8").reshape(n, dims)
        self.order = np.zeros((wide, n), np.int64)
        self.order[:] = np.arange(n)
        self.order[:dims] = np.frombuffer(row["orders"], "<u4").reshape(dims, n)
        self.sorted = np.take_along_axis(self.x.T, self.order, axis=1)
        self.top = float(np.sqrt((self.x.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))


class Anchors:
    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        self.focus = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :FOCUS]
        own = np.take_along_axis(x, self.focus, axis=1)
        self.angle = np.arcsin(np.clip(own / np.maximum(self.length, 1e-300)[:, None], -1, 1))


def candidates(q: Anchors, b: Bucket, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) pairs: at least all with an inner product of ``least`` (one per anchor)."""
    most = q.length * b.top
    live = np.flatnonzero(least <= most * (1 + _SLACK) + _SLACK)
    if not len(live) or not len(b.ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    share = np.clip(least[live] / np.maximum(most[live], 1e-300), -1, 1)
    reach = np.arccos(share)[:, None] + 1e-7  # of the angle; arccos loses half the digits near 1
    angle, focus = q.angle[live], q.focus[live]
    low = b.top * np.sin(np.maximum(angle - reach, -np.pi / 2)) - b.top * _SLACK - _SLACK
    high = b.top * np.sin(np.minimum(angle + reach, np.pi / 2)) + b.top * _SLACK + _SLACK
    first, last = np.zeros(focus.shape, np.int64), np.full(focus.shape, len(b.ids))
    for f in np.unique(focus):
        at = focus == f
        first[at] = np.searchsorted(b.sorted[f], low[at], "left")
        last[at] = np.searchsorted(b.sorted[f], high[at], "right")
    size = np.maximum(last - first, 0)
    if not focus.shape[1]:
        return np.repeat(live, len(b.ids)), np.tile(np.arange(len(b.ids)), len(live))
    short = size.argmin(axis=1)
    pick = np.arange(len(live)), short
    n = size[pick]
    who = np.repeat(np.arange(len(live)), n)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[pick], n)
    row = b.order[focus[pick][who], place]
    for k in range(focus.shape[1]):  # intersect with the other ranges
        value = b.x[row, focus[who, k]]
        on = (value >= low[who, k]) & (value <= high[who, k])
        who, row = who[on], row[on]
    return live[who], row


def verified(q: Anchors, b: Bucket, who: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Exact inner products of the pairs."""
    exact = q.length.max(initial=0) * b.top < 1 << 52
    if exact and len(who) * 8 > len(q.ids) * len(b.ids):  # many pairs: one product of matrices holds them all
        return (q.x.astype(np.float64) @ b.x.T.astype(np.float64))[who, row].astype(np.int64)
    out = np.empty(len(who), np.int64)
    for a in range(0, len(who), 1 << 14):
        s = slice(a, a + (1 << 14))
        out[s] = np.einsum("ij,ij->i", q.x[who[s]], b.x[row[s]])
    return out


class Best:
    """The k best (score, then smaller id) of each owner."""

    def __init__(self, owners: int, k: int):
        self.k, self.owners = k, owners
        self.owner, self.ids, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, owner: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        owner, ids, score = (np.concatenate(p) for p in ((self.owner, owner), (self.ids, ids), (self.score, score)))
        order = np.lexsort((ids, -score, owner))
        owner, ids, score = owner[order], ids[order], score[order]
        keep = np.arange(len(owner)) - np.searchsorted(owner, owner) < self.k
        self.owner, self.ids, self.score = owner[keep], ids[keep], score[keep]

    def least(self, start: np.ndarray) -> np.ndarray:
        """What a row must score to come in: the k-th best, or ``start`` while there are fewer."""
        out = start.astype(np.float64)
        at = np.flatnonzero(np.arange(len(self.owner)) - np.searchsorted(self.owner, self.owner) == self.k - 1)
        out[self.owner[at]] = np.maximum(out[self.owner[at]], self.score[at])
        return out


def _met(index: pa.Table, anchors: pa.Table) -> tuple[list[Bucket], Anchors]:
    rows = sorted(index.to_pylist(), key=lambda r: r["bucket"])
    x = _matrix(anchors.column("v").combine_chunks(), max(r["dims"] for r in rows))
    q = Anchors(anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy(), x)
    return [Bucket(r, x.shape[1]) for r in rows], q


def _positives(k: int):
    def run(index: pa.Table, anchors: pa.Table) -> pa.Table:
        best, ids = Best(0, k), np.zeros(0, np.int64)
        if index.num_rows and anchors.num_rows:
            buckets, q = _met(index, anchors)
            best, ids = Best(len(q.ids), k), q.ids
            start = np.full(len(q.ids), -np.inf)
            for b in buckets:
                least = best.least(start)
                who, row = candidates(q, b, least)
                on = (q.labels[who] == b.labels[row]) & (q.ids[who] != b.ids[row])
                who, row = who[on], row[on]
                score = verified(q, b, who, row)
                on = score >= least[who]
                best.add(who[on], b.ids[row[on]], score[on])
        return pa.table({"vec_id": ids[best.owner], "positive_id": best.ids, "positive_score": best.score})
    return run


def _negatives(k: int, low: int, high: int):
    def run(index: pa.Table, anchors: pa.Table) -> pa.Table:
        best, ids, slot, slot_id, slot_score = Best(0, k), *(np.zeros(0, np.int64) for _ in range(4))
        if index.num_rows and anchors.num_rows:
            buckets, q = _met(index, anchors)
            ids = q.ids
            lists = anchors.column("positives").combine_chunks()
            n = np.diff(lists.offsets.to_numpy())
            slot = np.repeat(np.arange(len(n)), n)  # its anchor
            slot_id, slot_score = (lists.flatten().field(i).to_numpy() for i in (0, 1))
            # of the negative's score: low and high percent, rounded inwards, without going past 64 bits
            whole, rest = slot_score // 100, slot_score % 100
            least, most = whole * low - (-rest * low // 100), whole * high + rest * high // 100
            best = Best(len(slot), k)
            rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
            for b in buckets:
                now = best.least(least.astype(np.float64))
                now[least > most] = np.inf
                ask = np.full(len(ids), np.inf)
                np.minimum.at(ask, slot, now)
                who, row = candidates(q, b, ask)
                on = q.labels[who] != b.labels[row]
                who, row = who[on], row[on]
                score = verified(q, b, who, row)
                on = score >= ask[who]
                who, row, score = who[on], row[on], score[on]
                at = np.searchsorted(slot, who)
                for j in range(int(rank.max(initial=-1)) + 1):  # each pair to the anchor's j-th positive
                    s = at + j
                    on = (j < n[who])
                    on[on] &= (score[on] >= now[s[on]]) & (score[on] <= most[s[on]])
                    best.add(s[on], b.ids[row[on]], score[on])
        o = best.owner
        return pa.table({"anchor_id": ids[slot[o]], "positive_id": slot_id[o], "positive_score": slot_score[o],
                         "negative_id": best.ids, "negative_score": best.score})
    return run


def hard_negatives(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label: str | Column = "label",
                   every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
                   group: int = GROUP) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``.  An anchor's
    positives are its ``positives`` best other rows of its label; for each, the
    ``negatives`` best rows of another label that score from ``low`` to ``high``
    percent of the positive.  Score: integer inner product, ties to the smaller id.

    Rows with a null id or label, or a vector that is null or holds a null or
    non-finite number, take no part.  Rows that repeat an id count once: the one
    with the least label, then vector.  Vectors of other lengths score over
    their common dimensions; equal vectors under other ids are rows like any
    other.  Other columns are not read.  No usable row, or no row that can be a
    positive or negative: no rows.  Scores are longs: 2^63 is their limit.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = usable(vectors, id_col, vector_col, label, scale)
    groups = max(1, -(-rows.count() // group))
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    index = written(dealt.groupBy("grp").applyInArrow(_buckets(BUCKET), INDEX), "length-buckets")
    parts = max(1, -(-groups * group // (every * PART)))
    anchors = (rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
               .select("vec_id", "r.label", "r.v"))

    def meet(asked: DataFrame, run, schema: str) -> DataFrame:
        """Every part of the anchors with every group of the index."""
        asked = (asked.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int"))
                 .withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
        spread = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        return spread.groupBy("grp", "part").cogroup(asked.groupBy("grp", "part")).applyInArrow(run, schema)

    found = meet(anchors, _positives(positives), "vec_id long, positive_id long, positive_score long")
    order = Window.partitionBy("vec_id").orderBy(F.desc("positive_score"), "positive_id")
    found = (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
             .groupBy("vec_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")))
    asked = written(anchors.join(found, "vec_id"), "positives")
    out = meet(asked, _negatives(negatives, low, high),
               "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def shifted_label(id_col: str = "vec_id", label_col: str = "label") -> Column:
    """The label; where the id is divisible by 7, (label + 1) % 10."""
    return F.when(F.col(id_col) % 7 == 0, (F.col(label_col) + 1) % 10).otherwise(F.col(label_col))


ORACLE = """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), pairs AS (
      SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
    ), positives AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
      SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
      FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score)
    WHERE rank <= 3"""
