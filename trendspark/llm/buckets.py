"""From band buckets to groups of similar nodes, without all pairs of a bucket.

1. Every bucket names a pivot, the member that meets the most others over all
   its buckets; each other member is held against it, exactly.  A bucket of m
   members gives m - 1 pairs, and copies of one original meet in the original.
2. Union-find over the confirmed links.  A pair inside one component can add
   nothing; of a pair across two components both ends must still be *able* to
   reach the threshold: a part that no other node holds can't be shared, which
   bounds the overlap; with marks, two sets differ in at least as many parts as
   their marks in bits.  What is left is confirmed pair by pair.
3. Union-find over all confirmed links.

So the components are those of all candidate pairs, and only pairs that could
change them are formed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import U64, mix64
from trendspark.llm.components import components
from trendspark.llm.scratch import fits, written

#: Longs of a mark.
MARK = 16
MARKS = [f"mark{i}" for i in range(MARK)]


def marks(elements: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(sets, MARK) of int64: of each set of distinct hashes, for each of 64 *
    MARK bits whether an odd number of its elements fall on the bit.  An element
    in one of two sets only changes one bit, so the marks of two sets differ in
    no more bits than the sets in elements."""
    size, bits = np.diff(offsets), 64 * MARK
    out = np.empty((len(size), MARK), np.int64)
    for a in range(0, len(size), 256):
        n = size[a:a + 256]
        e = elements[offsets[a]:offsets[a + len(n)]] & U64(bits - 1)
        odd = np.bincount(np.repeat(np.arange(len(n)) * bits, n) + e.astype(np.int64), minlength=len(n) * bits) & 1
        out[a:a + len(n)] = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(-1, MARK)
    return out


def crowded(nodes: DataFrame, bands: int, rounds: int = 4) -> DataFrame:
    """(node, bucket, met) of the buckets with ``met`` >= 2 nodes.

    ``nodes``: (node, buckets array<long>), ``bands`` buckets a node.  The count
    is aggregated before the shuffle and joined back, so a hot bucket is no
    single task.  The bands are taken in ``rounds``: a bucket is of one band, and
    only a round's rows are on disk at a time.
    """
    found, step = None, -(-bands // rounds)
    for first in range(1, bands + 1, step):
        members = nodes.select("node", F.explode(F.slice("buckets", first, step)).alias("bucket"))
        many = written(members.groupBy("bucket").agg(F.count("*").alias("met")).where("met > 1"), "many")
        part = written(members.join(F.broadcast(many) if fits(many, 24) else many, "bucket"), "members")
        found = part if found is None else found.unionByName(part)
    return found


#: Nodes whose bands are dealt together, and the groups they are dealt to for each shuffle partition.
DEALT, PER_PARTITION = 1 << 15, 4
PACKED = "deal int, base long, places binary, hashes binary"


def packed(nodes: np.ndarray, bands: np.ndarray, deals: int) -> Iterator[pa.RecordBatch]:
    """The (nodes, bands) hashes as rows of ``PACKED``: a row has all hashes of a
    deal that nodes of one ``base`` hold, six bytes each: the node's place after
    the base and the hash's lower half; the upper half gives the deal."""
    base = nodes >> 16
    for b in np.unique(base):
        own = np.flatnonzero(base == b)
        h = bands[own].ravel().view(U64)
        deal = ((h >> U64(32)) % U64(deals)).astype(np.int32)
        order = np.argsort(deal, kind="stable")
        places = np.repeat((nodes[own] & 0xFFFF).astype(np.uint16), bands.shape[1])[order].tobytes()
        low = (h & U64(0xFFFFFFFF)).astype(np.uint32)[order].tobytes()
        found, first = np.unique(deal[order], return_index=True)
        ends = [*first[1:].tolist(), len(h)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(np.full(len(found), b << 16)),
             pa.array([places[2 * i:2 * j] for i, j in zip(first.tolist(), ends)], pa.binary()),
             pa.array([low[4 * i:4 * j] for i, j in zip(first.tolist(), ends)], pa.binary())],
            names=["deal", "base", "places", "hashes"])


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, bucket, met) of the hashes of a partition that two nodes or more
    hold; buckets of the same nodes are one."""
    nodes, keys = [np.zeros(0, np.int64)], [np.zeros(0, U64)]
    for batch in batches:
        for deal, base, places, hashes in zip(*(batch.column(i).to_pylist() for i in range(4))):
            nodes.append(np.frombuffer(places, np.uint16) + np.int64(base))
            keys.append(np.frombuffer(hashes, np.uint32) | U64(deal << 32))
    node, key = np.concatenate(nodes), np.concatenate(keys)
    del nodes, keys
    order = np.argsort(key)
    node, key = node[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    met = np.diff(np.concatenate([first, [len(key)]]))
    many = np.repeat(met > 1, met)
    node, met = node[many], met[met > 1]
    first = np.cumsum(met) - met
    bucket = mix64(np.add.reduceat(mix64(node.view(U64)), first) + met.view(U64)) if len(met) else np.zeros(0, U64)
    _, one = np.unique(bucket, return_index=True)
    kept = np.repeat(np.isin(np.arange(len(met)), one), met)
    node, bucket, met = node[kept], np.repeat(bucket, met)[kept], np.repeat(met, met)[kept]
    for a in range(0, len(node), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[a:a + (1 << 16)]) for x in (node, bucket.view(np.int64), met)],
                                         names=["node", "bucket", "met"])


def crowded_packed(nodes: DataFrame, banded: Callable[[int], Callable], members: str = "members") -> DataFrame:
    """(node, bucket, met) as :func:`crowded`, by one shuffle of six bytes a hash.

    ``banded(deals)`` makes of the Arrow batches of ``nodes`` rows of
    :func:`packed`.  A bucket stands for a set of nodes that share a hash: two
    hashes shared by the same nodes give one bucket.
    """
    deals = PER_PARTITION * int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.mapInArrow(banded(deals), PACKED).repartition("deal").mapInArrow(_meeting, "node long, bucket long, met long")
    return written(rows.distinct(), members)


def reachable(size_a: Column, size_b: Column, overlap: Column, num: int, den: int) -> Column:
    """den * overlap >= num * union, for the largest overlap that sizes allow."""
    most = F.least(overlap, size_a, size_b)
    return den * most >= num * (size_a + size_b - most)


def groups(members: DataFrame, sizes: DataFrame, own_of: Callable[[DataFrame], DataFrame] | None,
           confirm: Callable[[DataFrame], DataFrame], num: int, den: int, marked: DataFrame | None = None) -> DataFrame:
    """(node, component) of the nodes linked to another.

    ``members`` from :func:`crowded`; ``sizes``: (node, size) of each member,
    the parts of its set; ``own_of`` gives for (node) a table (node, own), how
    many of a node's parts no other node of the table holds (nodes absent:
    none; None: not asked, where marks bound the overlap as closely); ``confirm`` gives for (a, b) pairs (a, b, both, linked): the size of
    the intersection, and whether it reaches num/den of the union; ``marked``:
    (node, *MARKS) of each member, its :func:`marks`.
    """
    central = members.groupBy("node").agg(F.sum("met").alias("met")).join(sizes, "node")
    m = written(members.select("bucket", "node").join(central, "node"), "shares")
    pivot = m.groupBy("bucket").agg(F.min(F.struct((-F.col("met")).alias("order"), "node", "size")).alias("p"))
    led = written(m.join(pivot, "bucket").select("bucket", "node", "size", F.col("p.node").alias("pivot"),
                                                 F.col("p.size").alias("p_size")), "led")
    stars = (led.where(F.col("node") != F.col("pivot"))
             .where(reachable(F.col("size"), F.col("p_size"), F.col("size"), num, den))
             .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())
    stars = written(confirm(stars), "stars")
    links = stars.where("linked").select("a", "b")
    found = written(components(links), "components")

    c = led.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spread = c.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.min("size").alias("least")).where("lo != hi")
    open_ = written(c.join(spread.select("bucket", "least"), "bucket"), "open")
    # the smallest partner of the bucket allows the most: a node that fails with it fails with all
    owned = (open_.withColumn("own", F.lit(0).cast("long")) if own_of is None
             else open_.join(own_of(open_.select("node").distinct()), "node", "left"))
    left = (owned.withColumn("shared", F.col("size") - F.coalesce("own", F.lit(0)))
            .where(reachable(F.col("size"), F.greatest("least", F.ceil(F.col("size") * num / den)), F.col("shared"),
                             num, den))
            .withColumn("a", F.least("node", "pivot")).withColumn("b", F.greatest("node", "pivot"))
            .join(stars.select("a", "b", "both"), ["a", "b"], "left")
            # with the pivot unconfirmed nothing more is known; the pivot itself is all in itself
            .withColumn("inside", F.when(F.col("node") == F.col("pivot"), F.col("size")).otherwise(F.coalesce("both", "shared")))
            .withColumn("beside", F.when(F.col("node") == F.col("pivot"), F.lit(0))
                        .otherwise(F.when(F.col("both").isNull(), F.col("shared")).otherwise(F.col("shared") - F.col("both"))))
            .select("bucket", "node", "size", "shared", "component", "inside", "beside"))
    left = written(left if marked is None else left.join(marked.select("node", *MARKS), "node"), "left")
    x, y = left.alias("x"), left.alias("y")
    most = F.least(F.least("x.shared", "y.shared"), F.least("x.inside", "y.inside") + F.least("x.beside", "y.beside"))
    able = reachable(F.col("x.size"), F.col("y.size"), most, num, den)
    if marked is not None:
        apart = reduce(add, (F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in MARKS))
        # reachable() at (both sizes - apart) / 2 shared parts; a long condition with ``apart`` in it once is compiled
        able &= (den - num) * (F.col("x.size") + F.col("y.size")) >= (den + num) * apart
    rest = (x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") != F.col("y.component"))
                   & (F.col("x.node") < F.col("y.node")) & able)
            .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
            .join(stars.select("a", "b"), ["a", "b"], "left_anti"))
    more = written(confirm(written(rest, "rest")), "more").where("linked").select("a", "b")
    return components(links.union(more))
