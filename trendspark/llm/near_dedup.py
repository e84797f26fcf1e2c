"""MinHash near-dedup: SuperMinHash signatures of word shingles, banding, exact
verification, union-find groups.

A document's set holds its distinct shingles of five words (fewer words: the
whole sequence as one shingle; none: empty, linked with nothing).  Documents
with equal sets are one class, known by its smallest id, so copies are never
paired.  Class signatures of 125 slots are cut in 25 bands of 5: a pair at the
threshold of 0.85 shares no band with probability (1 - 0.85^5)^25 = 4e-7.
Candidates are confirmed on the full sets (see ``buckets``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.buckets import crowded, groups
from trendspark.llm.common import U64, by_bytes, mix64, reduce_sum, text_bytes, text_words
from trendspark.llm.scratch import fits, written
from trendspark.llm.superminhash import bands, signatures

WORDS = 5
BANDS, ROWS = 25, 5
_PLACE = [U64(x | 1) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                               0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the distinct shingles of every text, offsets)."""
    h, offsets = text_words(texts)
    if len(h) >= words:
        all_shingles = np.zeros(len(h) - words + 1, U64)
        for i in range(words):
            all_shingles += h[i:len(h) - words + 1 + i] * _PLACE[i]
        all_shingles = mix64(all_shingles)
    sets = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= words:
            sets.append(np.unique(all_shingles[a:b - words + 1]))
        elif b > a:
            whole = sum((h[a + i:a + i + 1] * _PLACE[i] for i in range(b - a)), np.full(1, U64(b - a)))
            sets.append(mix64(whole))
        else:
            sets.append(np.zeros(0, U64))
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, U64)), ends


def _profile(words: int, count: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            e, offsets = shingle_sets(text_bytes(batch.column(1)), words)
            b = bands(signatures(e, offsets, count * rows), count, rows)
            keys = [reduce_sum(mix64(e ^ _PLACE[i]), offsets).view(np.int64) for i in (6, 7)]
            lists = pa.ListArray.from_arrays(np.arange(0, b.size + 1, count, dtype=np.int32), b.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(keys[0]),
                                              pa.array(keys[1]), lists], names=["doc_id", "n", "k1", "k2", "buckets"])
    return run


def _shingles(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            e, offsets = shingle_sets(text_bytes(batch.column(1)), words)
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(nodes, np.diff(offsets))), pa.array(e.view(np.int64))],
                                             names=["node", "shingle"])
    return run


def _confirmed(words: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text_b"):
            shared, linked = [], []
            sets: dict[int, np.ndarray] = {}  # a pivot meets many rows of a batch
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            left, right = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                if a[i] not in sets:
                    sets.clear()
                    sets[a[i]] = shingle_sets([(left[i].as_py() or "").encode()], words)[0]
                x, y = sets[a[i]], shingle_sets([(right[i].as_py() or "").encode()], words)[0]
                both = len(np.intersect1d(x, y, assume_unique=True))
                shared.append(both)
                linked.append(both > 0 and den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared, pa.int64()),
                                              pa.array(linked, pa.bool_())], names=["a", "b", "both", "linked"])
    return run


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", num: int = 85, den: int = 100,
                    words: int = WORDS, count: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row of ``docs``.

    Links documents with den * intersection >= num * union; ``component_id`` is
    the smallest id reachable, itself included; ``kept`` marks that row.  Null
    and empty texts: 0 shingles, a component of their own.  A row with a null
    id links with nothing and is kept under a null component.  Ids are whole
    numbers; rows that repeat an id with the same text share its component.
    Other columns are ignored.
    """
    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    profile = written(rows_in.mapInArrow(_profile(words, count, rows),
                                         "doc_id long, n long, k1 long, k2 long, buckets array<long>"), "profile")
    classes = written(profile.where("n > 0 and doc_id is not null").groupBy("k1", "k2")
                      .agg(F.min(F.struct("doc_id", "n", "buckets")).alias("r"))
                      .select("k1", "k2", F.col("r.doc_id").alias("node"), F.col("r.n").alias("size"), "r.buckets"),
                      "classes")
    members = crowded(classes.select("node", "buckets"), count)
    wanted = written(members.select("node").distinct(), "nodes")
    side = F.broadcast(wanted) if fits(wanted, 16) else wanted
    texts = written(rows_in.join(side, F.col("doc_id") == F.col("node"), "left_semi")
                    .select(F.col("doc_id").alias("node"), "text"), "texts")
    def own_of(nodes: DataFrame) -> DataFrame:
        return (texts.join(nodes, "node", "left_semi").mapInArrow(_shingles(words), "node long, shingle long")
                .groupBy("shingle").agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
                .groupBy("node").agg(F.count("*").alias("own")))

    def confirm(pairs: DataFrame) -> DataFrame:
        return (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
                .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
                .select("a", "b", "text_a", "text_b")
                .mapInArrow(_confirmed(words, num, den), "a long, b long, both long, linked boolean")
                .groupBy("a", "b").agg(F.max("both").alias("both"), F.max("linked").alias("linked")))

    found = written(groups(members, classes.select("node", "size"), own_of, confirm, num, den), "groups")
    named = classes.join(found, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component"))
    return (profile.join(named, ["k1", "k2"], "left")
            .select(F.col("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component")))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
            .withColumnRenamed("doc_id", id_col))
