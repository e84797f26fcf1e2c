"""Repeated substrings by threshold-bounded interval expansion on Burrows-Wheeler transforms.

Every byte covered by a string of ``least`` bytes that starts somewhere else too
is taken out.  Matches are judged on the input, within whole texts.

1. *Stretches.*  The windows of ``least`` bytes of a text fall into stretches of
   neighbours with the same least gram hash.  Equal windows have the same gram,
   so only stretches of a gram that is met twice can repeat anything.  Their
   occurrences are counted by Spark; equal stretches are one, with a count.
2. *Expansion.*  Stretches are dealt to buckets by their gram; a bucket's texts
   are joined with separators and turned into a Burrows-Wheeler transform.
   Intervals of equal prefixes are extended backwards, breadth first: level l
   gives all boundaries whose common prefix is l.  It stops at ``least``;
   neighbours whose boundary is still open share at least that much.
3. *Taking out.*  A window repeats if its stretch was counted twice or it has an
   open boundary.  Repeated windows go back to their documents, and the union of
   their bytes is cut.

A gram with more than ``HOT`` bytes of different stretches (a passage met in very
many surroundings) is too large for one transform: its windows are counted one by
one instead, by 128 bits of hash, in a grouping of Spark's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import U64, _power, by_bytes, mix64, text_bytes
from trendspark.llm.scratch import fits, written

LEAST, GRAM = 200, 64
#: Bytes hashed in one step, of a bucket's texts (about), and of a gram's stretches in a bucket (at most).
STEP, BUCKET, HOT = 1 << 20, 1 << 20, 1 << 20
#: Windows of a stretch, at most; a longer run of one gram is cut.
LONGEST = 256
_BYTE = mix64(np.arange(256, dtype=U64) + U64(7 << 40))


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix sums of a polynomial hash, inverse powers): see :func:`_hash`."""
    up, down = _power(len(data) + 1)
    return np.concatenate([np.zeros(1, U64), np.cumsum(_BYTE[data] * up[:len(data)], dtype=U64)]), down


def _hash(sums: np.ndarray, down: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of data[first:last]."""
    return mix64((sums[last] - sums[first]) * down[first] + (last - first).astype(U64) + U64(seed))


def stretches(data: np.ndarray, valid: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, key, first window, windows) of the stretches of the windows marked ``valid``."""
    sums, down = _sums(data)
    grams = mix64((sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1])
    low, width, done = grams, least - gram + 1, 1
    while 2 * done <= width:
        low, done = np.minimum(low[:-done], low[done:]), 2 * done
    if done < width:
        low = np.minimum(low[:len(low) - (width - done)], low[width - done:])
    edge = np.concatenate([[True], low[1:] != low[:-1]])
    first = np.flatnonzero(valid & (edge | ~np.concatenate([[False], valid[:-1]])))
    last = np.flatnonzero(valid & (np.concatenate([edge[1:], [True]]) | ~np.concatenate([valid[1:], [False]]))) + 1
    # one place of the gram leaves, or another enters, and it is still the least: equal windows may be
    # in this one stretch, which is cut in two so that its gram counts twice
    leaves, enters = (np.concatenate([[0], np.cumsum(g[:len(low)] == low)]) for g in (grams, grams[width - 1:]))
    again = (leaves[last - 1] > leaves[first]) | (enters[last] > enters[first + 1])
    pieces = np.maximum(-(-(last - first) // LONGEST), np.where(again, 2, 1))
    length = np.repeat(-(-(last - first) // pieces), pieces)
    place = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(first, pieces) + place * length
    last = np.minimum(np.repeat(last, pieces), first + length)
    on = first < last
    first, last = first[on], last[on]
    return low[first], _hash(sums, down, first, last + least - 1), first, last - first


_FOUND = "gram long, key long, doc_id {0}, h long, start int, size int"


def _occurrences(least: int, gram: int):
    def step(parts: list[tuple]) -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
        size = np.array([len(p[2]) for p in parts])
        base = np.cumsum(size) - size
        valid = np.zeros(len(data) - least + 1, bool)
        for a, n in zip(base.tolist(), size.tolist()):
            valid[a:a + n - least + 1] = True
        g, key, first, n = stretches(data, valid, least, gram)
        part = np.searchsorted(base, first, "right") - 1
        shift = np.array([p[1] for p in parts]) - base
        return np.array([p[0] for p in parts])[part], g, key, first + shift[part], n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", STEP):
            parts, found, held = [], [], 0
            for i, t in enumerate(text_bytes(batch.column(2))):
                for a in range(0, len(t) - least + 1, STEP):  # a very long text in pieces
                    parts.append((i, a, t[a:a + STEP + least - 1]))
                    held += len(parts[-1][2])
                    if held >= STEP:
                        found.append(step(parts))
                        parts, held = [], 0
            if parts:
                found.append(step(parts))
            if not found:
                continue
            row, g, key, start, n = (np.concatenate(c) for c in zip(*found))
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g.view(np.int64)), pa.array(key.view(np.int64)), batch.column(0).take(at), batch.column(1).take(at),
                 pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["gram", "key", "doc_id", "h", "start", "size"])
    return run


_FIRST = 7  # codes of 9 bits in the first sort key


def _sorted_suffixes(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in the order of their first ``depth`` codes at least, common prefix
    of neighbours as far as it is under ``_FIRST``, else -1)."""
    n = len(codes)
    wide = np.concatenate([codes.astype(U64), np.zeros(_FIRST, U64)])
    key = np.zeros(n, U64)
    for i in range(_FIRST):
        key = (key << U64(9)) | wide[i:i + n]
    order = np.argsort(key)
    key = key[order]
    change = key[1:] ^ key[:-1]
    new = np.concatenate([[True], change != 0])
    common = np.full(n + 1, -1, np.int32)
    common[0] = common[n] = 0
    cut = np.flatnonzero(change)
    common[cut + 1] = sum((change[cut] >> U64(9 * i)) == 0 for i in range(_FIRST))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    done = _FIRST
    while done < depth:  # double the depth, of suffixes that are not alone yet
        at = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
        if not len(at):
            break
        here = order[at]
        there = here + done
        key = (rank[here] << 32) | np.where(there < n, rank[np.minimum(there, n - 1)] + 1, 0)
        by = np.argsort(key)
        order[at] = here[by]
        key = key[by]
        change = np.concatenate([[True], key[1:] != key[:-1]])
        new[at] = change
        rank[here[by]] = np.maximum.accumulate(np.where(change, at, 0))
        done *= 2
    return order, common


def common_prefixes(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix of each with the one before).

    ``codes``: texts, each followed by a 0.  A common prefix of ``least`` or more
    is -1; those that go on behind a 0 are not worked out and -1 as well.
    """
    order, common = _sorted_suffixes(codes, least)
    n, start = len(codes), min(_FIRST, least)
    common[common >= start] = -1
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    back = place[order - 1]  # where the suffix that begins one before stands
    head = codes[order]
    # the strings of `start` codes whose right boundary was set last
    edge = np.flatnonzero(common >= 0)
    low, high = edge[:-1], edge[1:]
    on = (common[high] == start - 1) & (high > low)
    low, high = low[on], high[on]
    ends = np.minimum(order[low][:, None] + np.arange(1, start)[None, :] - 1, n - 1) if len(low) else np.zeros((0, 1), np.int64)
    on = (codes[ends] != 0).all(axis=1)  # a 0 may stand at the end only
    low, high = low[on], high[on]
    for level in range(start, least):
        if not len(low):
            break
        size = high - low
        own = np.repeat(np.arange(len(low)), size)
        at = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        to = np.sort((back[at] << 32) | own)
        pos, who = to >> 32, to & 0xFFFFFFFF
        first = head[pos]
        cut = np.flatnonzero((pos[1:] != pos[:-1] + 1) | (who[1:] != who[:-1]) | (first[1:] != first[:-1]))
        low, high = pos[np.concatenate([[0], cut + 1])], pos[np.concatenate([cut, [len(pos) - 1]])] + 1
        on = common[high] < 0
        low, high = low[on], high[on]
        common[high] = level
        on = head[low] != 0
        low, high = low[on], high[on]
    return order, common


def repeated_windows(texts: list[bytes], least: int) -> list[np.ndarray]:
    """Of each text, whether each of its windows of ``least`` bytes is met twice in the texts."""
    size = np.array([len(t) for t in texts], np.int64)
    base = np.cumsum(size + 1) - size - 1
    codes = np.zeros(int(size.sum()) + len(texts), np.int16)
    filled = np.ones(len(codes), bool)
    filled[base + size] = False
    codes[filled] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int16) + 1
    order, common = common_prefixes(codes, least)
    open_ = common < 0
    twice = np.zeros(len(codes), bool)
    twice[order] = open_[:-1] | open_[1:]
    return [twice[a:a + max(n - least + 1, 0)] for a, n in zip(base.tolist(), size.tolist())]


def _runs(on: np.ndarray) -> list[int]:
    """[from, to, from, to, ...] of the true stretches."""
    return np.flatnonzero(np.diff(np.concatenate([[False], on, [False]]).astype(np.int8))).tolist()


def _expand(least: int):
    def run(table: pa.Table) -> pa.Table:
        texts = table.column("slice").to_pylist()
        out = [(g, k, _runs(on | (n > 1))) for g, k, n, on in zip(
            *(table.column(c).to_pylist() for c in ("gram", "key", "n")), repeated_windows(texts, least))]
        out = [r for r in out if r[2]]
        return pa.table({"gram": pa.array([r[0] for r in out], pa.int64()), "key": pa.array([r[1] for r in out], pa.int64()),
                         "runs": pa.array([r[2] for r in out], pa.list_(pa.int32()))})
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted stretches of each text."""
    for batch in by_bytes(batches, "text", STEP):
        rows = [(w["gram"], w["key"], w["n"], t[w["start"]:w["start"] + w["bytes"]])
                for t, wanted in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()) for w in wanted]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (*[pa.int64()] * 3, pa.binary()))],
                                             names=["gram", "key", "n", "slice"])


def _singles(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every window of hot stretches with two hashes."""
        for batch in by_bytes(batches, "slice", STEP // 4):
            texts = batch.column(3).to_pylist()
            sums, down = _sums(np.frombuffer(b"".join(texts), np.uint8))
            size = np.array([len(t) for t in texts])
            n = size - least + 1
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            at = place + np.repeat(np.cumsum(size) - size, n)
            a, b = _hash(sums, down, at, at + least), _hash(sums, down, at, at + (least + 1) // 2, 3)
            own = pa.array(np.repeat(np.arange(len(texts)), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *(batch.column(i).take(own) for i in range(3)),
                 pa.array(place.astype(np.int32))], names=["a", "b", "gram", "key", "n", "place"])
    return run


def repeats(docs: DataFrame, *, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """(doc_id, h, low, high) byte ranges of ``docs`` (doc_id, h, text) whose every
    window of ``least`` bytes starts somewhere else too; ranges may overlap."""
    gram = min(GRAM, (least + 1) // 2)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = written(docs.select("doc_id", "h", "text").mapInArrow(_occurrences(least, gram), _FOUND.format(kind)), "stretches")
    twice = written(found.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram"), "grams")
    side = F.broadcast(twice) if fits(twice, 16) else twice
    candidates = written(found.join(side, "gram", "left_semi"), "candidates")
    kinds = (candidates.groupBy("gram", "key").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "h", "start", "size")).alias("at"))
             .select("at.doc_id", "at.h", F.struct("gram", "key", "n", "at.start", (F.col("at.size") + (least - 1)).alias("bytes")).alias("w")))
    wanted = written(kinds.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("g")).agg(F.collect_list("w").alias("wanted")), "wanted")
    # shuffled at every size: what is wanted of the texts grows with them
    slices = written(docs.join(wanted.hint("shuffle_merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")))
                     .select("text", "wanted").mapInArrow(_cut, "gram long, key long, n long, slice binary"), "slices")
    sizes = slices.groupBy("gram").agg(F.sum(F.length("slice")).alias("bytes"))
    crowd = written(sizes.where(F.col("bytes") > hot).select("gram"), "hot-grams")
    crowd = F.broadcast(crowd) if fits(crowd, 16) else crowd
    held = slices.agg(F.coalesce(F.sum(F.length("slice")), F.lit(0))).first()[0]
    buckets = max(1, -(-held // BUCKET))
    expanded = (slices.join(crowd, "gram", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets)))
                .groupBy("bucket").applyInArrow(_expand(least), "gram long, key long, runs array<int>"))
    single = written(slices.join(crowd, "gram", "left_semi").select("gram", "key", "n", "slice")
                     .mapInArrow(_singles(least), "a long, b long, gram long, key long, n long, place int"), "windows")
    met = single.groupBy("a", "b").agg(F.sum("n").alias("c")).where("c > 1").select("a", "b")
    single = single.join(met, ["a", "b"], "left_semi").select("gram", "key", F.array("place", F.col("place") + 1).alias("runs"))
    hits = written(expanded.unionByName(single), "repeats")
    pair = F.explode(F.expr("transform(sequence(0, size(runs) - 2, 2), i -> struct(runs[i] as x, runs[i + 1] as y))"))
    return (candidates.join(hits, ["gram", "key"]).select("doc_id", "h", "start", pair.alias("r"))
            .select("doc_id", "h", (F.col("start") + F.col("r.x")).alias("low"), (F.col("start") + F.col("r.y") + (least - 1)).alias("high")))


def _united(ranges) -> list[tuple[int, int]]:
    """Maximal ranges."""
    out: list[tuple[int, int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in ranges):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out


def _maximal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, h, ranges): the ranges of each text united."""
    kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    for batch in batches:
        for a in range(0, batch.num_rows, 1024):
            part = batch.slice(a, 1024)
            lists = [[{"low": x, "high": y} for x, y in _united(r)] for r in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(lists, kind)], names=part.schema.names)


def _taken(n: int):
    """Cut the ranges (column n + 1) out of the texts (column n): bytes, kept bytes, bytes removed, maximal runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "__text", 8 * STEP):
            size, kept, removed, spans = [], [], [], []
            for t, ranges in zip(text_bytes(batch.column(n)), batch.column(n + 1).to_pylist()):
                out, end = [], 0
                for r in ranges or ():
                    out.append(t[end:r["low"]])
                    end = r["high"]
                out.append(t[end:])
                kept.append(b"".join(out))
                size.append(len(t))
                removed.append(len(t) - len(kept[-1]))
                spans.append(len(ranges or ()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(size, pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64())], names=[*batch.schema.names[:n], "__size", "__kept", "__removed", "__spans"])
    return run


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, hot: int = HOT,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ``keep``, n_bytes, kept binary, n_removed, n_spans) of every row of ``docs``.

    Bytes covered by a string of ``least`` UTF-8 bytes that also starts anywhere
    else (in the same text too) are removed; what is left is joined, and may cut
    characters, hence binary.  ``n_spans`` counts maximal removed runs.

    A null text counts as empty; texts shorter than ``least`` stay whole; a very
    long text is taken in pieces.  A null id is an id like any other, rows that
    repeat an id are documents of their own, and equal rows repeat each other.
    An empty table gives no rows.  Other columns are not read unless kept.
    """
    names = [id_col, *keep]
    rows = docs.select(*names, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    rows = rows.withColumn("__h", F.xxhash64("__text"))
    found = repeats(rows.select(F.col(id_col).alias("doc_id"), F.col("__h").alias("h"), F.col("__text").alias("text")), least=least, hot=hot)
    lists = found.groupBy(F.col("doc_id").alias("__d"), F.col("h").alias("__g")).agg(F.collect_set(F.struct("low", "high")).alias("__ranges"))
    lists = written(lists.mapInArrow(_maximal, f"__d {rows.schema[id_col].dataType.simpleString()}, __g long, "
                                               "__ranges array<struct<low int, high int>>"), "ranges")
    total, count = lists.agg(F.coalesce(F.sum(F.size("__ranges")), F.lit(0)), F.count("*")).first()
    side = F.broadcast(lists) if (total + 2 * count) * 16 <= 32 << 20 else lists
    joined = rows.join(side, F.col(id_col).eqNullSafe(F.col("__d")) & (F.col("__h") == F.col("__g")), "left")
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return (joined.select(*names, "__text", "__ranges")
            .mapInArrow(_taken(len(names)), f"{schema}, __size long, __kept binary, __removed long, __spans long")
            .select(*names, F.col("__size").alias("n_bytes"), F.col("__kept").alias("kept"), F.col("__removed").alias("n_removed"),
                    F.col("__spans").alias("n_spans")))


def repeats_digest(docs: DataFrame, **kwargs) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256); see :func:`remove_repeats`."""
    return remove_repeats(docs, **kwargs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def oracle(table: str = "documents", least: int = LEAST) -> str:
    """DuckDB SQL for :func:`repeats_digest`: every window of every text, in hex."""
    return f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, lower(hex(encode(coalesce(text, '')))) AS x FROM {table}),
    -- in pieces of 200 windows, since a substring far into a long text is slow
    piece AS (SELECT r, base, substring(x, 2 * base + 1, 2 * {least + 199}) AS c
              FROM (SELECT r, x, unnest(range(0, len(x) // 2 - {least - 1}, 200)) AS base FROM d)),
    w AS (SELECT r, base + q AS p, md5(substring(c, 2 * q + 1, {2 * least})) AS m
          FROM (SELECT r, base, c, unnest(range(0, len(c) // 2 - {least - 1})) AS q FROM piece)),
    twice AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
    hit AS (SELECT r, p FROM w SEMI JOIN twice USING (m)),
    edge AS (SELECT r, p, p > coalesce(lag(p) OVER (PARTITION BY r ORDER BY p) + {least}, -1) AS new FROM hit),
    span AS (SELECT r, min(p) AS low, max(p) + {least} AS high
             FROM (SELECT r, p, sum(CAST(new AS INTEGER)) OVER (PARTITION BY r ORDER BY p) AS s FROM edge) GROUP BY r, s),
    gap AS (SELECT r, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low), 0) AS a, low AS b FROM span
            UNION ALL SELECT r, max(high), NULL FROM span GROUP BY r),
    kept AS (SELECT r, string_agg(CASE WHEN b IS NULL THEN substring(x, 2 * a + 1) ELSE substring(x, 2 * a + 1, 2 * (b - a)) END, '' ORDER BY a) AS k
             FROM gap JOIN d USING (r) GROUP BY r),
    sums AS (SELECT r, count(*) AS n, sum(high - low) AS removed FROM span GROUP BY r)
    SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
           sha256(unhex(coalesce(k, x))) AS kept_sha256
    FROM d LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)"""
