"""Line dedup: equal and nearly equal lines by similarity sketches, one line kept per group.

Lines end at a line feed.  A line is compared by its words in lower case with
one blank between them; a line without words is always kept.  Its set holds the
distinct shingles of ``CHARS`` characters (a shorter line: itself as one).
Equal lines are one class, which holds the line.  Class signatures of 140 slots are cut in 28 bands of
5: a pair at the threshold of 0.8 shares no band with probability
(1 - 0.8^5)^28 = 1.5e-5; five slots keep chance meetings rare among many lines.  Candidates are confirmed by their exact Jaccard similarity and grouped by distributed union-find.  The
first line of a group, by document id and place, stays; all others go.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.buckets import DEALT, MARKS, crowded_packed, groups, marks, packed
from trendspark.llm.common import U64, by_bytes, mix64, mix64_in_place
from trendspark.llm.scratch import fits, written
from trendspark.llm.similarity_sketch import TOGETHER, signatures
from trendspark.llm.superminhash import bands

CHARS, BANDS, ROWS = 7, 28, 5
_K = U64(0x9E3779B97F4A7C15)
_TWO = struct.Struct("<qq")
#: Nearly all values of a table of classes differ: no dictionaries, and little time for the texts.
LIGHT = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}


def canonical(line: str) -> str:
    # a blank is the only printable space: most lines need not be taken apart
    if line.isprintable() and "  " not in line and line[:1] != " " and line[-1:] != " ":
        return line.lower()
    return " ".join(line.lower().split())


def canonicals(text: str) -> list[str]:
    """The canonical form of each line of a text."""
    # most texts need not be taken apart; a sigma's lower case may hang on its neighbours
    if "  " not in text and "\n " not in text and " \n" not in text and text[:1] != " " and text[-1:] != " " \
            and "\u03a3" not in text and text.replace("\n", "").isprintable():
        return text.lower().split("\n")
    return [canonical(line) for line in text.split("\n")]


def _first_places(lines: list[str]) -> dict[str, int]:
    """Each distinct line that has words, and where it stands first."""
    own = dict(zip(reversed(lines), range(len(lines) - 1, -1, -1)))
    own.pop("", None)
    return own


def _line_keys(lines: Iterable[str]) -> np.ndarray:
    """(lines, 2) of int64: the :func:`line_key` of each."""
    digests = [hashlib.blake2b(c.encode("utf-8", "surrogatepass"), digest_size=16).digest() for c in lines]
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


def line_key(line: str) -> tuple[int, int]:
    """128 bits that stand for a canonical line."""
    return _TWO.unpack(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest())


def _windows(part: np.ndarray, chars: int) -> np.ndarray:
    """Polynomial hash of each window of ``chars`` values: a longer one is put
    together of two shorter ones."""
    made = {1: part}

    def of(m: int) -> np.ndarray:
        if m not in made:
            a, b = m // 2, m - m // 2
            right = of(b)
            h = of(a)[:len(part) - m + 1] * U64(pow(int(_K), b, 1 << 64))
            h += right[a:a + len(h)]
            made[m] = h
        return made[m]
    return of(chars)


def shingles(lines: list[str], chars: int = CHARS) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes of all lines, repeats included; offsets)."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(x) for x in lines], np.int64)
    end = np.cumsum(size)
    start = end - size
    n = np.where(size > 0, np.maximum(size - chars + 1, 1), 0)
    offsets = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(int(offsets[-1]), U64)
    a = 0
    while a < len(lines):  # some lines at a time, which stay in the processor's cache
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + TOGETHER, "right")) - 1)
        lo, hi = int(start[a]), int(end[b - 1])
        part = np.zeros(hi - lo + chars, U64)
        part[:hi - lo] = codes[lo:hi]
        part += U64(1)
        part[hi - lo:] = 0
        h = _windows(part, chars)[:hi - lo]
        own = np.ones(hi - lo, bool)  # the last places of a line begin no window of it
        for i in range(1, chars):
            last = end[a:b] - i
            own[last[last > start[a:b]] - lo] = False
        h = h[own]
        mix64_in_place(h)
        out[offsets[a]:offsets[b]] = h
        a = b
    short = np.flatnonzero((size > 0) & (size < chars))
    h = np.zeros(len(short), U64)
    for i in range(chars):  # nothing beyond the end of a line
        h = h * _K + np.where(i < size[short], codes[np.minimum(start[short] + i, max(len(codes) - 1, 0))].astype(U64) + U64(1), U64(0))
    out[offsets[:-1][short]] = mix64(h)
    return out, offsets


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct lines of some documents at a time: the first document and place
    of each (null ids first), and in how many documents it is."""
    for batch in by_bytes(batches, "text", 4 << 20):
        found: dict[str, tuple] = {}
        again: dict[str, int] = {}
        for i, t, h in zip(*(batch.column(c).to_pylist() for c in range(3))):
            known, number = i is not None, i or 0
            for c, k in _first_places(canonicals(t or "")).items():
                at = (known, number, k, h)
                if (old := found.get(c)) is None:
                    found[c] = at
                else:
                    again[c] = again.get(c, 1) + 1
                    if at < old:
                        found[c] = at
        keys = _line_keys(found)
        at, docs = found.values(), [again.get(c, 1) for c in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), pa.array([a[1] if a[0] else None for a in at], pa.int64()),
             *(pa.array([a[n] for a in at], pa.int64()) for n in (2, 3)), pa.array(docs, pa.int64()), pa.array(list(found), pa.string())],
            names=["k1", "k2", "doc_id", "place", "h", "docs", "line"])


def _banded(chars: int, count: int, rows: int):
    """For the number of deals, the packed bands of lines (node, line)."""
    def of(deals: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nodes, found, n = [], [], 0
            for batch in by_bytes(batches, "line", 1 << 20):
                e, offsets = shingles(batch.column(1).to_pylist(), chars)
                nodes.append(batch.column(0).to_numpy())
                found.append(bands(signatures(e, offsets, count * rows), count, rows))
                n += batch.num_rows
                if n >= DEALT:
                    yield from packed(np.concatenate(nodes), np.concatenate(found), deals)
                    nodes, found, n = [], [], 0
            if n:
                yield from packed(np.concatenate(nodes), np.concatenate(found), deals)
        return run
    return of


def _sets(lines: list[str], chars: int) -> list[np.ndarray]:
    e, offsets = shingles(lines, chars)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        x = np.sort(e[a:b])
        out.append(x[np.append(x[1:] != x[:-1], True)] if len(x) else x)
    return out


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    both = np.sort(np.concatenate([x, y]))
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _sizes(chars: int):
    def run(batches):
        for batch in by_bytes(batches, "line", 1 << 20):
            s = _sets(batch.column(1).to_pylist(), chars)
            n = np.array([len(x) for x in s], np.int64)
            m = marks(np.concatenate([np.zeros(0, U64), *s]), np.concatenate([[0], np.cumsum(n)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *(pa.array(c) for c in m.T.copy())],
                                             names=["node", "size", *MARKS])
    return run


def _confirmed(chars: int, num: int, den: int):
    def run(batches):
        for batch in by_bytes(batches, "line_b", 1 << 20):
            one, two = (batch.column(i).to_pylist() for i in (2, 3))
            every = list(dict.fromkeys([*one, *two]))  # a pivot meets many lines of a batch
            of = dict(zip(every, _sets(every, chars)))
            x, y = [of[c] for c in one], [of[c] for c in two]
            both = [_shared(a, b) for a, b in zip(x, y)]
            linked = [n > 0 and den * n >= num * (len(a) + len(b) - n) for a, b, n in zip(x, y, both)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64()),
                                              pa.array(linked, pa.bool_())], names=["a", "b", "both", "linked"])
    return run


def line_groups(rows: DataFrame, *, num: int = 4, den: int = 5, chars: int = CHARS, count: int = BANDS,
                band_rows: int = ROWS) -> DataFrame:
    """(k1, k2, docs, doc_id, place, lines): of every class of equal lines of
    ``rows`` (doc_id, text, h: a hash of the text) that has more than one line, or one nearly equal to
    it: the first line of its group, and the group's documents."""
    # equal lines of a batch are one row, so that a common line is no single task; the rest need no further partial sums
    classes = (rows.mapInArrow(_lines, "k1 long, k2 long, doc_id long, place long, h long, docs long, line string")
               .repartition("k1").groupBy("k1", "k2")
               .agg(F.min(F.struct("doc_id", "place", "h")).alias("at"), F.sum("docs").alias("docs"), F.first("line").alias("line")))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "line-classes", **LIGHT)
    members = crowded_packed(classes.select("node", "line"), _banded(chars, count, band_rows))
    wanted = written(members.select("node").distinct(), "wanted")
    lines = written(classes.select("node", "line").join(F.broadcast(wanted) if fits(wanted, 16) else wanted, "node"), "lines",
                    compression="zstd")
    sizes = written(lines.mapInArrow(_sizes(chars), ", ".join(f"{c} long" for c in ["node", "size", *MARKS])), "line-sizes")

    def confirm(pairs: DataFrame) -> DataFrame:
        return (pairs.join(lines.select(F.col("node").alias("a"), F.col("line").alias("line_a")), "a")
                .join(lines.select(F.col("node").alias("b"), F.col("line").alias("line_b")), "b")
                .select("a", "b", "line_a", "line_b")
                .mapInArrow(_confirmed(chars, num, den), "a long, b long, both long, linked boolean"))

    linked = written(groups(members, sizes.select("node", "size"), None, confirm, num, den, sizes), "line-groups")
    named = (classes.drop("line").join(F.broadcast(linked) if fits(linked, 16) else linked, "node", "left")
             .where("docs > 1 or component is not null").withColumn("group", F.coalesce("component", "node")))
    near = (named.where("component is not null").groupBy("group")
            .agg(F.min("at").alias("first"), F.sum("docs").alias("all_docs")))
    return written(named.join(near, "group", "left")
                   .select("k1", "k2", F.coalesce("first", "at").alias("first"),
                           F.coalesce("all_docs", "docs").alias("docs"))
                   .select("k1", "k2", "docs", "first.doc_id", "first.place"), "line-keepers")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document's distinct lines: the key, and the places where the line stands."""
    for batch in by_bytes(batches, "text", 2 << 20):
        ids, sums, keys, places, ends = [], [], [], [], [0]
        for i, t, h in zip(*(batch.column(c).to_pylist() for c in range(3))):
            lines = canonicals(t or "")
            first = _first_places(lines)
            if len(first) == len(lines):
                ends += range(len(places) + 1, len(places) + len(first) + 1)
                places += first.values()
            else:
                at: dict[str, list[int]] = {c: [] for c in first}
                for k, c in enumerate(lines):
                    if c:
                        at[c].append(k)
                for own in at.values():
                    places += own
                    ends.append(len(places))
            keys += first
            ids += [i] * len(first)
            sums += [h] * len(first)
        k = _line_keys(keys)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums, pa.int64()), pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()),
                                          pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places, pa.int32()))],
                                         names=["doc_id", "h", "k1", "k2", "places"])


def _rewrite(n: int, text_at: int):
    """Drop the lines at the places of a document's lists; a document without
    lists has nothing to drop."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for t, drop in zip(batch.column(text_at).to_pylist(), batch.column(n).to_pylist()):
                gone = {k for places in drop or () for k in places}
                texts.append("\n".join(line for k, line in enumerate(t.split("\n")) if k not in gone) if gone else t)
                removed.append(len(gone))
            columns = list(batch.columns[:n])
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int64())],
                                             names=[*batch.schema.names[:n], "__removed"])
    return run


def line_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", removed_col: str = "lines_removed",
               **kwargs) -> DataFrame:
    """``docs`` with near-duplicate lines taken out of the text, and their number
    in ``removed_col``; all rows and other columns stay.

    Null texts stay null, empty ones empty.  A null id is a document like any
    other, before all others; ids are whole numbers.  Rows that repeat an id
    count as copies of one document: a line kept in it stays in each of them.
    """
    names = [c for c in docs.columns if c != removed_col]
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    keepers = line_groups(rows, **kwargs)
    side = F.broadcast(keepers) if fits(keepers, 40) else keepers
    # of a class with a keeper all lines go but that one, of other classes all but a document's first
    hits = (rows.mapInArrow(_keys, "doc_id long, h long, k1 long, k2 long, places array<int>")
            .join(side.withColumnRenamed("doc_id", "first_doc"), ["k1", "k2"], "left").where("docs is not null or size(places) > 1")
            .select("doc_id", "h", F.when(F.col("docs").isNull(), F.expr("slice(places, 2, size(places))"))
                    .when(F.col("doc_id").eqNullSafe(F.col("first_doc")), F.array_remove("places", F.col("place").cast("int")))
                    .otherwise(F.col("places")).alias("drop"))
            .where(F.size("drop") > 0))
    drops = written(hits.groupBy(F.col("doc_id").alias("__doc"), F.col("h").alias("__h")).agg(F.collect_set("drop").alias("__drop")), "drops")
    total = drops.agg(F.sum(F.size("__drop"))).first()[0] or 0
    side = F.broadcast(drops) if total * 40 <= 32 << 20 else drops
    joined = (docs.select(*names).withColumn(text_col, F.col(text_col).cast("string"))
              .join(side, F.col(id_col).cast("long").eqNullSafe(F.col("__doc")) & (F.xxhash64(text_col) == F.col("__h")), "left")
              .select(*names, "__drop"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:-1])
    out = joined.mapInArrow(_rewrite(len(names), names.index(text_col)), schema + ", __removed long")
    return out.withColumnRenamed("__removed", removed_col)
