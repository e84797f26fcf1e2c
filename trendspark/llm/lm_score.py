"""LM scoring by a probabilistic suffix tree.

Symbols are word hashes and one end symbol per text; contexts are the symbols
before, back to a start mark, at most ``DEPTH`` of them.

* Grams (up to ``DEPTH`` symbols before and the symbol) are counted over all
  training texts.  The counts of symbols give the root, add-one over the
  symbols seen and one unknown symbol.
* Level by level, each context seen at least ``LEAST`` times whose successors
  ``LEAST`` times are known gives those a probability of their own, discounted
  by ``DISCOUNT``; the rest of the mass goes to the context one symbol shorter.
  ``LEAST`` is the same at every size, so the tree grows with the corpus.
* A context stays in the tree if its distribution diverges from that of its
  longest suffix in the tree: the log likelihood that it adds on the corpus
  must pay for its parameters (half a log of its count each).
* A symbol is scored in the state of the longest suffix in the tree.

The texts are written once, as chunks of numbered symbols.  A chunk asks for
its distinct grams with its own counts, dealt by hash, and is told those that
the corpus holds often enough; a gram's two parts, without its last and without
its first symbol, occur at least as often, so only grams of two known parts are
asked for.  One of the chunks that hold a gram adds it to the sums of its
context; each chunk then asks for its contexts and is told which stay, and
their share of the mass for shorter ones.  Each trip works out the levels again
from the chunk and the replies so far.  A chunk asks for a key once, so no key
is in more than a row a chunk; only keys, counts and sums are shuffled.

``EPS`` and ``DELTA`` raise the least counts of contexts and successors to a
share of the corpus; both are off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import U64, by_bytes, mix64, mix64_in_place, text_bytes, text_words
from trendspark.llm.labelled import held_out
from trendspark.llm.scratch import dealt

DEPTH, LEAST, EPS, DELTA, DISCOUNT = 3, 2, 0.0, 0.0, 0.5
#: Share of the corpus from which keys were broadcast; no key is joined any more, so it has no effect.
COMMON = 1e-5
#: Bytes of text (and 16 a row) of a chunk; keys that a task counts at a time, and the fewest worth a task.
CHUNK_BYTES, PART_KEYS, FEW_KEYS = 8 << 20, 1 << 21, 1 << 17

END, START = mix64(np.array([11, 13], U64) << U64(50))
_K = U64(0x9E3779B97F4A7C15)
_LN10 = float(np.log(10))

ASKED = "part int, chunk long, keys binary, counts binary, totals binary, seen binary, shorter binary, fit binary"
TOLD = "part int, chunk long, told binary, backoff binary, types long"


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, each text's words then END; offsets)."""
    h, offsets = text_words(texts)
    return np.insert(h, offsets[1:], END), offsets + np.arange(len(offsets))


def _small(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(data, asbytes=True)


def _large(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes, least first, as many as the largest needs."""
    x = np.ascontiguousarray(x).view(U64)
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + _small(x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_large(data[1:]), np.uint8).reshape(data[0], -1)
    x = planes[0].astype(U64)
    for k in range(1, data[0]):
        x |= planes[k].astype(U64) << U64(8 * k)
    return x


def _packed_keys(keys: np.ndarray) -> bytes:
    """Keys in runs by size: their steps have fewer bytes."""
    return _packed(np.diff(keys, prepend=U64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=U64)


def _chunk(texts: pa.Table, name: int) -> pa.RecordBatch:
    sym, offsets = symbols(text_bytes(texts.column("text").combine_chunks()))
    keys, token, times = np.unique(sym, return_inverse=True, return_counts=True)
    often = np.argsort(-times, kind="stable")  # small numbers for common symbols
    number = np.empty_like(often)
    number[often] = np.arange(len(often))
    held, lengths = texts.column("held_out").combine_chunks(), np.diff(offsets)
    train = ~held.to_numpy(zero_copy_only=False).astype(bool)
    whole = pa.array([0, texts.num_rows], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array([name], pa.int64()), pa.ListArray.from_arrays(whole, texts.column("doc_id").combine_chunks()),
         pa.ListArray.from_arrays(whole, held), pa.ListArray.from_arrays(whole, pa.array(lengths)),
         pa.array([_packed_keys(keys[often])]), pa.array([_packed(number[token])]),
         pa.array([int(lengths[train].sum())]), pa.array([len(sym)]), pa.array([int(train.sum())])],
        names=["chunk", "ids", "held", "lengths", "keys", "tokens", "n_train", "n_all", "texts"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, held_out, text) as chunks of about CHUNK_BYTES."""
    task, number, some, size = TaskContext.get().partitionId() << 32, 0, [], 0
    for batch in by_bytes(batches, "text", CHUNK_BYTES):
        text = batch.column(batch.schema.get_field_index("text"))
        more = 16 * batch.num_rows + (pc.sum(pc.binary_length(text)).as_py() or 0)
        if some and size + more > CHUNK_BYTES:
            yield _chunk(pa.Table.from_batches(some), task + number)
            number, some, size = number + 1, [], 0
        some.append(batch)
        size += more
    if some:
        yield _chunk(pa.Table.from_batches(some), task + number)


class Learnt:
    """What the driver knows of the corpus: training symbols and texts, symbols seen, least counts, parts of a trip."""

    def __init__(self, depth: int, tokens: int, texts: int, parts: int):
        self.depth, self.tokens, self.texts, self.types, self.parts = depth, tokens, texts, 0, parts
        self.enough, self.some = (max(LEAST, int(np.ceil(share * tokens))) for share in (EPS, DELTA))

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 1) / float(self.tokens + self.types + 1))

    def backoff(self, level: int, key: np.ndarray, c: np.ndarray, k: np.ndarray, seen: np.ndarray, shorter: np.ndarray,
                fit: np.ndarray) -> np.ndarray:
        """The log10 of the share that contexts leave to the shorter one, NaN for those that the tree does not keep."""
        c = np.maximum(c, 1)
        left, rest = np.maximum(1 - (seen - DISCOUNT * k) / c, 1e-9), np.maximum(1 - shorter, 1e-9)
        gain = fit - seen * np.log(c) + (c - seen) * np.log(left / rest)
        candidate = (c >= self.enough) | ((level == 1) & (key == START))
        kept = (k > 0) & candidate & (gain > 0.5 * (k + 1) * np.log(c + 1))
        return np.where(kept, np.log10(left / rest), np.nan)


class Chunk:
    """The levels of a chunk's grams, as far as it has been told of them.

    The nodes of a level are its known grams: their keys ``of``, counts ``n``
    and log10 probabilities ``logp``; ``node`` has that of each place or -1,
    ``before`` the node of the level below that is the place's context.
    """

    def __init__(self, row: pa.Table, learnt: Learnt):
        flat = lambda c: row.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.learnt, self.lengths, self.held = learnt, flat("lengths").astype(np.int64), flat("held").astype(bool)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.train = np.repeat(~self.held, self.lengths)
        self.level = 0
        self.key, place = np.unique(_unpacked_keys(row.column("keys")[0].as_py()), return_inverse=True)
        self.sure = np.zeros(len(self.key), np.int64)
        self.symbol = place.astype(np.int32)[_unpacked(row.column("tokens")[0].as_py()).view(np.int64)]

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(key, count in the chunk's training texts) of the distinct grams to ask for at this level, by key."""
        asked = self.sure == 0
        n = (np.add.reduceat(self.train[self.place], self.start, dtype=np.int64) if self.level
             else np.bincount(self.symbol[self.train], minlength=len(self.key)))
        return self.key[asked], n[asked].astype(U64)

    def told(self, told: np.ndarray) -> None:
        """Takes the reply to ``grams``: twice the count and whether this chunk adds it, 0 where it is not known."""
        all_told = self.sure
        all_told[all_told == 0] = told.view(np.int64)
        n, known = all_told >> 1, all_told > 0
        if self.level == 0:
            base, known = self.learnt.base(n), n >= self.learnt.some
            self.seen, self.base = n[self.symbol] > 0, base[self.symbol]
            self.p = self.base.copy()
            # the start mark is the last node
            self.n, self.of, self.logp = np.append(n, self.learnt.texts), np.append(self.key, START), np.append(base, 0.0)
            self.node = np.where(known, np.arange(len(n), dtype=np.int32), np.int32(-1))[self.symbol]
            return
        self.prefix, self.suffix, self.below = self.prefix[known], self.suffix[known], (self.of, self.n)
        self.adds, self.n, self.of = (all_told[known] & 1).astype(bool), n[known], self.key[known]
        node = np.full(len(self.node), -1, np.int32)
        name = np.where(known, np.cumsum(known, dtype=np.int32) - np.int32(1), np.int32(-1))
        node[self.place] = np.repeat(name, np.diff(self.start, append=len(self.place)))
        self.node = node
        # a context is asked for if the successors here leave enough of its count for another known one
        of, c = self.below
        here, off = np.zeros((2, len(of) + 1), bool)
        here[self.before] = True
        off[self.before[node < 0]] = True
        unknown = np.bincount(self.before[(node < 0) & self.train] + 1, minlength=len(of) + 1)[1:]
        left = c - np.bincount(self.prefix, self.n, len(of)) - unknown
        self.open = here[:-1] & (left >= self.learnt.some) & ~self.alone
        self.off = off[:-1]  # followed here by what is not known: only these need more than whether they are kept

    def sums(self, some: np.ndarray) -> tuple[np.ndarray, ...]:
        """(k, seen, shorter, fit) of the contexts of this level over some of the grams."""
        x, n, q = self.prefix[some], self.n[some], self.logp[self.suffix[some]]
        each = None, n, np.exp(q * _LN10), n * (np.log(n - DISCOUNT) - q * _LN10)
        return tuple(np.bincount(x, v, len(self.below[0])) for v in each)

    def contexts(self) -> tuple[np.ndarray, ...]:
        """(key, 4 k + 2 if its share is asked for + 1 if it is asked for, count, seen, shorter, fit) of contexts, by key: the
        sums over the k grams that this chunk adds, and the count, only of contexts with some; fit only with two."""
        of, c = self.below
        k, *sums = self.sums(self.adds)
        known = np.flatnonzero(self.open | (k > 0) & ~self.alone)
        known = known[np.argsort(of[known])]
        some = known[k[known] > 0]
        seen, shorter, fit = (v[some] for v in sums)
        return (of[known], (k[known] * 4 + self.off[known] * 2 + self.open[known]).astype(U64), c[some].astype(U64), seen.astype(U64),
                shorter, fit[k[some] > 1])

    def backed(self, asked_kept: np.ndarray, backoff: np.ndarray, scored: bool) -> None:
        """Takes the reply to ``contexts``: whether each is kept, and for those asked for the log10 of the share left to the shorter one."""
        of, c = self.below
        share = np.append(self.learnt.backoff(self.level, of, c, *self.sums(slice(None))), np.nan)  # the last for places without a context
        share[:-1][self.alone] = np.nan
        asked = np.flatnonzero(self.open)
        asked = asked[np.argsort(of[asked])]
        share[asked] = np.where(asked_kept, 0.0, np.nan)
        share[asked[asked_kept & self.off[asked]]] = backoff
        own, q, kept = np.log((self.n - DISCOUNT) / c[self.prefix]) / _LN10, self.logp[self.suffix], ~np.isnan(share[self.prefix])
        if scored:
            gained = np.append(np.where(kept, own - q, 0.0), 0.0)
            self.p += np.where(self.node >= 0, gained[self.node], np.nan_to_num(share)[self.before])
        self.logp = np.where(kept, own, q)

    def longer(self) -> None:
        """Goes on to the grams of the next level."""
        self.level += 1
        parts = (self.prefix, self.suffix) if self.level > 1 else ()
        before = np.empty_like(self.node)
        before[1:] = self.node[:-1]
        before[self.first] = len(self.of) - 1 if self.level == 1 else -1
        place = np.flatnonzero((before >= 0) & (self.node >= 0))
        key = self.of[before[place]]
        key *= _K
        key += self.of[self.node[place]]
        mix64_in_place(key)
        order = np.argsort(key)
        key = key[order]
        # the places of each distinct gram, by key
        self.start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
        self.place, self.key = place[order], key[self.start]
        at = self.place[self.start]
        self.before, self.prefix, self.suffix, self.sure = before, before[at], self.node[at], np.zeros(len(at), np.int64)
        self.alone = np.zeros(len(self.of), bool)
        if self.level > 1:
            # contexts that are all of their suffix differ in nothing from it, so they are never kept
            _, n = self.below
            first, self.alone = self.n == n[parts[0]], self.n == n[parts[1]]
            # where all that stands before what both parts share is the first symbol, the gram is as frequent as
            # its suffix and the chunk that adds that one has it; where all that follows is the last, as its prefix
            for node, sure in ((self.prefix, first[self.suffix]), (self.suffix, self.alone[self.prefix])):
                self.sure[sure] = (self.n[node] * 2 + self.adds[node])[sure]

    def scores(self, ids: pa.Array) -> pa.Table:
        total = lambda v: pa.array(np.add.reduceat(v, self.first))
        return pa.table([ids, pa.array(self.held), pa.array(self.lengths), total(self.seen.astype(np.int64)),
                         total(self.base), total(self.p)],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def _after(trips: int, row: pa.Table, replies: pa.Table | None, learnt: Learnt) -> Chunk:
    """The chunk after so many trips; trip t asks for the grams of level t and the contexts of level t - 1."""
    chunk = Chunk(row, learnt)
    if not trips:
        return chunk
    replies = replies.sort_by([("trip", "ascending"), ("part", "ascending")])
    trip, grams = replies.column("trip").to_numpy(), replies.column("part").to_numpy() < learnt.parts

    def told(at: int) -> np.ndarray:
        some = replies.filter(pa.array((trip == at) & grams))
        return np.concatenate([np.zeros(0, U64), *(_unpacked(x) for x in some.column("told").to_pylist())])

    def backoff(at: int) -> tuple[np.ndarray, np.ndarray]:
        some = replies.filter(pa.array((trip == at) & ~grams))
        kept = np.frombuffer(b"".join(_large(x) for x in some.column("told").to_pylist()), bool)
        return kept, np.frombuffer(b"".join(_large(x) for x in some.column("backoff").to_pylist()))

    chunk.told(told(0))
    for level in range(1, min(trips - 1, learnt.depth) + 1):
        chunk.longer()
        chunk.told(told(level))
        if level + 1 < trips:
            chunk.backed(*backoff(level + 1), scored=trips > learnt.depth + 1)
    return chunk


def _asked(trip: int, row: pa.Table, replies: pa.Table | None, learnt: Learnt) -> pa.Table:
    """What the chunk asks for in this trip, a row for each part; those of contexts come after those of grams."""
    chunk, rows, parts = _after(trip, row, replies, learnt), [], U64(learnt.parts)

    def bounds(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
        part = ((keys >> U64(32)) * parts >> U64(32)).astype(np.int64)
        at = np.flatnonzero(np.diff(part, prepend=-1))
        yield from zip(part[at].tolist(), at.tolist(), [*at[1:].tolist(), len(part)])

    if trip > 1:
        keys, k, c, seen, shorter, fit = chunk.contexts()
        some, more = (np.concatenate([[0], np.cumsum(k >= least)]) for least in (4, 8))
        for part, a, b in bounds(keys):
            i, j = some[a], some[b]
            rows.append((learnt.parts + part, _packed_keys(keys[a:b]), _packed(k[a:b]), _packed(c[i:j]), _packed(seen[i:j]),
                         _small(shorter[i:j].tobytes()), _small(fit[more[a]:more[b]].tobytes())))
    if trip <= learnt.depth:
        if trip:
            chunk.longer()
        keys, n = chunk.grams()
        rows += [(part, _packed_keys(keys[a:b]), _packed(n[a:b]), None, None, None, None) for part, a, b in bounds(keys)]
    part, *rest = zip(*rows) if rows else [()] * 7
    return pa.table([pa.array(part, pa.int32()), pa.array([row.column("chunk")[0].as_py()] * len(rows), pa.int64()),
                     *(pa.array(c, pa.binary()) for c in rest)], names=["part", "chunk", "keys", "counts", "totals", "seen", "shorter", "fit"])


def _counts(trip: int, asked: pa.Table, learnt: Learnt) -> pa.Table:
    """Replies to the rows of a part."""
    keys = [_unpacked_keys(x) for x in asked.column("keys").to_pylist()]
    ends = np.cumsum([len(x) for x in keys])
    own = np.concatenate([_unpacked(x) for x in asked.column("counts").to_pylist()]).astype(np.int64)
    key, group = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    if asked.column("part")[0].as_py() < learnt.parts:
        total = np.bincount(group, own, len(key)).astype(np.int64)
        known = total >= (learnt.some if trip else 1)
        adds, train = np.empty(len(key), np.int64), np.flatnonzero(own)
        adds[group[train]] = train  # one of the chunks with the gram in a training text
        told = np.where(known, total << 1, 0)[group]
        told[adds[known]] += 1
        told, backoff, types = [_packed(x) for x in np.split(told, ends[:-1])], None, int((total > 0).sum())
    else:
        wanted, valued, total = own % 2 > 0, own % 4 > 2, np.bincount(group, own // 4, len(key))
        at, binary = group[own > 3], lambda c: asked.column(c).to_pylist()
        c, seen = (np.concatenate([_unpacked(x) for x in binary(name)]).astype(np.int64) for name in ("totals", "seen"))
        shorter, more = (np.frombuffer(b"".join(_large(x) for x in binary(name))) for name in ("shorter", "fit"))
        fit = seen * (np.log(seen - DISCOUNT) - np.log(shorter))  # of a single gram
        fit[own[own > 3] > 7] = more
        count = np.ones(len(key))
        count[at] = c
        backoff = learnt.backoff(trip - 1, key, count, total, *(np.bincount(at, v, len(key)) for v in (seen, shorter, fit)))
        backoff = backoff[group]
        kept, (each, wanted, valued) = ~np.isnan(backoff), (np.split(x, ends[:-1]) for x in (backoff, wanted, valued))
        kept = np.split(kept, ends[:-1])
        told = [_small(x[y].tobytes()) for x, y in zip(kept, wanted)]
        backoff, types = [_small(x[y & z].tobytes()) for x, y, z in zip(each, kept, valued)], 0
    return pa.table([asked.column("part"), asked.column("chunk"), pa.array(told, pa.binary()),
                     pa.array(backoff or [None] * len(told), pa.binary()), pa.array([types] + [0] * (len(told) - 1), pa.int64())],
                    names=["part", "chunk", "told", "backoff", "types"])


def _trip(trip: int, chunks: DataFrame, replies: DataFrame | None, learnt: Learnt) -> DataFrame:
    """(trip, part, chunk, told, backoff, types): the replies to what all chunks ask for."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _asked(trip, pa.Table.from_batches([batch.slice(i, 1)]), None, learnt).to_batches()

    chunks = chunks.select("chunk", "held", "lengths", "keys", "tokens")
    asked = (chunks.mapInArrow(first, ASKED) if replies is None else chunks.groupBy("chunk").cogroup(replies.groupBy("chunk"))
             .applyInArrow(lambda row, told: _asked(trip, row, told, learnt), ASKED))
    told = asked.groupBy("part").applyInArrow(lambda rows: _counts(trip, rows, learnt), TOLD)
    return dealt(told.select(F.lit(trip).alias("trip"), "*"), "chunk")


def lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", parts: int = 7, part: int = 2,
              depth: int = DEPTH) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for
    each row of ``docs``.

    Learns from the rows whose crc32(id) mod ``parts`` is not ``part`` (a null
    id is not held out).  Null and empty texts are one end symbol.  Scores are
    log10 probabilities; an unknown symbol has the root's share for count 0.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col, parts, part).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    chunks = dealt(rows.mapInArrow(_chunks, f"chunk long, ids array<{id_type}>, held array<boolean>, lengths array<long>, "
                                   "keys binary, tokens binary, n_train long, n_all long, texts long"), "chunk")
    tokens, every, texts = chunks.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_train", "n_all", "texts"))).first()
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    learnt = Learnt(depth, tokens, texts, max(1, -(-every // PART_KEYS), min(tasks, every // FEW_KEYS)))
    replies = None
    for trip in range(depth + 2):
        more = _trip(trip, chunks, replies, learnt)
        if not trip:
            learnt.types = more.agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
        more = more.drop("types")
        replies = more if replies is None else replies.unionByName(more)
    scored = (chunks.select("chunk", "ids", "held", "lengths", "keys", "tokens").groupBy("chunk").cogroup(replies.groupBy("chunk"))
              .applyInArrow(lambda row, told: _after(depth + 2, row, told, learnt).scores(row.column("ids").combine_chunks().flatten()),
                            f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
    return scored.select(F.col("doc_id").alias(id_col), "held_out", "n_tokens", "n_known",
                         F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
