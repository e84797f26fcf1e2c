"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces are those of a SentencePiece model file.  Its order is by frequency,
so a piece of rank r has the log score -log(r + 1) (Zipf's law; ``scores`` can
give others).  A text gets a blank before it and each blank becomes the marker
U+2581.  The best segmentation has the highest sum of scores, ties to the one
found first by start and length.  A character that no piece covers scores 10
below the least piece and is written as the pieces of its UTF-8 bytes; so is a
marker that stands in the text itself, hence decoding gives the text back.

No piece holds a marker behind another character, so a text falls into chunks
(blanks, then other characters) that are segmented apart: each distinct chunk of
a batch once, all of them in vector steps over the trie.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.chunks import Memo, spread
from trendspark.llm.common import by_bytes, reduce_sum

MARK = "▁"
#: Stands for a marker of the text itself while encoding; no valid UTF-8 holds it, so no piece does.
_OWN = b"\xff"
#: Chunks of more bytes are segmented one by one, without padding.
LONG = 96
_CHUNK = re.compile(r" *[^ ]+| +")


class DoubleArray:
    """Trie over bytes in two arrays: the child of s by b is t = base[s] + b, if check[t] == s."""

    def __init__(self, keys: dict[bytes, int]):
        size = max(1 << 12, 2 * sum(map(len, keys)) + 1024)
        base, check, end = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        check[0] = 0
        low = 1  # the search for room begins here; nearly all below is taken
        todo = [(0, sorted(keys), 0)]
        while todo:
            state, words, depth = todo.pop()
            if words and len(words[0]) == depth:
                end[state] = keys[words[0]]
                words = words[1:]
            if not words:
                continue
            groups = [(b, list(g)) for b, g in itertools.groupby(words, key=lambda w: w[depth])]
            letters = np.array([b for b, _ in groups])
            at, width = low, 512
            while True:  # first fit, a stretch of places at once
                room = np.flatnonzero(check[at:at + width] < 0) + at - letters[0]
                room = room[room > 0]
                if len(room):
                    room = room[(check[room[:, None] + letters[None, :]] < 0).all(axis=1)]
                if len(room):
                    break
                at, width = at + width, 2 * width
                if at + width + 512 > len(check):
                    more = len(check)
                    base, check, end = (np.concatenate([x, np.full(more, fill, np.int32)]) for x, fill in ((base, 0), (check, -1), (end, -1)))
            if at > low and (check[low:at] >= 0).mean() > 0.9:
                low = at
            while check[low] >= 0:
                low += 1
            b = int(room[0])
            base[state] = b
            check[b + letters] = state
            todo += [(b + c, g, depth + 1) for c, g in groups]
        self.base, self.check, self.end = base, check, end

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Children, -1 where there is none."""
        t = np.minimum(self.base[state] + byte, len(self.check) - 1)
        return np.where((self.check[t] == state) & (t != 0), t, -1)


class Pieces:
    """Segmenter and decoder over a model file."""

    def __init__(self, path: str, scores: str = "zipf"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.byte = {int(self.text[i][1:-1], 16): i for i in range(n) if model.is_byte(i)}
        skip = {i for i in range(n) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        normal = [i for i in range(n) if i not in skip]
        if scores == "zipf":
            self.score = np.full(n, -np.inf)
            self.score[normal] = -np.log(np.arange(len(normal)) + 1.0)
        else:
            self.score = np.array([model.get_score(i) for i in range(n)], np.float64)
        self.unknown = float(self.score[normal].min()) - 10
        self.trie = DoubleArray({self.text[i].encode(): i for i in normal})
        back = {i: b for b, i in self.byte.items()}
        plain = [bytes([back[i]]) if i in back else b"" if i in skip else self.text[i].replace(MARK, " ").encode() for i in range(n)]
        # the bytes of each piece, then what it is at the head of a text, without the blank put before
        self.plain = pa.array(plain + [t.removeprefix(b" ") for t in plain], pa.binary())
        self.is_byte = np.isin(np.arange(n), list(back))
        self.memo = Memo()

    def _prepared(self, chunk: str) -> bytes:
        return _OWN.join(part.replace(" ", MARK).encode() for part in chunk.split(MARK))

    def segment(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, ids per chunk); chunks as :meth:`_prepared` gives them."""
        if not len(chunks):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        ends = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset:chunks.offset + len(chunks) + 1].astype(np.int64)
        start, n = ends[:-1], np.diff(ends)
        data = np.frombuffer(chunks.buffers()[2] or b"", np.uint8)
        count, found = np.zeros(len(chunks), np.int64), []
        order = np.argsort(n, kind="stable")
        short = int(np.searchsorted(n[order], LONG, "right"))
        for a in range(0, short, 8192):
            rows = order[a:min(a + 8192, short)]
            ids, size = self._vector(data, start[rows], n[rows])
            count[rows] = size
            found.append((rows, ids))
        for i in order[short:].tolist():
            ids = self._single(data[start[i]:start[i] + n[i]].tobytes())
            count[i] = len(ids)
            found.append((np.array([i]), np.array(ids, np.int32)))
        first = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), np.int32)
        for rows, ids in found:
            size = count[rows]
            out[np.repeat(first[rows] - (np.cumsum(size) - size), size) + np.arange(len(ids))] = ids
        return out, count

    def _emit(self, data: bytes, back: list[tuple[int, int]]) -> list[int]:
        """Ids from the (length, piece) that ends at each place; piece -1: unknown."""
        ids: list[int] = []
        at = len(data)
        while at:
            n, piece = back[at]
            if piece >= 0:
                ids.append(piece)
            else:
                raw = data[at - n:at]
                ids += [self.byte[b] for b in reversed(MARK.encode() if raw == _OWN else raw)]
            at -= n
        return ids[::-1]

    @staticmethod
    def _char(first: int) -> int:
        """Bytes of the character that begins with this byte."""
        return 1 if first < 0xC0 or first == 0xFF else 2 if first < 0xE0 else 3 if first < 0xF0 else 4

    def _single(self, data: bytes) -> list[int]:
        base, check, end, score = self.trie.base, self.trie.check, self.trie.end, self.score
        best, back = [0.0] + [-np.inf] * len(data), [(0, -1)] * (len(data) + 1)
        i = 0
        while i < len(data):
            char, single, s = self._char(data[i]), False, 0
            for j in range(i, len(data)):
                t = int(base[s]) + data[j]
                if t >= len(check) or t == 0 or check[t] != s:
                    break
                s = t
                if (p := int(end[s])) >= 0:
                    single |= j + 1 - i == char
                    if best[i] + score[p] > best[j + 1]:
                        best[j + 1], back[j + 1] = best[i] + float(score[p]), (j + 1 - i, p)
            if not single and best[i] + self.unknown > best[i + char]:
                best[i + char], back[i + char] = best[i] + self.unknown, (char, -1)
            i += char
        return self._emit(data, back)

    def _vector(self, data: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for the chunks data[start:start + n], a step for all at a time: (ids of all, ids per chunk)."""
        rows, width = len(n), int(n.max(initial=0))
        if not width:
            return np.zeros(0, np.int32), np.zeros(rows, np.int64)
        place = np.arange(width)[:, None]
        grid = np.where(place < n, data[np.minimum(start + place, len(data) - 1)], 0)  # a row for each place
        char = np.select([grid < 0xC0, grid == 0xFF, grid < 0xE0, grid < 0xF0], [1, 1, 2, 3], 4)
        best = np.full((width + 4, rows), -np.inf)
        best[0] = 0
        size, piece = np.zeros(best.shape, np.int8), np.full(best.shape, -1, np.int32)
        base, check, end = self.trie.base, self.trie.check, self.trie.end
        last = len(check) - 1
        for i in range(width):
            head = np.flatnonzero((n > i) & ((grid[i] & 0xC0) != 0x80))
            if not len(head):
                continue
            single = np.zeros(rows, bool)
            state, live = np.zeros(len(head), np.int32), head
            for j in range(i, width):
                to = np.minimum(base[state] + grid[j, live], last)
                on = np.flatnonzero((check[to] == state) & (to != 0) & (n[live] > j))
                live, state = live[on], to[on]
                if not len(live):
                    break
                p = end[state]
                hit = np.flatnonzero(p >= 0)
                r, p = live[hit], p[hit]
                single[r[char[i, r] == j + 1 - i]] = True
                s = best[i, r] + self.score[p]
                up = np.flatnonzero(s > best[j + 1, r])
                r = r[up]
                best[j + 1, r], size[j + 1, r], piece[j + 1, r] = s[up], j + 1 - i, p[up]
            r = head[~single[head]]
            s, to = best[i, r] + self.unknown, i + char[i, r]
            up = np.flatnonzero(s > best[to, r])
            r, to = r[up], to[up]
            best[to, r], size[to, r], piece[to, r] = s[up], char[i, r], -1
        return self._back(data, start, n, size, piece)

    def _back(self, data, start, n, size, piece) -> tuple[np.ndarray, np.ndarray]:
        """Ids from the (length, piece) tables, from all ends at once."""
        at, live, steps = n.copy(), np.flatnonzero(n), []
        count, odd = np.zeros(len(n), np.int64), np.zeros(len(n), bool)
        while len(live):
            p = piece[at[live], live]
            steps.append((live, p))
            odd[live[p < 0]] = True
            count[live] += 1
            at[live] -= size[at[live], live]
            live = live[at[live] > 0]
        own = {int(r): self._emit(data[start[r]:start[r] + n[r]].tobytes(), list(zip(size[:, r].tolist(), piece[:, r].tolist())))
               for r in np.flatnonzero(odd)}  # with unknown characters: bytes
        done = count.copy()
        count[list(own)] = [len(x) for x in own.values()]
        first = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), np.int32)
        for k, (r, p) in enumerate(steps):
            plain = ~odd[r]
            r, p = r[plain], p[plain]
            out[first[r] + done[r] - 1 - k] = p
        for r, ids in own.items():
            out[first[r]:first[r] + len(ids)] = ids
        return out, count

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`segment` of words with a blank before; an empty text has no chunk."""
        data = pc.replace_substring(words.cast(pa.binary()), MARK.encode(), _OWN)
        marked = pc.binary_join_element_wise(pa.scalar(MARK.encode()), data, pa.scalar(b""))
        return self.segment(pc.if_else(pc.equal(data, b""), pa.scalar(b""), marked))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text); a null text has none."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, "^ |  | $").to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts), " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        coded = pc.dictionary_encode(parts.flatten())
        ids, first, size = self.memo.ids_of(coded.dictionary, self._words)
        entry = coded.indices.to_numpy().astype(np.int64)
        if odd.any():
            own = np.flatnonzero(odd)
            chunks = [[self._prepared(c) for c in _CHUNK.findall(" " + texts[int(i)].as_py())] for i in own]
            more, n = self.segment(pa.array(list(itertools.chain.from_iterable(chunks)), pa.binary()))
            n = reduce_sum(n, np.concatenate([[0], np.cumsum([len(c) for c in chunks])]))
            entry = entry.copy()
            entry[offsets[own]] = len(first) + np.arange(len(own))  # its one empty chunk stands for the text
            first = np.concatenate([first, len(ids) + np.cumsum(n) - n])
            ids, size = np.concatenate([ids, more]), np.concatenate([size, n])
        out, n = spread(ids, first, size, entry)
        return out, reduce_sum(n, offsets)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Bytes of the texts ids[offsets[i]:offsets[i + 1]]: pieces joined, markers to blanks, the blank put before taken off."""
        at = ids.astype(np.int64)
        at[offsets[:-1][offsets[:-1] < offsets[1:]]] += len(self.text)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), self.plain.take(pa.array(at))), b"")


_pieces: dict[tuple[str, str], Pieces] = {}


def pieces(path: str, scores: str) -> Pieces:
    if (path, scores) not in _pieces:
        _pieces[path, scores] = Pieces(path, scores)
    return _pieces[path, scores]


def encode(docs: DataFrame, *, file: str = "piece_bpe_32k.model", path: str | None = None, scores: str = "zipf",
           text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids (array<int>) of the text; all rows and other columns stay.

    A null text has null ids, an empty one none.  One pass, no shuffle.
    """
    names = [c for c in docs.columns if c != ids_col]
    at = names.index(text_col)
    rows = docs.select(*names).withColumn(text_col, F.col(text_col).cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", __ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path or public_tokenizers.path(file), scores)
        for batch in by_bytes(batches, text_col, 4 << 20):
            ids, n = p.encode(batch.column(at))
            null = batch.column(at).is_null()
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids), mask=null)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*names, "__ids"])
    return rows.mapInArrow(run, schema).withColumnRenamed("__ids", ids_col)


def _text(data: pa.Array) -> pa.Array:
    """As strings; bytes that are no UTF-8 are replaced."""
    try:
        return data.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if d is None else d.decode("utf-8", "replace") for d in data.to_pylist()], pa.string())


def decode(rows: DataFrame, *, file: str = "piece_bpe_32k.model", path: str | None = None, scores: str = "zipf",
           ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of the ids; null ids give a null text."""
    names = [c for c in rows.columns if c != out_col]
    at = names.index(ids_col)
    kept = rows.select(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", __text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path or public_tokenizers.path(file), scores)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):  # bounded working memory
                part = batch.slice(a, 256)
                lists = part.column(at)
                n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                texts = _text(p.decode(ids, np.concatenate([[0], np.cumsum(n)])))
                texts = pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), texts)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*names, "__text"])
    return kept.mapInArrow(run, schema).withColumnRenamed("__text", out_col)


def digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", file: str = "piece_bpe_32k.model",
           path: str | None = None, scores: str = "zipf") -> DataFrame:
    """(id, ids, n_tokens, n_byte_tokens, round_trip): encoded, decoded again and compared, in one pass.

    Null texts: null ids, 0 tokens, a round trip; empty texts: no ids.  A null id
    is kept, and repeated rows are digested each; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    schema = f"__id {rows.schema['__id'].dataType.simpleString()}, ids array<int>, n_tokens int, n_byte_tokens int, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path or public_tokenizers.path(file), scores)
        for batch in by_bytes(batches, "__text", 2 << 20):
            texts = batch.column(1)
            ids, n = p.encode(texts)
            offsets = np.concatenate([[0], np.cumsum(n)])
            same = pc.equal(p.decode(ids, offsets), pc.fill_null(texts, "").cast(pa.binary()))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids), mask=texts.is_null())
            fallback = reduce_sum(p.is_byte[ids].astype(np.int64), offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(n.astype(np.int32)), pa.array(fallback.astype(np.int32)), same],
                                             names=["__id", "ids", "n_tokens", "n_byte_tokens", "round_trip"])
    return rows.mapInArrow(run, schema).withColumnRenamed("__id", id_col)
