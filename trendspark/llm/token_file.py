"""Token-ID output: texts to ids, ids to range-coded files, files back to ids.

The file format is a Parquet table of *segments* in ascending document order:
(shard, segment, tokens, docs, table, index, blocks).  A shard is one range of
document ids; a segment holds whole documents, about ``SEGMENT`` tokens (one
longer document is one segment), with the frequency table that all its blocks
share, the documents' ids and lengths, and the blocks (see ``rans``).  Spark's
writer commits the files, so a task that is run again leaves one copy.
"""

from __future__ import annotations

import itertools
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendspark.llm import rans
from trendspark.llm.chunks import Memo, spread
from trendspark.llm.common import by_bytes, reduce_sum
from trendspark.llm.scratch import fits, folder

#: Tokens of a segment.
SEGMENT = 4 << 20
END_ID = 2

SEGMENTS = "shard int, segment int, tokens long, docs long, table binary, index binary, blocks array<binary>"
#: A blank with white space on both sides, where cutting at blanks would not be safe.
_INNER = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] [\s\x0b\x1c-\x1f\x{85}\p{Z}]"
#: A chunk whose only white space is a blank before it.
_VISIBLE = r"^ ?[^\s\x0b\x1c-\x1f\x{85}\p{Z}]+$"


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ByteEncoder:
    """Ids of whole texts by a byte-level ``tokenizers`` file.

    A text is cut before each blank that follows a visible letter, where the
    pre-tokenizer always cuts, so each distinct chunk of a batch is split and
    merged once, all new ones by one call of the library.  Texts where that is
    not safe go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.letters = _byte_letters()
        # the library's merges over pieces written in its letters, a line feed's letter between them
        self.gap = self.letters[10]
        self.gap_id = self.tokenizer.token_to_id(self.gap)
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = pre_tokenizers.Split(self.gap, "isolated")
        self.known, self.known_pieces = Memo(), Memo()

    def _chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, ids per chunk)."""
        special = np.zeros(len(texts), bool)
        for s in self.specials:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        plain = pc.match_substring_regex(texts, _VISIBLE).to_numpy(zero_copy_only=False) & ~special
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain & ~special), np.flatnonzero(special)])
        # visible chunks at one go: a line feed between two is always taken alone
        many = texts.filter(pa.array(plain))
        pieces = self.split("\n".join(many.to_pylist()))
        rest = [self.split(t) for t in texts.filter(pa.array(~plain & ~special)).to_pylist()]
        head = len(pieces)
        pieces += itertools.chain.from_iterable(rest)
        coded = pc.dictionary_encode(pa.array(pieces, pa.string()))
        ids, first, size = self.known_pieces.ids_of(coded.dictionary, self._merged)
        entry = coded.indices.to_numpy().astype(np.int64)
        gap = pc.index(coded.dictionary, "\n").as_py()
        cut = np.flatnonzero(entry[:head] == gap)
        ends = np.concatenate([cut, [head]])[:len(many)] - np.arange(len(many))  # without the line feeds
        ends = np.concatenate([ends, head - len(cut) + np.cumsum([len(x) for x in rest], dtype=np.int64)])
        out, n = spread(ids, first, size, np.delete(entry, cut))
        n = reduce_sum(n, np.concatenate([[0], ends]).astype(np.int64))
        whole = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts.filter(pa.array(special)).to_pylist()]
        out = np.concatenate([out, *(np.array(x, np.int32) for x in whole)])
        n = np.concatenate([n, np.array([len(x) for x in whole], np.int64)])
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return spread(out, np.cumsum(n) - n, n, back)

    def _merged(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, ids per piece) by the library's merges."""
        size, found, plain, lined = np.zeros(len(pieces), np.int64), [], [], []
        for i, t in enumerate(pieces.to_pylist()):
            (lined if "\n" in t else plain).append((i, t))
        for a in range(0, len(plain), 512):
            part = plain[a:a + 512]
            text = "\n".join(t for _, t in part).encode().decode("latin-1").translate(self.letters)
            ids = np.array(self.merger.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            cut = np.concatenate([[-1], np.flatnonzero(ids == self.gap_id), [len(ids)]])
            rows = np.array([i for i, _ in part])
            size[rows] = np.diff(cut) - 1
            found.append((rows, ids[ids != self.gap_id]))
        for i, t in lined:
            ids = [x.id for x in self.merger.model.tokenize(t.encode().decode("latin-1").translate(self.letters))]
            size[i] = len(ids)
            found.append((np.array([i]), np.array(ids, np.int32)))
        first = np.cumsum(size) - size
        out = np.zeros(int(size.sum()), np.int32)
        for rows, ids in found:
            n = size[rows]
            out[np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, size

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end_id``; ids per text)."""
        texts = pc.fill_null(texts, "")
        odd = np.flatnonzero(pc.match_substring_regex(texts, _INNER).to_numpy(zero_copy_only=False))
        easy = texts
        if len(odd):
            flags = np.ones(len(texts), bool)
            flags[odd] = False
            easy = pc.if_else(pa.array(flags), texts, pa.scalar("", texts.type))
        parts = pc.split_pattern(easy, " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        coded = pc.dictionary_encode(parts.flatten())
        code = coded.indices.to_numpy().astype(np.int64) * 2 + 1  # with a blank before it
        code[offsets[:-1][offsets[:-1] < offsets[1:]]] -= 1
        used = np.zeros(2 * len(coded.dictionary), bool)
        used[code] = True
        used = np.flatnonzero(used)
        words = coded.dictionary.take(pa.array(used >> 1))
        blank = pc.if_else(pa.array((used & 1).astype(bool)), pa.scalar(" "), pa.scalar(""))
        ids, first, size = self.known.ids_of(pc.binary_join_element_wise(blank, words, ""), self._chunks)
        place = np.empty(2 * len(coded.dictionary), np.int64)
        place[used] = np.arange(len(used))
        extra = [[end_id]]
        entry = np.insert(place[code], offsets[1:], len(first))  # each text's end behind its chunks
        owner_ends = offsets + np.arange(len(offsets))
        if len(odd):
            whole = self.tokenizer.encode_batch(texts.take(pa.array(odd)).to_pylist(), add_special_tokens=False)
            extra += [e.ids for e in whole]
            entry[owner_ends[odd]] = len(first) + 1 + np.arange(len(odd))  # its one empty chunk stands for the text
        more = np.array([len(x) for x in extra])
        first = np.concatenate([first, len(ids) + np.cumsum(more) - more])
        ids, size = np.concatenate([ids, *(np.array(x, np.int32) for x in extra)]), np.concatenate([size, more])
        out, n = spread(ids, first, size, entry)
        return out, reduce_sum(n, owner_ends)


_encoders: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


def _pack_index(doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    valid = np.array([d is not None for d in doc_ids], np.uint8)
    ids = np.array([d or 0 for d in doc_ids], "<i8")
    body = struct.pack("<4sI", b"DOCS", len(ids)) + valid.tobytes() + ids.tobytes() + lengths.astype("<i8").tobytes()
    return zlib.compress(body + struct.pack("<I", zlib.crc32(body)), 1)


def _unpack_index(data: bytes) -> tuple[pa.Array, np.ndarray]:
    data = zlib.decompress(data)
    magic, n = struct.unpack_from("<4sI", data)
    if magic != b"DOCS" or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("damaged document index")
    valid = np.frombuffer(data, np.uint8, n, 8)
    ids = np.frombuffer(data, "<i8", n, 8 + n)
    return pa.array(ids, mask=valid == 0), np.frombuffer(data, "<i8", n, 8 + 9 * n)


def _segments(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0

        def close(doc_ids, ids, lengths):
            ids, lengths = np.concatenate(ids), np.concatenate(lengths)
            table = rans.frequencies(ids)
            return pa.RecordBatch.from_pylist(
                [{"shard": shard, "segment": number, "tokens": len(ids), "docs": len(doc_ids),
                  "table": zlib.compress(rans.pack_table(*table), 1), "index": _pack_index(doc_ids, lengths),
                  "blocks": rans.encode(ids, *table)}],
                schema=pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("tokens", pa.int64()),
                                  ("docs", pa.int64()), ("table", pa.binary()), ("index", pa.binary()),
                                  ("blocks", pa.list_(pa.binary()))]))

        doc_ids, ids, lengths, held = [], [], [], 0
        for batch in by_bytes(batches, "text"):
            more, n = encoder(path).encode(batch.column(1), end_id)
            doc_ids += batch.column(0).to_pylist()
            ids.append(more)
            lengths.append(n)
            held += len(more)
            if held >= SEGMENT:
                yield close(doc_ids, ids, lengths)
                number += 1
                doc_ids, ids, lengths, held = [], [], [], 0
        if doc_ids:
            yield close(doc_ids, ids, lengths)
    return run


def write_tokens(docs: DataFrame, path: str, *, file: str = "byte_bpe_50k.json", vocabulary: str | None = None,
                 end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> None:
    """Encode every text and write the segments to ``path``.

    Rows are dealt to ``shards`` (default: the shuffle partitions) by ranges of
    the id, then of the text's head (rows without an id are no single task), and
    sorted by (id, text), null ids first: the one shuffle, of the two columns.  Null texts are empty: the end id alone.
    """
    spark = docs.sparkSession
    where = vocabulary or public_tokenizers.path(file)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    (rows.repartitionByRange(n, "doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
     .mapInArrow(_segments(where, end_id), SEGMENTS).write.parquet(path))


def _read(segment) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    doc_ids, lengths = _unpack_index(segment["index"])
    table = rans.unpack_table(zlib.decompress(segment["table"]))
    ids = rans.decode(segment["blocks"], *table)
    return doc_ids, lengths, np.concatenate(ids) if ids else np.zeros(0, np.uint32)


def located(segments: DataFrame) -> DataFrame:
    """``segments`` with ``start``, the tokens of all segments before.

    Totals per shard (as many rows as shards) are summed in order, then the
    segments of each shard; payloads are not shuffled while the places are few.
    """
    heads = segments.select("shard", "segment", "tokens")
    totals = heads.groupBy("shard").agg(F.sum("tokens").alias("t"))
    before = totals.select("shard", (F.sum("t").over(Window.orderBy("shard")) - F.col("t")).alias("before"))
    inside = F.sum("tokens").over(Window.partitionBy("shard").orderBy("segment")) - F.col("tokens")
    places = heads.withColumn("inside", inside).join(before, "shard").select(
        "shard", "segment", (F.col("before") + F.col("inside")).alias("start"))
    side = F.broadcast(places) if fits(heads, 24) else places
    return segments.join(side, ["shard", "segment"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids array<int>) of every document in the files."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                doc_ids, lengths, ids = _read(row)
                ends = np.cumsum(lengths)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids.astype(np.int32))
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(row["start"] + ends - lengths), lists],
                                                 names=["doc_id", "start", "ids"])
    return located(spark.read.parquet(path)).mapInArrow(run, "doc_id long, start long, ids array<int>")


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its decoded
    ids as little-endian unsigned 32-bit integers."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                doc_ids, lengths, ids = _read(row)
                ends = np.cumsum(lengths)
                data = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(row["start"] + ends - lengths), pa.array(lengths),
                                                  pa.array(crc, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return located(spark.read.parquet(path)).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, **kwargs) -> DataFrame:
    """Write ``docs`` to a new folder of the shared directory, read it back and
    digest it: one row per row of ``docs`` (see :func:`write_tokens`)."""
    path = folder(docs.sparkSession, "tokens")
    write_tokens(docs, path, **kwargs)
    return read_digest(docs.sparkSession, path)
