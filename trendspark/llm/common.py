"""Helpers of the training-data operators: table access, Arrow batches cut by
bytes, and vectorised word hashing.

Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased.  A
word is known by a 64-bit polynomial hash of its bytes, so counting, shingling
and joining never move the strings themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
#: Bytes of text that one step of a batch holds at a time.
STEP_BYTES = 1 << 20

_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_GOLD = U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mixing generator: one well-spread word per input."""
    x = x + _GOLD
    x = (x ^ (x >> U64(30))) * _MIX1
    x = (x ^ (x >> U64(27))) * _MIX2
    return x ^ (x >> U64(31))


def mix64_in_place(x: np.ndarray) -> None:
    """:func:`mix64` of ``x``, without copies of it but one."""
    x += _GOLD
    t = x >> U64(30)
    x ^= t
    x *= _MIX1
    np.right_shift(x, U64(27), out=t)
    x ^= t
    x *= _MIX2
    np.right_shift(x, U64(31), out=t)
    x ^= t


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = mix64(np.arange(256, dtype=U64) + U64(1 << 32))
_RAW = _BYTE.copy()
_BYTE[_SPACE] = 0
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        n = max(n, STEP_BYTES + 4096)
        for key, base in (("up", _BASE), ("down", _UNBASE)):
            p = np.full(n, U64(base))
            p[0] = 1
            _powers[key] = np.cumprod(p, dtype=U64)
    return _powers["up"], _powers["down"]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start byte) of each word of ``data``, in order.

    The bytes are taken in steps cut behind a space, so a very long text needs
    no more working memory than a short one (but for a single longer word).
    """
    buf = np.frombuffer(data, dtype=np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(buf):
        end = min(len(buf), at + STEP_BYTES)
        if end < len(buf):
            cut = np.flatnonzero(_SPACE[buf[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:  # one word longer than a step: take it whole
                more = next((i for i in range(end, len(buf)) if _SPACE[buf[i]]), len(buf))
                end = more
        part = _LOWER[buf[at:end]]
        word = np.concatenate([[False], ~_SPACE[part], [False]])
        edge = np.flatnonzero(word[1:] != word[:-1])
        first, last = edge[::2], edge[1::2]
        if len(first):
            up, down = _power(len(part))
            total = np.concatenate([np.zeros(1, U64), np.cumsum(_BYTE[part] * up[:len(part)], dtype=U64)])
            h = (total[last] - total[first]) * down[first]
            hashes.append(mix64(h + (last - first).astype(U64)))
            starts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def text_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts, offsets): text i owns words
    ``offsets[i]:offsets[i + 1]``."""
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    hashes, starts = word_hashes(b"\n".join(texts))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return hashes, np.searchsorted(starts, bounds)


#: Kinds of bytes for ``runs``: 0 space, 1 letters (and all bytes of other scripts), 2 digits, from 3 each mark alone.
_KIND = np.arange(256, dtype=np.int16) + 3
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_KIND[_SPACE] = 0


def runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, shape, offsets) of the runs of one kind of byte of each text, case
    kept.  Shapes: 0 lower, 1 capitalised, 2 upper, 3 digits, 4 a point or
    comma, 5 another single mark, 6 repeated marks, 7 letters over 40 bytes."""
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    up, down = _power(min(len(data), STEP_BYTES) + 1)
    kind = _KIND[data]
    edge = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1], [True]])) if len(data) else np.zeros(1, int)
    first, last = edge[:-1], edge[1:]
    word = kind[first] > 0
    first, last = first[word], last[word]
    hashes = np.empty(len(first), U64)
    caps = np.empty(len(first), np.int64)
    upper = (data >= 65) & (data <= 90)
    a = 0
    while a < len(first):  # steps of whole runs, so that powers and sums stay short
        b = max(a + 1, int(np.searchsorted(last, first[a] + STEP_BYTES, "right")))
        lo, hi = int(first[a]), int(last[b - 1])
        up, down = _power(hi - lo + 1)
        part = data[lo:hi]
        total = np.concatenate([np.zeros(1, U64), np.cumsum((_RAW[part]) * up[:len(part)], dtype=U64)])
        i, j = first[a:b] - lo, last[a:b] - lo
        hashes[a:b] = mix64((total[j] - total[i]) * down[i] + (j - i).astype(U64))
        count = np.concatenate([[0], np.cumsum(upper[lo:hi])])
        caps[a:b] = count[j] - count[i]
        a = b
    size, k = last - first, kind[first]
    shape = np.where(k == 2, 3, np.where((k == 3 + 44) | (k == 3 + 46), 4, 5))
    shape = np.where((k > 2) & (size > 1), 6, shape)
    letters = k == 1
    shape = np.where(letters, np.where(size > 40, 7, np.where((caps == size) & (size > 1), 2, np.where(upper[first] if len(first) else False, 1, 0))), shape)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return hashes, shape, np.searchsorted(first, bounds)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of each hold about ``limit`` bytes:
    work and memory of a step follow bytes, not rows.  A longer text is alone."""
    for batch in batches:
        i = batch.schema.get_field_index(column)
        size = pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(size) - size) // limit
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]]).astype(int)
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def reduce_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring offsets (0 where there are none)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]
