"""Static range asymmetric numeral system over arrays of token ids.

A shard holds one frequency table, shared by all its blocks, and blocks that
stand alone: each has ``LANES`` interleaved coder states and one stream of
words.  All blocks of a shard are coded together, one vector step for
the same row of every block.  Every ``EVERY`` rows a checkpoint keeps the
states and the place in the stream, so the pieces of one block are decoded in
parallel too.  States stay in [2^28, 2^52), so that their division is exact in
double precision, and are refilled by words of three bytes.  Bytes of a block
(little-endian):

    magic 'RANS', version, lanes, rows, tokens, checkpoint distance, words
    for each checkpoint, the last rows first: place in the stream, LANES states
    words of the stream, in reading order
    crc32 of all bytes before
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

from trendspark.llm.common import U64

MAGIC, VERSION = b"RANS", 1
LANES = 32
#: Rows of a block (so 65,536 tokens) and rows between checkpoints.
ROWS, EVERY = 2048, 512
BITS = 20
_HEAD = struct.Struct("<4sHHIIII")
_FLOOR = U64(1 << 28)
_WORD = U64(24)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols ascending, frequencies that sum to 2^BITS, each at least 1)."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    total = 1 << BITS
    if len(symbols) > total // 2:
        raise ValueError("too many distinct ids in a shard")
    free = total - len(symbols)
    exact = counts * (free / counts.sum())
    freq = np.floor(exact).astype(np.int64)
    rest = free - int(freq.sum())
    freq[np.argsort(freq - exact, kind="stable")[:rest]] += 1
    return symbols.astype(np.uint32), (freq + 1).astype(np.uint32)


def pack_table(symbols: np.ndarray, freq: np.ndarray) -> bytes:
    body = struct.pack("<4sI", b"FREQ", len(symbols)) + symbols.astype("<u4").tobytes() + freq.astype("<u4").tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_table(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    magic, n = struct.unpack_from("<4sI", data)
    if magic != b"FREQ" or len(data) != 12 + 8 * n or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("damaged frequency table")
    both = np.frombuffer(data, "<u4", 2 * n, 8)
    return both[:n], both[n:]


def encode(ids: np.ndarray, symbols: np.ndarray, freq: np.ndarray) -> list[bytes]:
    """Blocks of ``LANES * ROWS`` ids (the last one shorter) under the table."""
    size = LANES * ROWS
    return [b for at in range(0, len(ids), 64 * size) for b in _encode_some(ids[at:at + 64 * size], symbols, freq)]


def _encode_some(ids: np.ndarray, symbols: np.ndarray, freq: np.ndarray) -> list[bytes]:
    size = LANES * ROWS
    n_blocks = -(-len(ids) // size)
    start = (np.cumsum(freq) - freq).astype(U64)
    wide, real = freq.astype(U64), freq.astype(np.float64)
    index = np.zeros(int(symbols[-1]) + 1, np.int32)
    index[symbols] = np.arange(len(symbols))
    grid = np.zeros(n_blocks * size, np.int32)
    grid[:len(ids)] = index[ids]  # the end of the last block is filled with the first symbol
    grid = grid.reshape(n_blocks, ROWS, LANES)
    rows = np.full(n_blocks, ROWS)
    rows[-1] = -(-(len(ids) - (n_blocks - 1) * size) // LANES)
    state = np.full((n_blocks, LANES), _FLOOR)
    out = np.zeros((ROWS, n_blocks, LANES), np.uint32)
    sent = np.zeros((ROWS, n_blocks, LANES), bool)
    marks: dict[int, np.ndarray] = {}
    for r in range(ROWS - 1, -1, -1):  # last in, first out
        live = slice(0, n_blocks if r < rows[-1] else n_blocks - 1)
        s = grid[live, r]
        f, x = wide[s], state[live]
        full = x >= (f << U64(52 - BITS))
        out[r, live] = x & U64(0xFFFFFF)
        sent[r, live] = full
        x = np.where(full, x >> _WORD, x)
        q = (x.astype(np.float64) / real[s]).astype(U64)
        state[live] = (q << U64(BITS)) + (x - q * f) + start[s]
        if r % EVERY == 0:
            marks[r] = state.copy()
    blocks = []
    for b in range(n_blocks):
        n = min(size, len(ids) - b * size)
        mask = sent[:rows[b], b]
        words = out[:rows[b], b][mask]
        before = np.concatenate([[0], np.cumsum(mask.sum(axis=1))])
        head = _HEAD.pack(MAGIC, VERSION, LANES, int(rows[b]), n, EVERY, len(words))
        points = b"".join(struct.pack("<I", int(before[r])) + marks[r][b].astype("<u8").tobytes()
                          for r in range(0, int(rows[b]), EVERY))
        body = head + points + words.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
        blocks.append(body + struct.pack("<I", zlib.crc32(body)))
    return blocks


def decode(blocks: list[bytes], symbols: np.ndarray, freq: np.ndarray) -> list[np.ndarray]:
    """Ids of each block; all checkpointed pieces of all blocks advance together."""
    start = (np.cumsum(freq) - freq).astype(U64)
    wide = freq.astype(U64)
    slot = np.repeat(np.arange(len(symbols), dtype=np.int32), freq)
    return [x for at in range(0, len(blocks), 64)
            for x in _decode_some(blocks[at:at + 64], symbols, wide, start, slot)]


def _decode_some(blocks, symbols, wide, start, slot) -> list[np.ndarray]:
    heads, streams, states, places, lengths = [], [], [], [], []
    base = 0
    for data in blocks:
        magic, version, lanes, rows, n, every, words = _HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("damaged block")
        at = _HEAD.size
        for r in range(0, rows, every):
            places.append(base + struct.unpack_from("<I", data, at)[0])
            states.append(np.frombuffer(data, "<u8", lanes, at + 4))
            lengths.append(min(every, rows - r))
            at += 4 + 8 * lanes
        heads.append((n, -(-rows // every)))
        three = np.zeros((words, 4), np.uint8)
        three[:, :3] = np.frombuffer(data, np.uint8, 3 * words, at).reshape(-1, 3)
        streams.append(three.view("<u4").reshape(-1))
        base += words
    stream = np.concatenate(streams + [np.zeros(1, np.uint32)]).astype(U64)
    x, at, lengths = np.array(states, U64), np.array(places), np.array(lengths)
    order = np.argsort(-lengths, kind="stable")  # pieces that end first go last
    x, at, lengths = x[order], at[order], lengths[order]
    out = np.zeros((len(x), EVERY, LANES), np.int32)
    mask = U64((1 << BITS) - 1)
    live = len(x)
    for r in range(int(lengths[0]) if len(lengths) else 0):
        while lengths[live - 1] <= r:
            live -= 1
        v = x[:live]
        low = v & mask
        s = slot[low]
        out[:live, r] = s
        v = wide[s] * (v >> U64(BITS)) + low - start[s]
        need = v < _FLOOR
        place = at[:live, None] + np.cumsum(need, axis=1) - 1
        v = np.where(need, (v << _WORD) | stream[np.where(need, place, 0)], v)
        x[:live] = v
        at[:live] += need.sum(axis=1)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    found, piece = [], 0
    for n, pieces in heads:
        ids = out[back[piece:piece + pieces]].reshape(-1)
        found.append(symbols[ids[:n]])
        piece += pieces
    return found
