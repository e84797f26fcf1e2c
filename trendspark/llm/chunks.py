"""Ids of repeated chunks of text, kept between the batches of a worker.

Chunks and ids lie in Arrow and numpy arrays, a few bytes a chunk beside their
own; beyond ``limit`` bytes the memo starts anew.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_BYTES = 24 << 20


class Memo:
    def __init__(self, limit: int = MEMO_BYTES):
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def ids_of(self, words: pa.Array, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
        """(ids, first, size): the ids of word i are ids[first[i]:first[i] + size[i]].

        ``words`` are distinct; ``encode`` gives (ids of all, ids per word) of those not met before.
        """
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(at.is_null())
        ids, size = encode(new) if len(new) else (self.ids[:0], self.size[:0])
        known = len(self.words)
        place = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        place[place < 0] = known + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, new])
        self.ids, self.size = np.concatenate([self.ids, ids.astype(np.int32)]), np.concatenate([self.size, size])
        first = np.cumsum(self.size) - self.size
        out = self.ids, first[place], self.size[place]
        if self.words.nbytes + self.ids.nbytes + self.size.nbytes > self.limit:
            self._clear()
        return out


def spread(ids: np.ndarray, first: np.ndarray, size: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of the entries one after the other, ids per entry)."""
    n = size[entry]
    end = np.cumsum(n)
    return ids[np.repeat(first[entry] - (end - n), n) + np.arange(int(end[-1]) if len(end) else 0)], n
