"""SuperMinHash signatures, vectorised over the sets of a batch.

Each element draws, by a generator seeded with its hash, a random permutation
of the slots and a value in [j, j+1) for the j-th slot it visits; a slot keeps
its smallest value.  Values of step j are all below those of step j+1, so the
sets of a batch are advanced step by step together and a set stops as soon as
every slot holds a value of a finished step.  Two sets agree in a slot with
probability equal to their Jaccard similarity, with less variance than
independent permutations give because one element's slots differ.
"""

from __future__ import annotations

import numpy as np

from trendspark.llm.common import U64, mix64, mix64_in_place

_STEP = 0xA0761D6478BD642F
_LOW = U64(0xFFFFFFFF)
_SHIFT = U64(32)
EMPTY = U64(0xFFFFFFFFFFFFFFFF)
#: Elements that are advanced together: their permutations should stay in the processor's cache.
TOGETHER = 32000
#: The first steps follow an element's exchanges one by one; its whole permutation is laid out only for more.
REPLAYED = 16


def signatures(elements: np.ndarray, offsets: np.ndarray, slots: int) -> np.ndarray:
    """(sets, slots) of uint64: step in the upper half, the random value in the
    lower.  Set i owns ``elements[offsets[i]:offsets[i + 1]]`` (repeats do no
    harm).  An empty set has ``EMPTY`` in every slot.  Sets of like size are
    taken together, as they need about the same number of steps."""
    size = np.diff(offsets)
    out = np.empty((len(size), slots), U64)
    order = np.argsort(size, kind="stable")
    group = (np.cumsum(size[order]) - size[order]) // TOGETHER
    for sets in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        ends = np.concatenate([[0], np.cumsum(size[sets])])
        out[sets] = _signatures(elements[np.repeat(offsets[sets] - ends[:-1], size[sets]) + np.arange(int(ends[-1]))], ends, slots)
    return out


def _signatures(elements: np.ndarray, offsets: np.ndarray, slots: int) -> np.ndarray:
    n = len(offsets) - 1
    sig = np.full(n * slots, EMPTY)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    live, row = elements, owner * slots
    small = np.uint8 if slots <= 256 else np.int32
    swaps: list[tuple[np.ndarray, np.ndarray]] = []  # of each step: the place exchanged with its own, and what its own held
    perm = None
    for j in range(slots):
        if not len(live):
            break
        x = live + U64(_STEP * (j + 1) & 0xFFFFFFFFFFFFFFFF)
        mix64_in_place(x)
        k = (((x & _LOW) * U64(slots - j)) >> _SHIFT).astype(small) + small(j)
        if j == REPLAYED:
            perm = np.tile(np.arange(slots, dtype=small), (len(live), 1))
            at = np.arange(len(live))
            for place, held in swaps:
                perm[at, place] = held
        if perm is None:
            slot, own = k, np.full(len(k), j, small)
            for place, held in swaps:
                slot, own = np.where(place == k, held, slot), np.where(place == small(j), held, own)
            swaps.append((k, own))
        else:
            at = np.arange(len(live))
            slot = perm[at, k]
            perm[at, k] = perm[:, j]
            perm[:, j] = slot
        at = row + slot
        if j:  # a slot with a value of an earlier step keeps it
            free = np.flatnonzero(sig[at] >= U64(j) << _SHIFT)
            at, x = at.take(free), x.take(free)
        np.minimum.at(sig, at, (U64(j) << _SHIFT) | (x >> _SHIFT))
        done = (sig.reshape(n, slots) < (U64(j + 1) << _SHIFT)).all(axis=1)
        if done.all():
            break
        keep = np.flatnonzero(~done[owner])
        if 4 * len(keep) <= 3 * len(live):  # later values change nothing in a finished set
            live, owner, row = live[keep], owner[keep], row[keep]
            swaps = [(place[keep], held[keep]) for place, held in swaps] if perm is None else []
            if perm is not None:
                perm = perm[keep]
    return sig.reshape(n, slots)


def bands(sig: np.ndarray, count: int, rows: int) -> np.ndarray:
    """(sets, count) of int64: one hash of ``rows`` slots per band, mixed with
    the band's number so that a hash names its band."""
    out = np.empty((len(sig), count), dtype=np.int64)
    for b in range(count):
        h = np.full(len(sig), U64(b + 1))
        for r in range(rows):
            h = mix64(h * U64(_STEP) + sig[:, b * rows + r])
        out[:, b] = h.view(np.int64)
    return out
