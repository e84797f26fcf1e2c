"""Signatures of sets by fast similarity sketching, vectorised over a batch.

In each of ``ROUNDS`` rounds every element draws a slot and a value; a slot
keeps the smallest value of the first round that reached it.  A slot that no
round reached takes the smallest of its own hash of all the elements.  By
symmetry each element of two sets' union is as likely to hold a slot, so they
agree in it with probability equal to their Jaccard similarity.  A set stops
drawing as soon as all its slots are taken, after about slots * log(slots)
draws; a draw is a few operations on 32-bit numbers.
"""

from __future__ import annotations

import numpy as np

from trendspark.llm.common import U64

U32 = np.uint32
ROUNDS = 24
#: Elements that are advanced together, which should stay in the processor's cache.
TOGETHER = 32000
EMPTY = U64(0xFFFFFFFFFFFFFFFF)
_SLOT, _VALUE = 0x9E3779B1, 0x85EBCA77


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A well-spread 32-bit number for each of ``x``, other ones for another seed."""
    x = x + U32(seed & 0xFFFFFFFF)
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        x ^= x >> U32(shift)
        x *= U32(factor)
    x ^= x >> U32(16)
    return x


def signatures(elements: np.ndarray, offsets: np.ndarray, slots: int) -> np.ndarray:
    """(sets, slots) of uint64: the round in the upper half, the value in the
    lower.  Set i owns ``elements[offsets[i]:offsets[i + 1]]``, well-spread
    hashes (repeats do no harm).  An empty set has ``EMPTY`` in every slot.
    Sets of like size are taken together, as they need about as many rounds."""
    size = np.diff(offsets)
    out = np.empty((len(size), slots), U64)
    order = np.argsort(size, kind="stable")
    group = (np.cumsum(size[order]) - size[order]) // TOGETHER
    for sets in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        own = [elements[a:b] for a, b in zip(offsets[sets].tolist(), offsets[sets + 1].tolist())]
        out[sets] = _signatures(np.concatenate([elements[:0], *own]), size[sets], slots)
    return out


def _signatures(elements: np.ndarray, size: np.ndarray, slots: int) -> np.ndarray:
    n = len(size)
    least = np.full(n * slots, 0xFFFFFFFF, U32)  # the smallest value of a slot in its round
    taken = np.full(n * slots, 0xFFFFFFFF, U32)  # the round
    free = np.ones(n * slots, bool)
    owner = np.repeat(np.arange(n), size)
    row = owner * slots
    low, high = elements.astype(U32), (elements >> U64(32)).astype(U32)

    def put(at: np.ndarray, values: np.ndarray, r: int) -> None:
        np.minimum.at(least, at, values)
        taken[at] = r

    for r in range(ROUNDS):
        if not len(low):
            break
        x = _mixed(low, _SLOT * (r + 1))
        x >>= U32(16)
        x *= U32(slots)
        x >>= U32(16)
        at = row + x
        if r:  # a slot of an earlier round is as it is
            new = np.flatnonzero(free.take(at))
            at, drawn = at.take(new), high.take(new)
        else:
            drawn = high
        put(at, _mixed(drawn, _VALUE * (r + 1)), r)
        free[at] = False
        more = free.reshape(n, slots).any(axis=1)
        if 4 * int(size[more].sum()) <= 3 * len(low):  # later rounds change nothing in a finished set
            keep = np.flatnonzero(more.take(owner))
            low, high, owner, row = low.take(keep), high.take(keep), owner.take(keep), row.take(keep)
    lacking = free.reshape(n, slots)[size > 0].any(axis=0)
    for s in np.flatnonzero(lacking).tolist():
        some = np.flatnonzero(free.take(row + s))
        put(row.take(some) + s, _mixed(high.take(some), _VALUE * (ROUNDS + 1 + s)), ROUNDS + s)
    return ((taken.astype(U64) << U64(32)) | least).reshape(n, slots)
