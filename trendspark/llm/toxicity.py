"""Toxicity: a support vector machine over a gapped subsequence kernel, with
Nystroem landmarks, trained on sentences of labelled documents.

A sentence is its letters and digits, joined, so blanks and characters put between
letters vanish.  Units are runs of up to ``RUN`` words of a sentence, of up to
``LONGEST`` characters (a longer word is cut).  The kernel of two units counts
subsequences of three characters that they share, each weighed by ``DECAY`` to
the characters it spans, up to ``SPAN``, so an insult with letters put in or left
out, or in pieces, still shares most of them.  Subsequences are counted twice, as
they are and with the first letters of words told apart, so that a word is not
the same as its letters at the seam of two words.  Three and more single letters
in a row are a word.

Labels are of documents; of a toxic one only some sentence is.  So training goes
in rounds: a toxic document gives the unit that scores highest, a clean one the
unit that scores highest and one at random, and the machine is fitted to them;
its own margins choose the units of the next round.  The first round is scored by how
much more common the grams of a unit are in toxic documents, without a threshold.

With f = sum over landmarks of a_l K(u, l), the landmarks fold into one weight
per subsequence, so all units of a text are scored by running sums.  A
document's probability is a logistic function of its best unit's margin and of
how many sentences are past zero.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import U64, by_bytes
from trendspark.llm.labelled import held_out, training_rows

DECAY, SPAN = 0.7, 6
#: Words and characters of a unit, at most.
RUN, LONGEST = 4, 24
#: Labelled documents that training takes at most, landmarks, rounds.
SAMPLE_DOCS, LANDMARKS, ROUNDS = 24_000, 320, 4
SLOTS = 1 << 18
#: Characters scored in one step.
STEP = 1 << 19
THRESHOLD = 0.7
_PAIRS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
_WEIGHT = {j: DECAY ** (j + 1) for j in range(2, SPAN)}
#: Length of the weight vector of a unit of so many characters.
_NORM = np.sqrt(np.array([2 * sum(max(n - j, 0) * _WEIGHT[j] ** 2 for _, j in _PAIRS) for n in range(LONGEST + 1)]))
_NORM[:3] = 1
_A, _B, _C = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
_FIRST = np.uint32(1 << 22)
_BREAK = 10
#: Kind of each code point: 1 letter or digit, 2 white space, 0 other.
_kinds: list[np.ndarray] = []


def _kind(codes: np.ndarray) -> np.ndarray:
    if not _kinds:
        _kinds.append(np.array([1 if c.isalnum() else 2 if c.isspace() else 0 for c in map(chr, range(0x110000))], np.int8))
    return _kinds[0][codes]


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes of the letters and digits of all texts in lower case, with a break
    behind each sentence and text, ``_FIRST`` added to the first of a word; offsets)."""
    lower = [t.lower() for t in texts]
    raw = np.frombuffer("\n".join([*lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.cumsum([0] + [len(t) + 1 for t in lower])
    kind = _kind(raw)
    stop = (raw == 46) | (raw == 33) | (raw == 63)
    stop[:-1] &= kind[1:] == 2
    kept = np.flatnonzero((kind == 1) | stop | (raw == _BREAK))
    codes = raw[kept].copy()
    sign = kind[kept] != 1
    codes[sign] = _BREAK
    spaces = np.cumsum(kind == 2)[kept]
    first = ~sign
    if len(kept):
        first[1:] &= (spaces[1:] != spaces[:-1]) | sign[:-1]
    # runs of single letters: all but the first of a run of three or more go on with the word
    at = np.flatnonzero(first)
    place = np.cumsum(~sign)
    word_end = np.concatenate([at[1:], [len(codes)]])
    size = place[word_end - 1] - place[at] + 1 if len(at) else at
    single = np.concatenate([[False], size == 1, [False]])
    edge = np.flatnonzero(single[1:] != single[:-1])
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        cut = np.concatenate([[0], np.flatnonzero(sign[at[a + 1:b] - 1]) + 1, [b - a]])  # a break ends a run too
        for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if y - x > 2:
                first[at[a + x + 1:a + y]] = False
    codes[first] += _FIRST
    return codes, np.searchsorted(kept, bounds)


def _ends(codes: np.ndarray) -> np.ndarray:
    """Of each place, where its sentence ends."""
    at = np.where(codes == _BREAK, np.arange(len(codes)), len(codes))
    return np.minimum.accumulate(at[::-1])[::-1]


def units(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, ends): of each piece (word, or part of a long one) where it starts, and
    where the units of 1, 2, ... pieces from there end (-1: no such unit)."""
    plain = codes != _BREAK
    first = plain & ((codes & _FIRST) > 0)
    first |= plain & np.concatenate([[True], ~plain[:-1]]) if len(codes) else plain
    start = np.flatnonzero(first)
    stop = np.minimum(np.concatenate([start[1:], [len(codes)]]), _ends(codes)[start]) if len(start) else start
    parts = np.where(stop - start > LONGEST, -(-(stop - start) // (LONGEST // 2)), 1)
    place = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    start, stop = np.repeat(start, parts) + place * (LONGEST // 2), np.repeat(stop, parts)
    stop = np.where(np.repeat(parts, parts) > 1, np.minimum(stop, start + LONGEST // 2), stop)
    limit = np.minimum(_ends(codes)[start], start + LONGEST) if len(start) else start
    ends = np.full((RUN, len(start)), -1, np.int64)
    for m in range(min(RUN, len(start))):
        end = stop[m:]
        k = len(end)
        ends[m, :k] = np.where(end <= limit[:k], end, -1)
    return start, ends


def _unit_slot(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Slot of whole units, for the first round."""
    power = np.cumprod(np.full(LONGEST, U64(0x9E3779B97F4A7C15)), dtype=U64)
    h = np.zeros(len(start), U64)
    wide = np.concatenate([codes.astype(U64), np.zeros(LONGEST, U64)])
    for i in range(LONGEST):
        h += np.where(start + i < end, (wide[start + i] + U64(1)) * power[i], U64(0))
    h = (h ^ (h >> U64(31))) * U64(0xBF58476D1CE4E5B9)
    return (h >> U64(46)).astype(np.int64)


@dataclass
class Model:
    """Weights per subsequence slot (``values``), or, in the first round, per unit."""

    values: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS))
    bias: float = -1.0
    doc: np.ndarray = field(default_factory=lambda: np.array([0.0, 0.0, -3.0]))
    whole: bool = False

    def _sums(self, codes: np.ndarray) -> dict[int, np.ndarray]:
        """Running sums of what the subsequences that begin at each place add, by their span less one."""
        n = len(codes)
        out = {j: np.zeros(n, np.float32) for j in range(2, SPAN)}
        values = self.values.astype(np.float32)
        for told in (codes, codes & (_FIRST - np.uint32(1))):
            wide = np.concatenate([told, np.zeros(SPAN, np.uint32)])
            one, two, three = wide * _A, wide * _B, wide * _C
            for j in range(2, SPAN):
                last = one[:n] + three[j:j + n]
                for i in range(1, j):
                    out[j] += values[(last + two[i:i + n]) >> np.uint32(14)]
        return {j: np.concatenate([[0.0], np.cumsum(x * np.float32(_WEIGHT[j]), dtype=np.float64)]) for j, x in out.items()}

    def margins(self, codes: np.ndarray, start: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The machine's output for each unit, in the shape of ``ends``; -inf where there is none."""
        out = np.full(ends.shape, -np.inf)
        for a in range(0, len(codes), STEP):  # bounded working memory, however long a text is
            lo, hi = np.searchsorted(start, [a, a + STEP])
            part = codes[a:a + STEP + LONGEST + SPAN]
            s = start[lo:hi] - a
            sums = None if self.whole else self._sums(part)
            for m in range(RUN):
                on = np.flatnonzero(ends[m, lo:hi] >= 0)
                p, e = s[on], ends[m, lo:hi][on] - a
                if self.whole:
                    out[m, lo + on] = self.values[_unit_slot(part, p, e)]
                else:
                    total = sum(x[np.maximum(e - j, p)] - x[p] for j, x in sums.items())
                    out[m, lo + on] = total / _NORM[e - p] + self.bias
        return out

    def features(self, texts: list[str]) -> np.ndarray:
        """(texts, 2): the best unit's margin, and log(1 + sentences past zero)."""
        codes, offsets = characters(texts)
        start, ends = units(codes)
        best = self.margins(codes, start, ends).max(axis=0) if len(start) else np.zeros(0)
        doc = np.searchsorted(offsets, start, "right") - 1
        out = np.zeros((len(texts), 2))
        out[:, 0] = self.bias - 1
        np.maximum.at(out[:, 0], doc, best)
        past = best > 0
        sentence = np.cumsum(codes == _BREAK)[start[past]]
        where = np.unique(np.array([doc[past], sentence]), axis=1)[0] if past.any() else np.zeros(0, np.int64)
        out[:, 1] = np.log1p(np.bincount(where, minlength=len(texts)))
        return np.clip(out, -3, 3)

    def score(self, texts: list[str]) -> np.ndarray:
        x = self.features(texts)
        return 1 / (1 + np.exp(-np.clip(x @ self.doc[:2] + self.doc[2], -30, 30)))


def written_unit(codes: np.ndarray) -> str:
    """A unit's characters, with ^ before the first of a word."""
    return "".join(("^" if c & _FIRST else "") + chr(int(c & (_FIRST - np.uint32(1)))) for c in codes)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, slot, weight) of every subsequence of units as :func:`written_unit` gives them."""
    raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    mark = raw == 94
    size = np.array([len(u) - u.count("^") for u in words], np.int64)
    codes = raw[~mark].copy()
    codes[np.concatenate([[False], mark])[:-1][~mark]] += _FIRST
    owner = np.repeat(np.arange(len(words)), size)
    at, end = np.arange(len(codes)), np.cumsum(size)[owner] if len(words) else size
    norm = _NORM[size][owner]
    who, slot, weight = [], [], []
    for told in (codes, codes & (_FIRST - np.uint32(1))):
        for i, j in _PAIRS:
            p = np.flatnonzero(at + j < end)
            who.append(owner[p])
            slot.append(((told[p] * _A + told[p + i] * _B + told[p + j] * _C) >> np.uint32(14)).astype(np.int64))
            weight.append(_WEIGHT[j] / norm[p])
    return np.concatenate(who), np.concatenate(slot), np.concatenate(weight)


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """K(u, v): sum over shared subsequences of the products of their weights."""
    rw, rs, rv = subsequences(right)
    order = np.argsort(rs, kind="stable")
    rw, rs, rv = rw[order], rs[order], rv[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, len(left), 256):
        part = left[a:a + 256]
        w, s, v = subsequences(part)
        first, n = np.searchsorted(rs, s, "left"), np.searchsorted(rs, s, "right")
        n = n - first
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        cell = np.repeat(w, n) * len(right) + rw[at]
        out[a:a + len(part)] = np.bincount(cell, np.repeat(v, n) * rv[at], len(part) * len(right)).reshape(len(part), len(right))
    return out


def mapped(words: list[str], marks: list[str], root: np.ndarray) -> np.ndarray:
    """``kernel(words, marks) @ root`` by blocks of words: of the kernel itself one block is held."""
    out = np.empty((len(words), root.shape[1]), np.float32)
    for a in range(0, len(words), 4096):
        out[a:a + 4096] = kernel(words[a:a + 4096], marks) @ root
    return out


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0) -> np.ndarray:
    """Weights (the last one the bias) of a linear machine with squared hinge
    loss, by Newton steps on the primal; rows are summed in blocks."""
    dims = x.shape[1] + 1
    w, ridge = np.zeros(dims), np.eye(dims)
    ridge[-1, -1] = 1e-3
    for _ in range(50):
        curve, slope = ridge.copy(), ridge @ w
        for a in range(0, len(x), 4096):
            part, own = x[a:a + 4096], y[a:a + 4096]
            margin = 1 - own * (part @ w[:-1] + w[-1])
            on = margin > 0
            rows = np.hstack([part[on], np.ones((int(on.sum()), 1))])
            heavy = rows * weight[a:a + 4096][on, None]
            curve += 2 * c * heavy.T @ rows
            slope -= 2 * c * heavy.T @ (own[on] * margin[on])
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit_units(positive: list[str], negative: list[str], landmarks: int = LANDMARKS) -> Model:
    """The machine over units labelled 1 and 0; the same for any order of them."""
    positive, negative = sorted(positive), sorted(negative)
    rng = np.random.default_rng(7)
    marks = []
    for words in (positive, negative):
        kinds = sorted(set(words))
        marks += [kinds[i] for i in rng.permutation(len(kinds))[:landmarks // 2]]
    value, vector = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    keep = value > 1e-6 * value.max()
    root = (vector[:, keep] / np.sqrt(value[keep])).astype(np.float32)
    words = positive + negative
    y = np.where(np.arange(len(words)) < len(positive), 1.0, -1.0)
    weight = np.where(y > 0, 0.5 / len(positive), 0.5 / len(negative)) * len(words)
    w = svm(mapped(words, marks, root), y, weight)
    alpha = root @ w[:-1]
    who, slot, value = subsequences(marks)
    return Model(np.bincount(slot, value * alpha[who], SLOTS), float(w[-1]))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, bad, good): documents of the task that hold a unit of the slot."""
    count = np.zeros((2, SLOTS), np.int64)
    for batch in by_bytes(batches, "text", 1 << 20):
        codes, offsets = characters([t or "" for t in batch.column("text").to_pylist()])
        start, ends = units(codes)
        doc = np.searchsorted(offsets, start, "right") - 1
        seen = np.unique(np.concatenate([doc[e >= 0] * SLOTS + _unit_slot(codes, start[e >= 0], e[e >= 0]) for e in ends]))
        toxic = batch.column("toxic").to_numpy()[seen // SLOTS]
        for y in (0, 1):
            count[y] += np.bincount(seen[toxic == y] % SLOTS, minlength=SLOTS)
    at = np.flatnonzero(count.sum(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[1][at]), pa.array(count[0][at])], names=["slot", "bad", "good"])


def first_scores(slot: np.ndarray, bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> Model:
    """Log of how much more common a unit is in toxic documents, drawn to 0 where few hold it."""
    values = np.zeros(SLOTS)
    lift = np.log((bad + 0.5) / (n_bad + 1)) - np.log((good + 0.5) / (n_good + 1))
    values[slot] = lift * bad / (bad + 5.0)
    return Model(values, 0.0, whole=True)


def chosen(model: Model, texts: list[str], toxic: list[int], keys: list[int]) -> list[tuple[str, int]]:
    """(unit, label) of the units that the documents give: the best one of each, of
    a clean one also one drawn by its key."""
    codes, offsets = characters(texts)
    start, ends = units(codes)
    margin = model.margins(codes, start, ends)
    out = []
    bounds = np.searchsorted(start, offsets)
    for a, b, y, key in zip(bounds[:-1].tolist(), bounds[1:].tolist(), toxic, keys):
        if a == b:
            continue
        own = margin[:, a:b].T.ravel()  # by place, then length
        picks = [int(own.argmax())]
        if not y:
            picks.append(key % (b - a) * RUN)
        for k in picks:
            if np.isfinite(own[k]):
                p = a + k // RUN
                out.append((written_unit(codes[start[p]:ends[k % RUN, p]]), y))
    return out


def _choose(model: Model):
    def run(batches):
        for batch in by_bytes(batches, "text", 1 << 20):
            found = chosen(model, [t or "" for t in batch.column("text").to_pylist()], batch.column("toxic").to_pylist(),
                           batch.column("key").to_pylist())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.int32()))], names=["unit", "toxic"])
    return run


def fit(labelled: DataFrame) -> Model:
    """Train on (text, label 0/1) rows, a bounded sample (``training_rows``): of
    each document at most two units a round come to the driver.

    With one class only, or no letter in all of a class, the model gives one score.
    """
    rows = labelled.select("text", F.col("label").alias("toxic"), F.pmod(F.xxhash64("text"), F.lit(1 << 40)).alias("key"))
    counts = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = counts.get(1, 0), counts.get(0, 0)
    if not bad or not good:
        return Model(doc=np.array([0.0, 0.0, 4.0 if bad else -4.0]))
    seen = (rows.select("text", "toxic").mapInArrow(_counted, "slot long, bad long, good long")
            .groupBy("slot").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas())  # at most SLOTS rows
    model = first_scores(*(seen[c].to_numpy() for c in ("slot", "bad", "good")), bad, good)
    negative: Counter[str] = Counter()  # those of earlier rounds stay, as often as a round had them
    for _ in range(ROUNDS):
        found = rows.mapInArrow(_choose(model), "unit string, toxic int").collect()
        positive = [r.unit for r in found if r.toxic == 1]
        negative |= Counter(r.unit for r in found if r.toxic == 0)
        if not positive or not negative:
            return Model(doc=np.array([0.0, 0.0, float(np.log(bad / good))]))
        model = fit_units(positive, list(negative.elements()))

    def features(batches):
        for batch in by_bytes(batches, "text", 1 << 20):
            x = model.features([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x[:, 0]), pa.array(x[:, 1])],
                                             names=["toxic", "x", "n"])
    points = np.array([tuple(r) for r in rows.mapInArrow(features, "toxic int, x double, n double").collect()], float)
    model.doc = logistic(points[:, 1:], points[:, 0])
    return model


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", out_col: str = "score",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ``out_col``) for each row of ``docs``, in 0..1; null and empty texts are
    scored as texts without a letter.  ``keep`` names columns to pass through;
    one of the name ``out_col`` needs another ``out_col``."""
    names = [id_col, *keep]
    rows = docs.select(*names, F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names) + ", __score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "__text", 1 << 20):
            s = model.score([t or "" for t in batch.column(len(names)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(s)], names=[*names, "__score"])
    return rows.mapInArrow(run, schema).withColumnRenamed("__score", out_col)


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", parts: int = 3, part: int = 1, sample: int = SAMPLE_DOCS,
                    out_col: str = "score", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ``keep``, ``out_col``) for each row of ``docs``, learnt as in :func:`toxicity`."""
    model = fit(training_rows(docs, labels, label_col, id_col=id_col, text_col=text_col, parts=parts, part=part,
                              sample=sample))
    return score(docs, model, id_col=id_col, text_col=text_col, out_col=out_col, keep=keep)


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", parts: int = 3, part: int = 1, threshold: float = THRESHOLD,
             sample: int = SAMPLE_DOCS) -> DataFrame:
    """(id, held_out, score, predicted) for each row of ``docs``.

    Learns from the labelled rows whose crc32(id) mod ``parts`` is not
    ``part``.  A null id is not held out and has no label; null and empty texts
    get a score; rows that repeat an id are scored each, by their own text;
    very long texts are scored whole, in steps; other columns are not read.
    """
    scored = toxicity_scores(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, parts=parts, part=part,
                             sample=sample, out_col="__score")
    return scored.select(
        id_col, held_out(id_col, parts, part).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= threshold).cast("int").alias("predicted"))
