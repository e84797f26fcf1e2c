"""Quality classifier: random-indexing word vectors pooled per document, then a
two-layer network with temperature-calibrated probabilities.

Tokens are runs of letters, of digits or of one kind of mark, case kept.  Each
token has a fixed random index vector, drawn by the hash of its bytes, plus one
of its shape.  Pass 1, over all documents: a token's context vector is the sum
of its neighbours' index vectors (two on each side), kept for ``BUCKETS`` hash
buckets of tokens, so the table has a fixed size whatever the vocabulary; each
task adds up its own table, Spark sums them.  Pass 2: a document is the mean,
the spread and the length of the mean of its tokens' vectors.  The network is
trained with numpy on a bounded sample of labelled documents, a part of which
sets the temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import U64, by_bytes, mix64, runs, text_bytes
from trendspark.llm.labelled import held_out, training_rows

DIMS, BUCKETS, SIDE = 32, 1 << 13, 2
SAMPLE_DOCS, HIDDEN, EPOCHS = 20_000, 32, 60
THRESHOLD = 0.7
_SHAPES = 8
_SIGN = np.array([0.0, 1.0, -1.0, 0.0], np.float32)


def _draw(keys: np.ndarray) -> np.ndarray:
    """(keys, DIMS) sparse ternary index vectors, half of the places not 0."""
    bits = mix64(keys)
    two = (bits[:, None] >> (U64(2) * np.arange(DIMS, dtype=U64))[None, :]) & U64(3)
    return _SIGN[two.astype(np.int8)]


#: Index vectors by bucket and by shape: equal on every machine.
_BY_BUCKET = _draw(np.arange(BUCKETS, dtype=U64))
_BY_SHAPE = _draw(np.arange(_SHAPES, dtype=U64) + U64(1 << 40)) * 2


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, shape, offsets) of the tokens of each text."""
    h, shape, offsets = runs(texts)
    return (h >> U64(51)).astype(np.int64), shape, offsets


def _index(bucket: np.ndarray, shape: np.ndarray) -> np.ndarray:
    return _BY_BUCKET[bucket] + _BY_SHAPE[shape]


def context_sums(texts: list[bytes], table: np.ndarray) -> None:
    """Add the contexts of all tokens to ``table`` (BUCKETS, DIMS)."""
    bucket, shape, offsets = tokens(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    own = _index(bucket, shape)
    around = np.zeros_like(own)
    for d in range(1, SIDE + 1):
        if len(owner) > d:
            same = (owner[d:] == owner[:-d])[:, None]
            around[d:] += own[:-d] * same
            around[:-d] += own[d:] * same
    for c in range(DIMS):
        table[:, c] += np.bincount(bucket, around[:, c], BUCKETS)


def context_table(docs: DataFrame) -> np.ndarray:
    """(BUCKETS, DIMS): unit context vectors over all rows of ``docs`` (text).

    Its size is fixed, so it may come to the driver and be sent to tasks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((BUCKETS, DIMS))
        for batch in by_bytes(batches, "text", 2 << 20):
            context_sums(text_bytes(batch.column(0)), table)
        used = np.flatnonzero(np.abs(table).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(table[used, c].astype(np.int64)) for c in range(DIMS))],
                                         names=["bucket", *(f"c{c}" for c in range(DIMS))])
    schema = "bucket int, " + ", ".join(f"c{c} long" for c in range(DIMS))
    sums = docs.select("text").where("text is not null").mapInArrow(run, schema).groupBy("bucket").agg(
        *(F.sum(f"c{c}").alias(f"c{c}") for c in range(DIMS)))
    table = np.zeros((BUCKETS, DIMS))
    for r in sums.toLocalIterator():
        table[r[0]] = r[1:]
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """(texts, features): pooled word vectors; a text without tokens has zeros."""
    bucket, shape, offsets = tokens(texts)
    n = np.maximum(np.diff(offsets), 1)[:, None].astype(np.float64)
    out = []
    for rows in (table, _BY_BUCKET, _BY_SHAPE):
        key, size = (shape, _SHAPES) if rows is _BY_SHAPE else (bucket, BUCKETS)
        some = np.zeros((len(texts), rows.shape[1]))
        square = np.zeros_like(some)
        for a in range(0, len(texts), 256):  # bounded working memory
            b = min(len(texts), a + 256)
            at = slice(offsets[a], offsets[b])
            owner = np.repeat(np.arange(b - a), np.diff(offsets[a:b + 1]))
            pair, count = np.unique(owner * size + key[at], return_counts=True)
            doc, k = pair // size, pair % size
            for c in range(rows.shape[1]):
                some[a:b, c] = np.bincount(doc, rows[k, c] * count, b - a)
                square[a:b, c] = np.bincount(doc, rows[k, c] ** 2 * count, b - a)
        mean = some / n
        spread = np.sqrt(np.maximum(square / n - mean ** 2, 0))
        out += [mean, np.linalg.norm(mean, axis=1, keepdims=True), spread.mean(axis=1, keepdims=True)]
        if rows is table:
            out.append(spread)
    return np.hstack(out)


@dataclass
class Network:
    """tanh hidden layer, one output, divided by the temperature."""
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, *, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 11) -> Network:
    """Fit by Adam on four fifths of the rows; the rest chooses the epoch and
    then the temperature, by least log loss."""
    rng = np.random.default_rng(seed)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    net = Network(centre, scale, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden),
                  rng.normal(0, hidden ** -0.5, hidden), 0.0)
    order = rng.permutation(len(x))
    cut = max(1, len(x) // 5)
    check, fit = order[:cut], order[cut:] if len(x) > cut else order
    z = np.clip((x - centre) / scale, -8, 8)
    names = ("w1", "b1", "w2", "b2")
    m, v, step, best, kept = dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0), 0, np.inf, None

    def loss(t: float) -> float:
        p = np.clip(1 / (1 + np.exp(-np.clip(net.logits(x[check]) / t, -30, 30))), 1e-7, 1 - 1e-7)
        return float(-(y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p)).mean())

    for _ in range(epochs):
        for a in range(0, len(fit), 128):
            i = rng.permutation(fit)[:128] if len(fit) <= 128 else fit[a:a + 128]
            h = np.tanh(z[i] @ net.w1 + net.b1)
            d = (1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -30, 30))) - y[i]) / len(i)
            back = np.outer(d, net.w2) * (1 - h ** 2)
            grad = {"w1": z[i].T @ back + 1e-4 * net.w1, "b1": back.sum(axis=0), "w2": h.T @ d + 1e-4 * net.w2, "b2": d.sum()}
            step += 1
            for n, g in grad.items():
                m[n], v[n] = 0.9 * m[n] + 0.1 * g, 0.999 * v[n] + 0.001 * g ** 2
                setattr(net, n, getattr(net, n) - 0.003 * (m[n] / (1 - 0.9 ** step)) / (np.sqrt(v[n] / (1 - 0.999 ** step)) + 1e-8))
        fit = rng.permutation(fit)
        if (now := loss(1.0)) < best:
            best, kept = now, {n: np.copy(getattr(net, n)) for n in names}
    for n, value in (kept or {}).items():
        setattr(net, n, value)
    net.temperature = float(min(np.geomspace(0.5, 5, 60), key=loss))
    return net


def quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", parts: int = 4, part: int = 2, threshold: float = THRESHOLD,
            sample: int = SAMPLE_DOCS) -> DataFrame:
    """(id, held_out, score, predicted) for each row of ``docs``.

    Learns from labelled rows whose crc32(id) mod ``parts`` is not ``part``.
    Null and empty texts get the score of a text without tokens.  With one
    class only that class's constant is the score, without labels 0.5.
    """
    table = context_table(docs.select(F.col(text_col).cast("string").alias("text")))
    rows = training_rows(docs, labels, label_col, id_col=id_col, text_col=text_col, parts=parts, part=part, sample=sample)

    def features(batches):
        for batch in by_bytes(batches, "text", 2 << 20):
            x = pooled(text_bytes(batch.column(0)), table)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))],
                                             names=["label", "x"])
    found = rows.mapInArrow(features, "label int, x array<float>").toArrow()
    y = found.column(0).to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        constant = 0.5 if not len(y) else 0.02 if y[0] == 0 else 0.98
        net = None
    else:
        flat = found.column(1).combine_chunks()
        net = train(flat.flatten().to_numpy().astype(np.float64).reshape(len(y), -1), y)

    names = [id_col]
    source = docs.select(id_col, F.col(text_col).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "__text", 2 << 20):
            s = net.score(pooled(text_bytes(batch.column(1)), table)) if net else np.full(batch.num_rows, constant)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=[*names, "score"])
    scored = source.mapInArrow(run, f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, score double")
    return scored.select(id_col, held_out(id_col, parts, part).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
