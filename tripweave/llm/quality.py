"""Quality by random-indexing word vectors, pooled per document, and a two-layer network.

A token is a run of word characters or a run of signs, in its own case.  Each token falls
into one of a fixed number of buckets and has a sparse random index vector.  The vector of
a bucket is the sum of the index vectors of all tokens near it, over the whole corpus; so
forms that no labelled row has (shouted words, decorated words, table cells) get their
vectors from the company they keep.  A document is the mean and the spread of its vectors.
The network is trained in numpy on a bounded sample and its temperature is set on rows that
it did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.columns import pick, ragged, slices, text_buffers
from tripweave.llm.labelled import remainder, training_rows
from tripweave.llm.words import IN_WORD, hash_spans, runs

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

# The table of vectors has this fixed size, whatever the corpus, so it can be summed, held and broadcast.
BUCKETS = 1 << 15
WIDTH = 32
# Entries of an index vector that are not zero, and tokens on each side that count as near.
NONZERO = 2
NEAR = 2
BLOCK = 256

# At most so many labelled rows are used for fitting; the last tenths of them set the temperature.
TRAINING_ROWS = 16_000
NETWORK_PARTS = 8
HIDDEN = 48

_CLASS = np.where(IN_WORD, 1, np.where(np.arange(256) > 32, 2, 0)).astype(np.uint8)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, offsets of the texts in them) of all tokens in order."""
    kinds = _CLASS[data]
    spans = [runs(kinds == k, offsets) for k in (1, 2)]
    starts = np.concatenate([s for s, _ in spans])
    hashes = np.concatenate([hash_spans(data, s, e) for s, e in spans])
    order = np.argsort(starts, kind="stable")
    return (hashes[order] & np.uint64(BUCKETS - 1)).astype(np.int64), np.searchsorted(starts[order], offsets)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the entries of each bucket's index vector."""
    draw = np.random.default_rng(7)
    return draw.integers(0, WIDTH, (BUCKETS, NONZERO)), draw.choice([-1, 1], (BUCKETS, NONZERO)).astype(np.int32)


def add_contexts(total: np.ndarray, bucket: np.ndarray, offsets: np.ndarray) -> None:
    """Add to ``total`` (flat, BUCKETS x WIDTH) the index vectors of each token's neighbours in its text."""
    places, signs = index_vectors()
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for away in range(1, min(NEAR, len(bucket) - 1) + 1):
        same = np.flatnonzero(text_of[away:] == text_of[:-away])
        left, right = bucket[same], bucket[same + away]
        for j in range(NONZERO):
            np.add.at(total, left * WIDTH + places[right, j], signs[right, j])
            np.add.at(total, right * WIDTH + places[left, j], signs[left, j])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The vectors of all buckets, centred and of unit length, float32.

    Each task sums its texts into one table and gives it away in blocks; blocks are summed where
    they meet.  What a task holds and what reaches the driver is the table, of fixed size.
    """
    spec = "block int, sums binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS * WIDTH, np.int32)
        for batch in slices(batches):
            add_contexts(total, *tokens(*text_buffers(batch.column("text"))))
        blocks = total.reshape(-1, BLOCK * WIDTH)
        some = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([blocks[b].astype("<i8").tobytes() for b in some.tolist()], pa.binary())], names=["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, sums in zip(batch.column("block").to_pylist(), batch.column("sums"), strict=True):
                held[block] = held.get(block, 0) + np.frombuffer(sums.as_buffer(), "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["block", "sums"])

    sums = pick(docs, "text").mapInArrow(count, spec).repartition("block").mapInArrow(add, spec)
    table = np.zeros((BUCKETS // BLOCK, BLOCK * WIDTH))
    for row in sums.collect():
        table[row.block] = np.frombuffer(row.sums, "<i8")
    table = table.reshape(BUCKETS, WIDTH)

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    table = unit(table)
    known = table.any(1)
    if known.any():
        table[known] = unit(table[known] - table[known].mean(0))
    return table.astype(np.float32)


def pooled(vectors: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors of each text, and the logarithm of its tokens; an empty text is zeros."""
    bucket, at = tokens(data, offsets)
    n = np.diff(at)
    out = np.zeros((len(n), 2 * WIDTH + 1))
    full = np.flatnonzero(n)
    if len(full):
        each = vectors[bucket]
        mean = np.add.reduceat(each, at[full], axis=0, dtype=np.float64) / n[full, None]
        square = np.add.reduceat(each * each, at[full], axis=0, dtype=np.float64) / n[full, None]
        out[full] = np.concatenate([mean, np.sqrt(np.maximum(square - mean**2, 0)), np.log1p(n[full, None])], 1)
    return out


class Network(NamedTuple):
    """tanh layer and logistic output on standardised features."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1)
        return (hidden @ self.w2 + self.b2)[:, 0]


def train(x: np.ndarray, y: np.ndarray, steps: int = 3000, batch: int = 256, decay: float = 3e-4) -> Network:
    """Adam on the log loss in a fixed order of rows.  Without rows of both labels it gives a constant."""
    draw = np.random.default_rng(11)
    width = x.shape[1]
    centre, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(width), np.ones(width))
    share = float(np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98))
    net = Network(centre, scale, draw.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), np.zeros((HIDDEN, 1)), np.array([np.log(share / (1 - share))]))
    if not len(y) or y.min() == y.max():
        return net
    z = (x - centre) / scale
    params = [net.w1, net.b1, net.w2, net.b2]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        rows = draw.integers(0, len(z), min(batch, len(z)))
        hidden = np.tanh(z[rows] @ net.w1 + net.b1)
        p = 1 / (1 + np.exp(-(hidden @ net.w2 + net.b2)))
        out = (p - y[rows, None]) / len(rows)
        back = (out @ net.w2.T) * (1 - hidden**2)
        grads = [z[rows].T @ back + decay * net.w1, back.sum(0), hidden.T @ out + decay * net.w2, out.sum(0)]
        rate = 3e-3 * (1 - step / (steps + 1))
        for q, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss; 1 without rows."""
    if not len(y):
        return 1.0
    choices = np.exp(np.linspace(np.log(0.3), np.log(8), 120))
    signed = np.where(y > 0, logits, -logits)
    return float(choices[np.argmin([np.logaddexp(0, -signed / t).mean() for t in choices])])


class Model(NamedTuple):
    vectors: np.ndarray
    network: Network
    heat: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        logits = self.network.logits(pooled(self.vectors, data, offsets)) / self.heat
        return 1 / (1 + np.exp(-np.clip(logits, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Model:
    """Word vectors of all texts; network and temperature from a bounded sample of labelled rows."""
    vectors = word_vectors(docs)
    known = docs.sparkSession.sparkContext.broadcast(vectors)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = pooled(known.value, *text_buffers(batch.column("text")))
            at = np.arange(len(x) + 1) * x.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("part"), ragged(x.ravel(), at)], names=["label", "part", "x"])

    rows = training_rows(docs, labels, "quality", FOLDS, HELD_OUT, most)
    got = rows.mapInArrow(compute, "label int, part int, x array<double>").toPandas()
    # In one order whatever the order of tasks, so that the model is the same in every run.
    got = got.assign(key=[tuple(x) for x in got["x"]]).sort_values(["part", "label", "key"], kind="stable")
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, 2 * WIDTH + 1))
    y, part = got["label"].to_numpy(np.float64), got["part"].to_numpy()
    network = train(x[part < NETWORK_PARTS], y[part < NETWORK_PARTS])
    return Model(vectors, network, temperature(network.logits(x[part >= NETWORK_PARTS]), y[part >= NETWORK_PARTS]))


def score(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text; a null text scores as an empty one."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = known.value.scores(*text_buffers(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], names=[*batch.schema.names, into])

    return docs.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    A document with a null id is held out of nothing; repeated rows are scored each; rows without
    labels are scored like all others; empty texts get the score of a document of zeros.
    """
    scored = score(pick(docs, "doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
