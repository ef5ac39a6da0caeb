"""Toxicity by gradient-boosted trees over dense features of a text, with isotonic calibration.

The features are densities of a lexicon, how near its words are to the second person, and
rates of capitals, punctuation and obfuscation.  The lexicon has a fixed part and a part
learned from a bounded sample of labelled rows: words, and beginnings of words, that mark
toxic texts.  Beginnings carry over to inflected and invented forms that no sample has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.boosting import boost, isotonic
from tripweave.llm.columns import in_plain_names, pick, ragged, slices, text_buffers
from tripweave.llm.labelled import remainder, training_rows
from tripweave.llm.words import Words, words
from tripweave.session import cut_lineage

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3

# At most so many labelled rows are used for fitting, and so many entries of the learned lexicon.
TRAINING_ROWS = 16_000
LEXICON_ENTRIES = 6_000
# The sample is in ten parts.  Rows of one half get features by the lexicon of the other half, and
# margins for calibration come from trees that did not see the row.
HALF, CALIBRATION_FOLDS = 5, 5

PREFIX_BYTES = (4, 5, 6)
NEAR_WORDS = 4

INSULTS = (
    "idiot idiots stupid moron morons dumb fool loser losers trash garbage scum pathetic worthless disgusting clown"
    " jerk freak creep ugly hate kill die crap damn hell bastard bitch shit fuck asshole retard pig vermin filth"
)
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros"


def _hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return np.sort(words(data, np.array([0, len(data)])).hashes)


def _isin(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _tokens(data: np.ndarray, found: Words) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """kind -> (numbers of words, their keys); kind 0 is whole words, k the first k bytes."""
    length = found.ends - found.starts
    out = {0: (np.arange(len(length)), found.hashes)}
    lower = np.where((data >= 65) & (data <= 90), data + 32, data)
    for k in PREFIX_BYTES:
        which = np.flatnonzero(length >= k)
        key = np.zeros(len(which), np.uint64)
        for j in range(k):
            key |= lower[found.starts[which] + j].astype(np.uint64) << np.uint64(8 * j)
        out[k] = which, key
    return out


def _learn_lexicon(rows: DataFrame, entries: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """kind -> (sorted keys, log odds) of what marks toxic texts most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = text_buffers(batch.column("text"))
            label = batch.column("label").to_numpy()
            found = words(data, offsets)
            text_of = found.text_of()
            for kind, (which, keys) in _tokens(data, found).items():
                # Once for each text, whatever its length.
                pairs = np.unique(np.stack([text_of[which].astype(np.uint64), keys], 1), axis=0)
                toxic = label[pairs[:, 0].astype(np.int64)] != 0
                key, inverse = np.unique(pairs[:, 1], return_inverse=True)
                n = np.bincount(inverse, minlength=len(key))
                n_toxic = np.bincount(inverse, toxic, len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), kind), pa.int32()), pa.array(key.view(np.int64)), pa.array(n, pa.int64()), pa.array(n_toxic)],
                    names=["kind", "key", "n", "n_toxic"],
                )

    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    odds = (
        F.log((F.col("n_toxic") + 0.5) / (totals.toxic + 1)) - F.log((F.col("n") - F.col("n_toxic") + 0.5) / (totals.n - totals.toxic + 1))
    )
    best = (
        rows.mapInArrow(count, "kind int, key bigint, n bigint, n_toxic bigint")
        .groupBy("kind", "key")
        .agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
        .select("kind", "key", "n_toxic", odds.alias("odds"))
        .where((F.col("n_toxic") >= 3) & (F.col("odds") > 1.5))
        .orderBy(F.col("odds").desc(), "kind", "key")
        .limit(entries)
        .toPandas()
    )
    out = {}
    for kind in (0, *PREFIX_BYTES):
        mine = best[best["kind"] == kind]
        keys = mine["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        out[kind] = keys[order], mine["odds"].to_numpy(np.float64)[order]
    return out


class Features:
    """Dense features of texts."""

    def __init__(self, lexicon: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.lexicon = lexicon
        self.insults, self.second = _hashes(INSULTS), _hashes(SECOND_PERSON)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        found = words(data, offsets)
        n_texts, n_words = len(offsets) - 1, np.diff(found.offsets)
        text_of = found.text_of()
        per_word, per_byte = 1 / np.maximum(n_words, 1), 1 / np.maximum(np.diff(offsets), 1)
        columns = [np.log1p(n_words)]

        marked = _isin(found.hashes, self.insults)
        columns += [np.bincount(text_of, marked, n_texts), np.bincount(text_of, marked, n_texts) * per_word]
        for kind, (which, keys) in _tokens(data, found).items():
            known, odds = self.lexicon[kind]
            hit = np.flatnonzero(_isin(keys, known))
            weight = odds[np.searchsorted(known, keys[hit])] if len(known) else np.zeros(0)
            text = text_of[which[hit]]
            most = np.zeros(n_texts)
            np.maximum.at(most, text, weight)
            total = np.bincount(text, weight, n_texts)
            columns += [most, np.bincount(text, minlength=n_texts), total, total * per_word]
            marked[which[hit[weight > 3]]] = True

        # Marked words with a second person within a few words of the same text.
        second = _isin(found.hashes, self.second)
        reach = np.convolve(second, np.ones(2 * NEAR_WORDS + 1), "same") > 0 if len(second) > 2 * NEAR_WORDS else np.full(len(second), second.any())
        columns += [np.bincount(text_of, second, n_texts) * per_word, np.bincount(text_of, marked & reach, n_texts) * per_word]

        # Counts over bytes as differences of running sums.
        def rate(where: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(where)])
            return (total[offsets[1:]] - total[offsets[:-1]]) * per_byte

        upper, digit = (data >= 65) & (data <= 90), (data >= 48) & (data <= 57)
        letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
        sign = ~letter & ~digit & (data > 32)
        inside = np.zeros(len(data), bool)
        inside[1:-1] = (digit | sign)[1:-1] & letter[:-2] & letter[2:]
        repeated = np.zeros(len(data), bool)
        repeated[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & (letter | sign)[2:]
        columns += [rate(upper), rate(data == 33), rate(data == 63), rate(sign), rate(inside), rate(repeated), rate(digit)]
        return np.stack(columns, 1).astype(np.float64)


class Model:
    def __init__(self, features: Features, trees, calibration):
        self.features, self.trees, self.calibration = features, trees, calibration

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.calibration(self.trees.margin(self.features(data, offsets)))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Model:
    """A model from a bounded sample of labelled documents.  Without labels every score is one half."""
    # Stored once: at most ``most`` texts.
    rows = cut_lineage(training_rows(docs, labels, "toxic", FOLDS, HELD_OUT, most))
    first, second = F.col("part") < HALF, F.col("part") >= HALF
    halves = [(first, _learn_lexicon(rows.where(second), LEXICON_ENTRIES)), (second, _learn_lexicon(rows.where(first), LEXICON_ENTRIES))]
    context, computed = docs.sparkSession.sparkContext, []
    for half, lexicon in halves:
        known = context.broadcast(Features(lexicon))

        def compute(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                x = known.value(*text_buffers(batch.column("text")))
                at = np.arange(len(x) + 1) * x.shape[1]
                yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("part"), ragged(x.ravel(), at)], names=["label", "part", "x"])

        computed.append(rows.where(half).mapInArrow(compute, "label int, part int, x array<double>"))
    got = computed[0].unionByName(computed[1]).toPandas()
    # In one order whatever the order of tasks, so that the model is the same in every run.
    got = got.assign(key=[tuple(x) for x in got["x"]]).sort_values(["part", "label", "key"], kind="stable")
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, 1))
    y, fold = got["label"].to_numpy(np.float64), got["part"].to_numpy() % CALIBRATION_FOLDS
    margin = np.zeros(len(y))
    for k in range(CALIBRATION_FOLDS):
        margin[fold == k] = boost(x[fold != k], y[fold != k]).margin(x[fold == k])
    return Model(Features(_learn_lexicon(rows, LEXICON_ENTRIES)), boost(x, y), isotonic(margin, y))


def score(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text; a null text scores as an empty one."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = known.value.scores(*text_buffers(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], names=[*batch.schema.names, into])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    A document with a null id is held out of nothing; repeated rows are scored each; rows without
    labels are scored like all others.  Texts without words get the score of their features.
    """
    scored = score(pick(docs, "doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def remove_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the model rejects."""
    model = fit(docs, labels)
    return in_plain_names(docs, ("text",), lambda d: score(d, model).where(F.col("score") < THRESHOLD))
