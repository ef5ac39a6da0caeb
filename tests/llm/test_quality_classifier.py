"""Context vectors, network, calibration and held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from test_toxicity import DATA, auc

from tripweave.llm import quality
from tripweave.llm.columns import text_buffers


def test_contexts_by_brute_force():
    texts = ["a b! c", "", "b", "c a a b %% d"]
    data, offsets = text_buffers(pa.array(texts))
    bucket, at = quality.tokens(data, offsets)
    got = np.zeros(quality.BUCKETS * quality.WIDTH, np.int64)
    quality.add_contexts(got, bucket, at)
    places, signs = quality.index_vectors()
    expected = np.zeros((quality.BUCKETS, quality.WIDTH), np.int64)
    for s, e in zip(at[:-1], at[1:], strict=True):
        for i in range(s, e):
            for j in range(s, e):
                if i != j and abs(i - j) <= quality.NEAR:
                    for k in range(quality.NONZERO):
                        expected[bucket[i], places[bucket[j], k]] += signs[bucket[j], k]
    assert (got.reshape(expected.shape) == expected).all()


def test_vectors_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert np.array_equal(quality.word_vectors(docs.repartition(1)), quality.word_vectors(docs.repartition(7)))


def test_network_and_temperature():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(4000, 5))
    truth = 1 / (1 + np.exp(-3 * x[:, 0] * x[:, 1]))
    y = (draw.random(4000) < truth).astype(float)
    logits = quality.train(x[:2000], y[:2000]).logits(x)
    assert auc(y[2000:], logits[2000:]) > 0.75
    heat = quality.temperature(logits[2000:], y[2000:])
    loss = lambda t: np.logaddexp(0, -np.where(y > 0, logits, -logits)[2000:] / t).mean()
    assert loss(heat) <= loss(1.0) and quality.temperature(logits[:0], y[:0]) == 1


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    got = quality.quality(docs, labels).toPandas()
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    assert [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]] == got["held_out"].tolist()
    assert ((got["score"] >= 0.3).astype(int) == got["predicted"]).all()
    held = got[got["held_out"]].merge(labels.toPandas(), on="doc_id")
    y = held["quality"].to_numpy()
    assert auc(y, held["score"].to_numpy()) > 0.85 and (held["predicted"] == y).mean() > 0.9


def test_odd_rows(spark):
    rows = [(None, "a b"), (1, None), (1, None), (2, ""), (3, "long !! " * 20_000), (4, "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 as label", "'x' as SCORE")
    labels = spark.createDataFrame([(1, 0), (3, 1), (None, 1)], "doc_id bigint, quality int")
    got = quality.quality(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert quality.quality(docs.limit(0), labels.limit(0)).count() == 0
