"""Trees, calibration, features and held-out accuracy."""

import zlib

import numpy as np
import pytest

from tripweave.llm import toxicity
from tripweave.llm.boosting import boost, isotonic
from tripweave.llm.columns import text_buffers

DATA = "/root/testdata/sf0.01"


def auc(y, score):
    order = np.argsort(np.argsort(score, kind="stable")) + 1
    n1 = y.sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_trees_learn_an_interaction():
    draw = np.random.default_rng(0)
    x = draw.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = boost(x[:3000], y[:3000])
    assert ((model.margin(x[3000:]) > 0) == y[3000:]).mean() > 0.97
    assert len(boost(x, np.ones(4000)).trees) == 0 and len(boost(x[:0], y[:0]).trees) == 0


def test_isotonic_is_monotone_and_calibrated():
    draw = np.random.default_rng(1)
    margin = draw.normal(size=5000)
    y = (draw.random(5000) < 1 / (1 + np.exp(-3 * margin))).astype(float)
    p = isotonic(margin, y)(np.linspace(-3, 3, 200))
    assert (np.diff(p) >= 0).all() and abs(p[100] - 0.5) < 0.1 and p[0] < 0.05 and p[-1] > 0.95
    assert 0 < isotonic(margin[:0], y[:0])(np.zeros(1))[0] < 1


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    got = toxicity.toxicity(docs, labels).toPandas()
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    assert [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]] == got["held_out"].tolist()
    assert ((got["score"] >= 0.3).astype(int) == got["predicted"]).all()
    held = got[got["held_out"]].merge(labels.toPandas(), on="doc_id")
    y = held["toxic"].to_numpy()
    assert auc(y, held["score"].to_numpy()) > 0.75 and (held["predicted"] == y).mean() > 0.9


def test_held_out_labels_are_not_used(spark, tables):
    docs, labels = tables
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.remainder(4) == 2, 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    scores = [sorted((r.doc_id, r.score) for r in toxicity.toxicity(docs, x).collect()) for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, None), (1, None), (2, ""), (3, "you idiot " * 5000)], "doc_id bigint, text string")
    docs = docs.selectExpr("doc_id", "text", "1 as label", "'x' as Score")
    labels = spark.createDataFrame([(1, None, 0), (3, 1, 1), (None, 1, 1)], "doc_id bigint, toxic int, quality int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_features_do_not_mix_texts():
    import pyarrow as pa

    features = toxicity.Features({k: (np.zeros(0, np.uint64), np.zeros(0)) for k in (0, *toxicity.PREFIX_BYTES)})
    texts = ["You IDIOT!!! wh4t", "", "clean words here", "you are trash"]
    together = features(*text_buffers(pa.array(texts)))
    alone = np.concatenate([features(*text_buffers(pa.array([t]))) for t in texts])
    assert np.allclose(together, alone)
