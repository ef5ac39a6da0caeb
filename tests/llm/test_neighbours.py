"""Recall and scores against brute force."""

import numpy as np
import pytest

from tripweave.llm import neighbours as nn
from tripweave.llm.neighbours import F


def brute(rows):
    """query -> [(vec_id, score)] in order, over all valid rows."""
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault((i, tuple(v)))
    ids = np.array([i for i, _ in ok])
    x = np.array([v for _, v in ok], float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for k in np.flatnonzero(ids % nn.QUERY_EVERY == 0):
        score = unit @ unit[k]
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if j != k][: nn.NEAREST]
        out[int(ids[k])] = [(int(ids[j]), score[j]) for j in order]
    return out


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("vec_id", "embedding", "1 as list", "'a' as Class", *more)
    got = {}
    for r in nn.search(df, F.col("vec_id") % nn.QUERY_EVERY == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    expected, got = brute(rows), run(spark, rows)
    assert set(got) == set(expected)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits / sum(map(len, expected.values())) >= 0.9
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, found in got.items():
        assert len(found) == 5 and q not in [i for i, _ in found]
        for i, s in found:
            a, b = vectors[q], vectors[i]
            assert abs(s - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))) < 1e-12


def test_scan_gives_up_few_true_neighbours():
    draw = np.random.default_rng(0)
    x = nn.units(draw.normal(size=(3000, 64)))
    near = np.sort(2 - 2 * x[:20] @ x[:1000].T, 1)
    q, r = nn.scan(x[:20], x, near[:, 6], 6)
    assert len(q) < 0.1 * 20 * 3000
    true = np.argsort(-(x[:20] @ x.T), 1)[:, :6]
    found = set(zip(q.tolist(), r.tolist(), strict=True))
    assert np.mean([(i, j) in found for i in range(20) for j in true[i].tolist()]) > 0.97


def test_copies_ties_and_bad_rows(spark):
    draw = np.random.default_rng(1)
    hot = [1.0, 0.0, 0.0]
    rows = [(i, hot) for i in range(0, 400)] + [(400 + i, draw.normal(size=3).tolist()) for i in range(300)]
    rows += [(1000, None), (1050, [0.0, 0.0, 0.0]), (1100, [1.0, None, 2.0]), (1150, [float("nan"), 1.0, 1.0]), (1200, [float("inf"), 1.0, 1.0])]
    rows += [(1250, [1.0, 2.0]), (None, hot), (1300, []), (50, hot), (1350, [1e30, 0.0, 0.0]), (1400, [-0.0, 1e-30, 0.0])]
    got = run(spark, rows)
    assert not {1000, 1050, 1100, 1150, 1200, 1250, 1300} & set(got)
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[50]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in got[1350]] == [0, 1, 2, 3, 4] and all(s == 1.0 for _, s in got[1350])
    assert len(got[1400]) == 5 and got[1400][0][1] <= 1


def test_few_and_no_rows(spark):
    assert run(spark, [(0, [1.0, 0.0]), (3, [0.0, 1.0]), (2, [1.0, 1.0])])[0] == [(2, pytest.approx(0.5**0.5)), (3, 0.0)]
    assert run(spark, [(0, [1.0])]) == {} and run(spark, []) == {} and run(spark, [(1, [1.0]), (2, [1.0])]) == {}
