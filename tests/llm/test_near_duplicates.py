"""Groups and links against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tripweave.llm import near_duplicates as nd
from tripweave.llm.columns import text_buffers
from tripweave.session import ARROW_ROWS, BATCH_ROWS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """doc_id -> (class, links), all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    by = {}
    for k, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(k)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(sets):
        common = {}
        for x in s:
            for j in by[x]:
                if j > k:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if c / (len(s) + len(sets[j]) - c) >= 0.8:
                links[k] += 1
                links[j] += 1
                parent[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: (least[find(k)], links[k]) for k, (i, _) in enumerate(rows)}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    got = {r.doc_id: (r.class_id, r.n_links) for r in nd.near_duplicates(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def edited(n, seed=0):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(500)}" for _ in range(120)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(draw.randrange(4)):
            w[draw.randrange(len(w))] = f"x{draw.randrange(10**6)}"
        out.append((i, " ".join(w)))
    return out


def test_a_node_in_blocks(spark, monkeypatch):
    rows = edited(300) + [(1000 + i, f"lone text number {i} " * 3) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = brute(rows)
    monkeypatch.setattr(nd, "BLOCK", 16)
    got = {r.doc_id: (r.class_id, r.n_links) for r in nd.near_duplicates(docs).collect()}
    # Links are found with a probability; none may be invented.
    assert all(got[i][1] <= expected[i][1] for i in expected) and [got[i][0] for i in expected] == [expected[i][0] for i in expected]
    assert sum(n for _, n in got.values()) >= 0.999 * sum(n for _, n in expected.values())


ODD = [(5, None), (6, ""), (7, "!?"), (8, "!?"), (9, "one two"), (10, "One, two!"), (10, "one two"), (None, "one two"), (11, "a b c d e f"), (None, "lonely")]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string").selectExpr("1 as n", "'q' as ID", "doc_id", "text")
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in nd.near_duplicates(docs).collect())
    expected = [("10", "9", 3), ("10", "9", 3), ("11", "11", 0), ("5", "5", 0), ("6", "6", 0), ("7", "7", 0), ("8", "8", 0), ("9", "9", 3), ("None", "9", 3), ("None", "None", 0)]
    assert got == sorted(expected)
    assert nd.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_stays(spark):
    docs = spark.createDataFrame(ODD + [(20, "p q r s t u v"), (20, "p q r s t u v"), (12, "A b c d e f")], "doc_id bigint, text string")
    got = sorted((str(r.doc_id), str(r.text)) for r in nd.remove_near_duplicates(docs).collect())
    assert got == sorted([("5", "None"), ("6", ""), ("7", "!?"), ("8", "!?"), ("9", "one two"), ("11", "a b c d e f"), ("None", "lonely"), ("20", "p q r s t u v")])
    whole = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = nd.remove_near_duplicates(whole)
    classes = brute([(r.doc_id, r.text) for r in whole.collect()])
    assert kept.columns == whole.columns and {r.doc_id for r in kept.collect()} == {c for c, _ in classes.values()}


def test_signatures_and_paths():
    texts = ["a b c d e f g", "", "x", "a b c d e f g", "f g h"]
    values, at = nd.shingles(*text_buffers(pa.array(texts)))
    assert np.diff(at).tolist() == [3, 0, 1, 3, 1]
    sig = nd.signatures(values, at)
    assert (sig[0] == sig[3]).all() and (sig[0] != sig[4]).any() and not sig[1].any()
    paths = nd.paths_of(sig)
    labels = sig.reshape(-1, nd.TREES, nd.DEPTH)
    for k in range(nd.TREES):
        order = sorted(range(5), key=lambda i: labels[i, k].tolist())
        assert paths[:, k][order].tolist() == sorted(paths[:, k].tolist())


def test_ranges_of_sorted_paths():
    draw = np.random.default_rng(3)
    sig = draw.integers(0, 3, (200, nd.TREES * nd.DEPTH)).astype(np.uint8)
    paths = np.sort(nd.paths_of(sig).ravel())
    found = nd.crowds_of(paths)
    for length in range(1, nd.DEPTH + 1):
        nodes = nd.nodes_of(paths, length)
        _, inverse, n = np.unique(nodes, return_inverse=True, return_counts=True)
        at_an_end = (nodes == nodes[0]) | (nodes == nodes[-1])
        assert (found[:, length - 1] == n[inverse] + len(paths) * at_an_end).all()


def test_prefixes_are_shortened_where_that_costs_least():
    alone = np.ones((1, nd.TREES, nd.DEPTH), np.int64)
    crowded = alone.copy()
    crowded[0, :8, :5] = 10_000  # short prefixes of half of the trees are shared by many
    depths = nd.shortened(np.concatenate([alone, crowded]))
    assert (nd.recall_of(depths) >= nd.RECALL).all() and nd.DEPTH in depths
    assert depths[1, :8].min() == nd.DEPTH and depths[1, 8:].min() < nd.DEPTH and (depths[0] != depths[1]).any()
    # The target just holds: with any one prefix longer it would not.
    for row in depths:
        longer = [np.where(np.arange(nd.TREES) == k, row + 1, row) for k in range(nd.TREES) if row[k] < nd.DEPTH]
        assert any(nd.recall_of(x) < nd.RECALL for x in longer)
    assert nd.shortened(alone, 0.99).min() == nd.DEPTH and nd.shortened(alone, 0.05).max() == 1


def test_texts_ask_with_prefixes_of_their_own(spark):
    rows = edited(200) + [(1000 + i, " ".join(f"u{i}x{k}" for k in range(40))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    signed = nd._signed(docs).withColumnRenamed("doc_id", "id").dropDuplicates(["d1", "d2", "n"])
    found = {r.id: tuple(bytes(r.depth)) for r in nd._depths(signed, nd.THRESHOLD).collect()}
    assert len(set(found.values())) > 10
    crowd = [sum(d) for i, d in found.items() if i < 1000]
    assert np.mean([max(d) for i, d in found.items() if i < 1000]) == nd.DEPTH and min(crowd) >= 16
    assert all(nd.recall_of(np.array(d)) >= nd.RECALL for d in found.values())


def test_links_of_ten_thousand_texts(spark):
    """Against an inverted count of shingles; the recall is the share of link ends that are found."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: (r.class_id, r.n_links) for r in nd.near_duplicates(docs).collect()}
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert all(got[i][1] <= expected[i][1] for i in expected)
    assert sum(n for _, n in got.values()) >= nd.RECALL * sum(n for _, n in expected.values())
    assert sum(got[i] != expected[i] for i in expected) <= 2


def test_texts_and_sets_go_to_python_in_small_batches(spark, monkeypatch):
    seen, cut = [], nd.cut_lineage

    def spied(df):
        seen.append(int(df.sparkSession.conf.get(ARROW_ROWS)))
        return cut(df)

    monkeypatch.setattr(nd, "cut_lineage", spied)
    before = spark.conf.get(ARROW_ROWS)
    docs = spark.createDataFrame([(i, f"a b c d e f {i // 2}") for i in range(8)], "doc_id bigint, text string")
    assert sorted(r.class_id for r in nd.near_duplicates(docs).collect()) == [0, 0, 2, 2, 4, 4, 6, 6]
    assert len(seen) > 3 and max(seen) <= BATCH_ROWS and spark.conf.get(ARROW_ROWS) == before


def test_rows_as_a_binary_column():
    for rows in (np.arange(12, dtype="<i4").reshape(3, 4), np.zeros((0, 4), np.uint8), np.arange(6, dtype=np.uint8).reshape(2, 3)[::-1]):
        assert nd._binary(rows).to_pylist() == [r.tobytes() for r in rows]
