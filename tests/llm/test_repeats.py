"""Removed bytes against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest

from tripweave.llm import repeats


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, sha) of rows in reading order."""
    data = [(t or "").encode() for _, t in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    seen, out = set(), [None] * len(rows)
    for k in order:
        text, gone = data[k], np.zeros(len(data[k]) + 1, bool)
        for s in range(len(text) - 99):
            w = text[s : s + 100]
            if w in seen:
                gone[s : s + 100] = True
            seen.add(w)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone[:-1]])
        out[k] = (rows[k][0], len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def run(docs):
    return sorted(map(tuple, repeats.remove_repeats(docs, digest=True).collect()), key=str)


def words(draw, n):
    return " ".join("".join(draw.choice("abcdehinorst") for _ in range(draw.randrange(2, 9))) for _ in range(n))


def made(seed):
    draw = random.Random(seed)
    passages = [words(draw, 40) for _ in range(4)]
    out = []
    for i in range(60):
        parts = [words(draw, draw.randrange(30)) for _ in range(3)]
        for _ in range(draw.randrange(3)):
            p = draw.choice(passages)
            s = draw.randrange(0, 40)
            parts.insert(draw.randrange(len(parts)), p[s : s + draw.randrange(95, 300)])
        out.append((draw.randrange(1000) if i % 7 else None, "".join(parts)))
    base = words(draw, 150)
    for i in range(20):
        w = base.split(" ")
        w[draw.randrange(len(w))] = "edit"
        out.append((2000 + i, " ".join(w)))
    out += [(3000, "a" * 700), (3001, "ab" * 300 + "c" + "ab" * 200), (3002, None), (3003, ""), (3004, "x" * 99), (3005, "é" * 60), (3005, "é" * 60)]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_made_texts(spark, seed, monkeypatch):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("'x' as Text", "1 as row", "doc_id", "text")
    assert run(docs) == sorted(brute(rows), key=str)


def test_crowded_grams_are_compared_by_windows(spark, monkeypatch):
    rows = made(3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(repeats, "BUCKET_CONTEXTS", 3)
    assert run(docs) == sorted(brute(rows), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = run(docs)
    assert got == sorted(brute(rows), key=str) and sum(r[2] for r in got) > 0


def test_kept_bytes_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "q" * 50), (2, "q" * 120)], "doc_id bigint, text string")
    assert sorted((r.doc_id, bytes(r.kept)) for r in repeats.remove_repeats(docs).collect()) == [(1, b"q" * 50), (2, b"q")]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_index_streams_the_true_lengths():
    draw = np.random.default_rng(0)
    symbols = np.concatenate([np.tile(draw.integers(1, 4, 40), 6), [0], draw.integers(1, 3, 300), [0]]).astype(np.uint16)
    index = repeats.RunLengthIndex(symbols)
    order = sorted(range(len(symbols)), key=lambda p: symbols[p:].tolist())
    assert repeats.suffix_array(symbols).tolist() == order
    above, length = index.matching_statistics(len(symbols))
    for r, p in enumerate(order):
        if r:
            q = order[r - 1]
            n = 0
            while max(p, q) + n < len(symbols) and symbols[p + n] == symbols[q + n]:
                n += 1
            assert above[p] == q and length[p] == n
    assert index.run_lengths.sum() == len(symbols) and len(index.place) < len(symbols)


def test_long_texts_in_segments(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(1, words(draw, 900)), (2, words(draw, 50))]
    rows.append((3, rows[0][1][1000:3000] + rows[1][1]))
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    data = [np.frombuffer(t.encode(), np.uint8) for _, t in rows]
    for d in data:
        parts = list(repeats._segments(d, np.array([0, len(d)])))
        starts = sorted(base + s + k for x, o, _, base in parts for s, w in zip(*repeats.contexts(x, o)[3:], strict=True) for k in range(w))
        assert starts == list(range(max(0, len(d) - 99)))
    assert run(spark.createDataFrame(rows, "doc_id bigint, text string")) == sorted(brute(rows), key=str)
