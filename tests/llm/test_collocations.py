"""Collocations against plain counting, whatever the sample proposes."""

import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from conftest import SMALL
from tools.compare import rows_of

from tripweave.llm import collocations, plans

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NAME = "op12_collocations"


def pieces(text):
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
        yield re.findall("[^ \t]+", piece)


def counted(rows, longest=5):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, least, kept):
    f, n = counted(rows)
    found = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= least}
    inside = {}
    for (lang, w), c in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i : i + k]] = max(c, inside.get((lang, w[i : i + k]), 0))
    out = {}
    for (lang, w), a in found.items():
        if 100 * inside.get((lang, w), 0) >= 100 * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    ranked = []
    for lang, some in out.items():
        for i, (score, a, phrase, left, right) in enumerate(sorted(some)[:kept], 1):
            ranked.append((lang, i, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(ranked)


def texts(n, seed=1):
    draw = random.Random(seed)
    common = ["New York", "in the end", "a b c d e f", "x", "é ß", "of", "The", "\tof  the ", "end.\nof", "a,b"]
    return [(" ".join(draw.choices(common, range(10, 0, -1), k=draw.randint(0, 40))), draw.choice(["en", "fr", None, ""])) for _ in range(n)]


ROWS = [
    *texts(200),
    (None, "en"),
    ("", None),
    (" \t .,;", "en"),
    ("go go go go go go", "es"),
    ("long word " * 5000, "de"),
    ("w" * 100_000 + " tail " * 30, "de"),
    *[("the same text, told again", "en")] * 50,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i % 7 if i % 3 else None, t, lang) for i, (t, lang) in enumerate(ROWS)]
    made = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return made.selectExpr("*", "'x' AS Text", "1 AS n", "2 AS phrase", "'de' AS Lang")


def result(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("kept", [3, 2000])
def test_same_as_counting(docs, kept):
    assert result(collocations.collocations(docs, kept, least=10)) == brute(ROWS, 10, kept)


@pytest.mark.parametrize("mining", [{"one_in": 1 << 30}, {"one_in": 1}, {"caution": 4.0}, {"caution": 0.01}, {"bits": 64}])
def test_no_sample_and_no_filter_changes_the_result(docs, mining):
    assert result(collocations.collocations(docs, least=10, **mining)) == brute(ROWS, 10, 2000)


@pytest.mark.parametrize("one_in", [1, 1 << 30])
def test_border_failures_are_expanded(docs, one_in):
    """Also where nothing is proposed, so that the border is every single word."""
    expected = counted(ROWS)[0]
    frequent = sorted((lang, " ".join(w), c) for (lang, w), c in expected.items() if c >= 10)
    found = collocations.frequent_phrases(docs, least=10, one_in=one_in)
    assert sorted(map(tuple, found.where("phrase IS NOT NULL").collect())) == frequent


def test_the_border_is_what_is_counted():
    """A full filter counts everything, an empty one only single words."""
    rows, langs = pa.array(["a b c a b", "b c. a"]), pa.array(["en", "en"])
    empty, full = collocations.Filter(bytes_(0)), collocations.Filter(bytes_(255))

    def coded(wanted):
        parts = collocations.count_codes(rows, langs, None, 1, range(1, 4), 3, wanted)
        return sorted((int(c) & 7, int(n)) for codes, ns in parts for c, n in zip(codes, ns, strict=True))

    def told(counted, frequent):
        parts = collocations.count_phrases(rows, langs, 3, counted, frequent)
        return {(r["phrase"], r["n"]) for b in parts for r in b.to_pylist()}

    words, total = {("a", 3), ("b", 3), ("c", 2)}, {(None, 8)}
    longer = {("a b", 2), ("b c", 2), ("c a", 1), ("a b c", 1), ("b c a", 1), ("c a b", 1)}
    assert coded(empty) == [(1, 2), (1, 3), (1, 3)] and len(coded(full)) == 9
    assert told(full, full) == told(empty, full) == total | words | longer
    assert told(full, empty) == total and told(empty, empty) == total


def test_what_extends_a_border_failure_is_counted_with_it():
    """Only the words are known to be frequent and only ``b`` was proposed."""
    rows, langs = pa.array(["a b c d", "x y"]), pa.array(["en", "en"])
    codes = {}
    for cs, _ in collocations.count_codes(rows, langs, None, 1, range(1, 2), 0, None):
        codes = dict(zip(["a", "b", "c", "d", "x", "y"], sorted(cs.tolist()), strict=True))

    def holding(some):
        import numpy as np

        bits = np.zeros(1 << 13, np.uint8)
        for place in collocations.Filter.places(np.array(some, np.uint64), 8 << 13):
            bits[int(place) >> 3] |= 1 << (int(place) & 7)
        return collocations.Filter(bits)

    every = holding(list(codes.values()))
    parts = collocations.count_phrases(rows, langs, 4, holding([]), every)
    told = {r["phrase"] for b in parts for r in b.to_pylist()}
    assert {"a b", "b c", "a b c", "a b c d", "x y"} <= told


def test_whole_pieces_are_drawn():
    import numpy as np

    text = ". ".join(f"w{i} x{i}" for i in range(4000))
    cut = collocations._Slice.of(pa.array([text, text]), np.array([1, 2], np.uint64), 8)
    assert 1600 < len(cut.codes) < 2400 and len(cut.codes) == 2 * cut.link.sum()


def test_counts_are_put_together_in_a_task(docs, monkeypatch):
    monkeypatch.setattr(collocations, "HELD_CODES", 10)
    assert result(collocations.collocations(docs, least=10)) == brute(ROWS, 10, 2000)


def bytes_(value):
    import numpy as np

    return np.full(64, value, np.uint8)


def test_large_numbers_are_exact(spark):
    big = 3_000_000_000_000
    rows = [("en", "a b", big), ("en", "a", big + 1), ("en", "b", big + 3), ("en", None, 10**16 + 7)]
    found = spark.createDataFrame(rows, "lang string, phrase string, n bigint")
    got = collocations._scored(found).first()
    assert got.score == 1000 * big * (10**16 + 7) // ((big + 1) * (big + 3))


def test_same_as_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    expected = con.execute(plans.oracle_sql()[NAME])
    columns = [d[0] for d in expected.description]
    df = plans.queries()[NAME](spark, SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of(columns, expected.fetchall()) and len(got) > 20


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert collocations.collocations(docs).count() == 0
