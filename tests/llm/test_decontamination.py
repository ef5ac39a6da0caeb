"""Hit words and items against a plain reading of the rule."""

import hashlib
import random
import re

import pytest
from conftest import SMALL

from tripweave.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id bigint, text string", "item_id string, text string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, n=13):
    windows = []
    for item, text in items:
        w = words(text)
        windows += [("" if item is None else str(item), tuple(w[i : i + min(n, len(w))])) for i in range(max(1, len(w) - n + 1))] if w else []
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found.add(item)
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def drawn(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(["a", "b", "C", "é", "don't", "1"]) for _ in range(n))


ITEM_ROWS = [("x", drawn(1, 40)), ("y", "three words only"), ("y", drawn(2, 13)), (None, drawn(3, 12)), ("z", None), ("w", "!!"), ("x", "Three words ONLY")]
DOC_ROWS = [
    (1, None),
    (1, None),
    (2, ""),
    (3, "..."),
    (4, drawn(1, 40)),
    (None, "filler " * 400 + drawn(1, 40).upper().replace("É", "é")),
    (5, "three, words; only"),
    (5, "three, words; only"),
    (6, "three words " * 50),
    (7, drawn(2, 12)),
    (8, drawn(2, 13) + " " + drawn(3, 12)),
    (9, "z " * 60_000 + drawn(1, 20) + " z" * 1000),
    (10, drawn(4, 300)),
]


def frames(spark):
    docs = spark.createDataFrame(DOC_ROWS, DOCS).selectExpr("doc_id", "text", "'q' AS Text", "1 AS item_id", "2 AS hit")
    items = spark.createDataFrame(ITEM_ROWS, ITEMS).selectExpr("'q' AS TEXT", "item_id", "text", "3 AS doc_id")
    return docs, items


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_same_as_the_rule(spark):
    assert rows(dc.contamination(*frames(spark))) == brute(DOC_ROWS, ITEM_ROWS)


@pytest.mark.parametrize("set_words", [30, 10**6])
def test_several_sets(spark, set_words):
    items = frames(spark)[1]
    marked = dc.mark_contamination(spark.createDataFrame(DOC_ROWS, DOCS), items, set_words=set_words)
    got = sorted(((r.doc_id, r.n_words, len(r.hit_words), len(r.hit_items)) for r in marked.collect()), key=str)
    assert got == sorted((r[:4] for r in brute(DOC_ROWS, ITEM_ROWS)), key=str)


def test_long_items_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(dc, "PIECE_WINDOWS", 7)
    assert rows(dc.contamination(*frames(spark))) == brute(DOC_ROWS, ITEM_ROWS)


def test_clean_documents_stay(spark):
    docs, items = frames(spark)
    kept = dc.remove_contaminated(docs, items)
    bad = [r for r, told in zip(DOC_ROWS, [brute([d], ITEM_ROWS)[0] for d in DOC_ROWS], strict=True) if told[-1]]
    assert kept.columns == docs.columns
    assert kept.count() == len(DOC_ROWS) - len(bad) and len(bad) >= 4


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert dc.contamination(docs.limit(0), items).count() == 0
    none = dc.contamination(docs, items.limit(0))
    assert none.where("n_hit > 0 OR contaminated").count() == 0 and none.count() == len(DOC_ROWS)


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(40).collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    table = spark.createDataFrame(docs, DOCS)
    assert rows(dc.contamination(table, spark.read.parquet(f"{SMALL}/benchmark.parquet"))) == brute(docs, items)
