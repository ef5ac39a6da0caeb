"""License notices against a plain reading of the rules and against the SQL of the query."""

import random
import re
import time

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from tools.compare import rows_of

from tripweave.llm import licenses, plans

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
MIT, APACHE, CC = "Under the MIT License", "Apache License, Version 2", "CC BY-NC"
NAME = "op11_license_scans"


def brute(text):
    w = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in licenses.PHRASES.items():
        wanted = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(wanted)] == wanted]
    labels, best = {label for _, label in places}, 0.0
    for e in licenses.entries(licenses.TEMPLATES, licenses.THRESHOLD):
        for start in range(0, len(w), e.step):
            held = e.words & set(w[start : start + 2 * e.step])
            if len(held) >= licenses.THRESHOLD * len(e.words):
                best = max(best, len(held) / len(e.words))
                if set(licenses.words_of(e.template.marks)) <= held:
                    labels.add(e.template.label)
    starts, base = [p for p, _ in places], {label for _, label in places}
    first, last = (min(starts), max(starts)) if starts else (None, None)
    return (len(w), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if places else best)


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(["the", "of", "mit", "work", "2", "élan", "license", "cc", "under", "x"]) for _ in range(n))


GRANT = next(t.text for t in licenses.TEMPLATES if t.name == "mit-grant")
TEXTS = [
    None,
    "",
    "...",
    f"{MIT}. {MIT}; {APACHE} {CC} {CC} {CC}",
    "under the mit é license under the MIT\nLicense, under the mit licKense",
    "LiKcensed under CC BY-NC 4.0, licensed under cc by-sa 4.0",
    "This worK is licensed under the GNU General Public License, version 3.",
    "this work is licensed under the gnu general public licence version 3",
    "this work is licensed under the gnu general public license version 2",
    GRANT,
    " ".join(w for i, w in enumerate(GRANT.split()) if i % 9),
    prose(1, 100) + " " + GRANT.upper() + " " + prose(2, 100),
    " ".join(GRANT.split()[::-1]),
    " ".join(f"{w} filler{i}" for i, w in enumerate(GRANT.split())),
    " ".join(w + " z" * 20 for w in "released under the mit license".split()),
    *[f"{prose(i, i)} released under MIT license {prose(i, 40)}" for i in range(12, 36)],
    *[prose(i, 60 * i) for i in range(1, 8)],
    "x " * 200_000 + GRANT + " y" * 1000 + " " + MIT,
    "under the mit license " * 3000,
]


def test_same_as_the_rules(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[9]), (3, TEXTS[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "'x' AS Text", "1 AS `row`", "2 AS known")
    got = sorted(map(tuple, licenses.licenses(docs).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_methods_labels_are_found(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.licenses(docs).collect()}
    assert [got[i].labels for i in (7, 8, 9, 10, 13)] == ["gpl-3", "", "mit", "mit", "mit"] and got[10].score < 1
    assert got[8].score > 0.8 and got[14].labels == ""


def test_blocks_and_shares(spark):
    docs = spark.createDataFrame([(1, GRANT), (2, "nothing")], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert [(f.template, f.label, f.share) for f in rows[1].found] == [("mit-grant", "mit", 1.0)]
    assert rows[2].found == [] and rows[2].places == []


def test_any_threshold_and_templates(spark):
    own = (licenses.Template("own", "own", "", "alpha beta gamma delta"),)
    docs = spark.createDataFrame([(1, "alpha x beta"), (2, "delta"), (3, "alpha alpha alpha")], "doc_id bigint, text string")
    found = {r.doc_id: [f.share for f in r.found] for r in licenses.scan_licenses(docs, own, 0.5).collect()}
    assert found == {1: [0.5], 2: [], 3: []}
    with pytest.raises(ValueError, match="words"):
        licenses.scan_licenses(docs, (licenses.Template("none", "none", "", "..."),))


def test_same_as_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    expected = con.execute(plans.oracle_sql()[NAME])
    columns = [d[0] for d in expected.description]
    df = plans.queries()[NAME](spark, SMALL)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, expected.fetchall())


RANGES = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def test_words_of_every_character(spark):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rows = [("".join(f"{chr(c)}a{chr(c)} " for c in points[at : at + 4096]),) for at in range(0, len(points), 4096)]
    found = [F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in (licenses.WORD, RANGES)]
    assert spark.createDataFrame(rows, "text string").where(~found[0].eqNullSafe(found[1])).count() == 0


def test_words_are_found_without_asking_range_after_range(spark):
    docs = spark.range(0, 200, 1, 1).select(F.concat(F.lit(prose(3, 4000)), F.col("id").cast("string")).alias("text")).localCheckpoint()

    def seconds(pattern):
        began = time.perf_counter()
        docs.agg(F.sum(F.size(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))).first()
        return time.perf_counter() - began

    took = [(seconds(licenses.WORD), seconds(RANGES)) for _ in range(4)]
    assert min(t for t, _ in took) < 0.7 * min(t for _, t in took)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert licenses.licenses(docs).count() == 0


def test_no_python_in_any_task(spark):
    docs = spark.createDataFrame([(1, GRANT)], "doc_id bigint, text string")
    plan = licenses.licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
