"""The bound on training rows, and labels that are repeated or contradict each other."""

from tripweave.llm import quality, toxicity
from tripweave.llm.labelled import training_rows

DOCS = "doc_id bigint, text string"
LABELS = "doc_id bigint, toxic int"


def rows(spark, docs, labels, most=100):
    found = training_rows(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), "toxic", 4, 9, most)
    return sorted(((r.text, r.label) for r in found.collect()), key=str)


def test_one_row_for_each_id(spark):
    docs = [(1, f"text {i % 7}") for i in range(5000)] + [(2, "two"), (2, "two"), (None, "x"), (3, None)]
    found = rows(spark, docs, [(1, 1), (2, 0), (3, 1), (None, 1)], most=10)
    assert len(found) == 3 and ("two", 0) in found and (None, 1) in found
    assert rows(spark, docs, [(1, 1), (2, 0), (3, 1)], most=2) != found and len(rows(spark, docs, [(1, 1), (2, 0), (3, 1)], most=2)) == 2


def test_repeated_and_contradicting_labels(spark):
    docs = [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    labels = [(1, 1), (1, 1), (2, 0), (2, 1), (3, None), (3, 0), (9, 1)]
    assert rows(spark, docs, labels) == [("a", 1), ("c", 0)]
    assert rows(spark, docs, []) == [] and rows(spark, [], labels) == []


def test_repeats_do_not_change_the_scores(spark):
    docs = [(i, ("you damn fool " if i % 3 else "a calm day ") * (i % 5 + 1)) for i in range(60)]
    marks = [(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(60)]
    once = spark.createDataFrame(marks, "doc_id bigint, toxic int, quality int")
    table = spark.createDataFrame(docs, DOCS)
    twice = once.unionByName(once)
    for operator in (toxicity.toxicity, quality.quality):
        assert sorted(operator(table, once).collect()) == sorted(operator(table, twice).collect())
        repeated = operator(table.unionByName(table), twice)
        assert repeated.count() == 120
