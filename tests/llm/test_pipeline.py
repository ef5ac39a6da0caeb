"""Each stage on its own input, judged by brute force."""

import re

import public_tokenizers
import pytest
import tiktoken
from test_bpe import PATH, digests
from test_near_duplicates import LOWER, WORD, brute
from test_secrets import base

import corpus_pipeline
from tripweave.llm import bpe
from tripweave.session import ARROW_ROWS, BATCH_ROWS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """name -> (rows in, rows out)"""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline._stored(spark, stage(spark, docs, SF), name)
        if name != "encoding":
            assert result.columns == columns and result.dtypes == docs.dtypes
        out[name] = (docs.collect(), result.collect())
        docs = result
    return out


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "encoding"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert set(after) <= set(before) and gone & toxic and len(gone) < len(before) / 2


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    assert set(after) <= set(before)
    assert {r.doc_id for r in after} == {c for c, _ in brute([(r.doc_id, r.text) for r in before]).values()}


def test_benchmark_passages_go(spark, stages):
    before, after = stages["decontamination"]
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = WORD.findall((r.text or "").translate(LOWER))
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes = {len(w) for w in windows}
    kept = set()
    for r in before:
        w = WORD.findall(r.text.translate(LOWER))
        hit = {i + k for n in sizes for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for k in range(n)}
        if not hit or 20 * len(hit) < len(w):
            kept.add(r)
    assert set(after) == kept


def test_secrets_are_replaced(stages):
    before, after = stages["secrets"]
    texts = {r.doc_id: r for r in before}
    assert len(after) == len(before)
    for r in after:
        if not base(texts[r.doc_id].text):
            assert r == texts[r.doc_id] or "[SECRET]" in r.text
        assert not base(r.text) and r.n_chars == (len(r.text) if r != texts[r.doc_id] else texts[r.doc_id].n_chars)
    assert any("[SECRET]" in r.text for r in after) or not any(base(r.text) for r in before)


def test_encoding(stages):
    before, after = stages["encoding"]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    texts = {r.doc_id: r.text for r in before}
    assert len(after) == len(before)
    for r in after:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(library, texts[r.doc_id])


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(got.collect()) == sorted(stages["encoding"][1])
    assert re.match("ids", got.columns[1])


def test_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_stages_keep_columns_with_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    names = ["score", "n_words", "hit_words", "row", "spans", "d1", "k", "rows", "class_id", "Text2"]
    more = docs.selectExpr("*", *[f"doc_id AS `{n}`" for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, SF)
        assert out.columns == more.columns and all(r[n] == r.doc_id for r in out.collect() for n in names), name


def test_stages_send_small_batches_and_restore_the_setting(spark, monkeypatch):
    before, seen, write = spark.conf.get(ARROW_ROWS), [], corpus_pipeline.write_table
    monkeypatch.setattr(corpus_pipeline, "write_table", lambda df, path: seen.append(int(spark.conf.get(ARROW_ROWS))) or write(df, path))

    def sizes(batches):
        for batch in batches:
            yield batch.slice(0, 0) if batch.num_rows <= BATCH_ROWS else batch

    many = spark.range(0, 4 * BATCH_ROWS, 1, 1)
    assert corpus_pipeline._stored(spark, many.mapInArrow(sizes, many.schema), "batches").count() == 0
    assert seen == [BATCH_ROWS] and spark.conf.get(ARROW_ROWS) == before
