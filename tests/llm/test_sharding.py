"""Laws of the shuffle."""

import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL

from tripweave.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 24, 25, 1000, 65_537])
def test_permutation_and_back(n):
    numbers = np.arange(n)
    place = sharding.permute(numbers, n)
    assert sorted(place.tolist()) == numbers.tolist()
    assert (sharding.permute(place, n, back=True) == numbers).all()
    shard, slot = sharding.locate(numbers, n, 7)
    assert (sharding.row_at(shard, slot, n, 7) == numbers).all()
    if n > 100:
        assert abs(np.corrcoef(numbers, place)[0, 1]) < 0.1
        assert (sharding.permute(numbers, n, seed=1) != place).mean() > 0.9


def laws(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert all(0 <= s < shards for s in counts)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in range(shards) for k in range(sizes[s])]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sharding.shard_documents(docs, 24).collect()
    laws(rows, 24)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    n = len(texts)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]))
        # Ids are 0 to n - 1 here, so they are the row numbers.
        assert sharding.row_at(np.array([r.shard]), np.array([r.slot]), n, 24)[0] == r.doc_id
    again = sharding.shard_documents(docs.repartition(5), 24).collect()
    assert sorted(rows) == sorted(again)


def test_repeats_nulls_and_few_rows(spark):
    rows = [(7, "same")] * 40 + [(None, None), (None, "x"), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("'z' as part", "text", "doc_id", "1 as Doc_ID2")
    got = sharding.shard_documents(docs, 5).collect()
    laws(got, 5)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(t or "") + 8) for i, t in rows)
    laws(sharding.shard_documents(docs.limit(2), 5).collect(), 5)
    assert sharding.shard_documents(docs.limit(0), 5).count() == 0
