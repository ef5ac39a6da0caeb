"""Removal of benchmark passages: a broadcast hash set of benchmark windows, and one
scan of the texts that looks up the hash of every window of words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.columns import in_plain_names, pick, slices, text_buffers
from tripweave.llm.words import LOWER, windows, words
from tripweave.session import cut_lineage

WINDOW = 13
# Words of benchmark text in one broadcast set; a larger benchmark takes several sets, one after the other.
SET_WORDS = 1_000_000
# Windows of an item that are kept together.
PIECE_WINDOWS = 10_000


def _pieces(benchmark: DataFrame, n: int) -> DataFrame:
    """(item_id, words) of item parts that overlap by n - 1 words, so that each window is in one part."""
    found = pick(benchmark, "item_id", "text").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.expr(r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
               r" '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', 0)").alias("w"),
    )
    parts = F.expr(f"sequence(0, greatest(0, size(w) - {n}), {PIECE_WINDOWS})")
    return (
        found.where(F.size("w") > 0)
        .select("item_id", "w", F.explode(parts).alias("at"))
        .select("item_id", F.slice("w", F.col("at") + 1, PIECE_WINDOWS + n - 1).alias("words"))
    )


def _hash_words(items: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    text = b"".join(b" ".join(x) + b" " for x in items)
    data = np.frombuffer(text, np.uint8)
    found = words(data, np.array([0, len(data)]))
    return found.hashes, np.cumsum([0] + [len(x) for x in items])


class WindowSet:
    """The windows of some items, by length and hash."""

    def __init__(self, rows: list[tuple[str, list[str]]], n: int):
        self.items = [item for item, _ in rows]
        self.words = [[w.encode() for w in text] for _, text in rows]
        hashes, starts = _hash_words(self.words)
        at: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for i, text in enumerate(self.words):
            size = min(n, len(text))
            for k, h in enumerate(windows(hashes[starts[i] : starts[i + 1]], size).tolist()):
                at[size][h].append((i, k))
        self.by_size = {size: (np.sort(np.array(list(x), np.uint64)), dict(x)) for size, x in at.items()}

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[list[int]], list[set[str]]]:
        """For each text the numbers of its words inside an occurring window, and the items of these."""
        found = words(data, offsets)
        hit, items = np.zeros(len(found.hashes) + 1, np.int64), [set() for _ in range(len(offsets) - 1)]
        text_of = found.text_of()
        lower = LOWER[data].tobytes()
        for size, (known, places) in self.by_size.items():
            hashes = windows(found.hashes, size)
            near = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            one_text = text_of[: len(hashes)] == text_of[size - 1 :] if len(hashes) else np.zeros(0, bool)
            sure: dict[tuple[int, bytes], set[str]] = {}
            for at in np.flatnonzero((known[near] == hashes) & one_text).tolist():
                # A hash can lie: the words themselves decide.
                own = b" ".join(lower[s:e] for s, e in zip(found.starts[at : at + size].tolist(), found.ends[at : at + size].tolist(), strict=True))
                key = (int(hashes[at]), own)
                if key not in sure:
                    sure[key] = {self.items[i] for i, k in places[key[0]] if b" ".join(self.words[i][k : k + size]) == own}
                if sure[key]:
                    hit[at] += 1
                    hit[at + size] -= 1
                    items[text_of[at]] |= sure[key]
        marked = np.cumsum(hit[:-1]) > 0
        numbers = np.arange(len(marked)) - np.repeat(found.offsets[:-1], np.diff(found.offsets))
        return [numbers[a:b][marked[a:b]].tolist() for a, b in zip(found.offsets[:-1], found.offsets[1:], strict=True)], items


def mark_contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, set_words: int = SET_WORDS) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``hit_words`` (numbers of the words inside any
    window of the benchmark) and ``hit_items`` (ids of the items that have such a window, as
    sorted text).

    A window is ``n`` consecutive words of an item; an item of fewer words is one window.  A
    null or wordless text has no hits.  A null item id counts as empty text, items of one id as
    one.  Repeated rows are judged each on its own.  Further columns of ``docs`` pass through;
    ``docs`` must not have columns of the names above.

    One set is broadcast if the benchmark is within ``set_words``, which bounds its size; a
    larger benchmark is dealt into several sets that the same rows pass one after the other, stored
    between them, so neither a task nor the driver holds more than one.
    """
    pieces = cut_lineage(_pieces(benchmark, n))
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    sets = -(-total // set_words)
    pieces = pieces.withColumn("set", F.pmod(F.xxhash64("item_id", "words"), F.lit(max(sets, 1))))
    out = docs.withColumns(
        {
            "hit_words": F.array().cast("array<int>"),
            "hit_items": F.array().cast("array<string>"),
        }
    )
    context = docs.sparkSession.sparkContext
    for k in range(max(sets, 1)):
        rows = [(r.item_id, list(r.words)) for r in pieces.where(F.col("set") == k).select("item_id", "words").collect()]
        known = context.broadcast(WindowSet(rows, n))

        def scan(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                data, offsets = text_buffers(batch.column("text"))
                places, items = known.value.hits(data, offsets)
                columns = {name: batch.column(name) for name in batch.schema.names}
                before = zip(columns["hit_words"].to_pylist(), columns["hit_items"].to_pylist(), strict=True)
                both = [(sorted({*a, *p}), sorted({*b, *i})) for (a, b), p, i in zip(before, places, items, strict=True)]
                columns["hit_words"] = pa.array([x for x, _ in both], pa.list_(pa.int32()))
                columns["hit_items"] = pa.array([x for _, x in both], pa.list_(pa.string()))
                columns["n_words"] = pa.array(np.diff(words(data, offsets).offsets), pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

        schema = T.StructType([f for f in out.schema.fields if f.name != "n_words"] + [T.StructField("n_words", T.LongType())])
        out = out.mapInArrow(scan, schema)
        if k + 1 < sets:
            # A stage ends here, so that the next one holds the next set alone.
            out = cut_lineage(out)
            known.unpersist()
    return out


def contaminated(n_words: str = "n_words", hit_words: str = "hit_words"):
    """The rule: some words are hit, and at least one in twenty."""
    hits = F.size(hit_words).cast("bigint")
    return (hits > 0) & (20 * hits >= F.col(n_words))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` without its contaminated documents; all others are kept as they are."""
    return in_plain_names(docs, ("text",), lambda d: mark_contamination(d, benchmark, n).where(~contaminated()))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of each document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked = mark_contamination(pick(docs, "doc_id", "text"), benchmark)
    return marked.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("bigint").alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("hit_items")), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
