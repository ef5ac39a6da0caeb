"""Nearest neighbours by an adaptive scan of dimensions within inverted lists.

Vectors are grouped by their nearest centroid.  A query visits the lists nearest to it.
There it compares rotated unit vectors a few columns at a time: after a rotation the first
d of D columns are a fair sample of a distance, so a candidate whose scaled partial distance
is too far beyond the query's bound to be explained by chance is given up, and the others
go on to the next columns.  What remains is measured exactly on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.columns import pick
from tripweave.session import cut_lineage

NEAREST = 5
QUERY_EVERY = 50

# The centroids are fitted on at most so many vectors; every vector is indexed.
SAMPLE_ROWS = 20_000
MOST_LISTS = 4096
LLOYD_ROUNDS = 8
# Part of the sample that gives each query a first bound.
BOUND_ROWS = 4096

# A query visits its nearest lists until they hold this share of all vectors.  Vectors without clusters,
# like random ones, need a large share for a recall of 0.9; clustered ones could do with less.
VISITED_SHARE = 0.75

# Columns in a step of the scan, and how many standard errors a partial distance may be beyond the bound.
STEP = 16
ERRORS = 2.1

# Rows of a list, and queries, that meet in one task at a time; larger lists and more queries are cut.
LIST_ROWS = 2048
TASK_QUERIES = 1024
_PAIRS = 1 << 18


def _stack(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in vectors])


def units(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows of ``a`` with rows of ``b`` in double precision."""
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    return (a * b).sum(1) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def rotation(width: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(3).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


class Fitted(NamedTuple):
    centroids: np.ndarray
    sample: np.ndarray  # unit vectors for the first bounds

    def lists(self, unit: np.ndarray) -> np.ndarray:
        return (unit @ self.centroids.T).argmax(1)


def fit(sample: np.ndarray, rows: int) -> Fitted:
    """Spherical k-means with about the square root of ``rows`` lists."""
    unit = units(sample)
    lists = int(np.clip(np.sqrt(rows), 1, min(MOST_LISTS, len(unit))))
    centroids = unit[np.random.default_rng(5).permutation(len(unit))[:lists]].copy()
    for _ in range(LLOYD_ROUNDS):
        own = (unit @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, unit)
        norms = np.linalg.norm(sums, axis=1)
        centroids[norms > 0] = sums[norms > 0] / norms[norms > 0, None]
    return Fitted(centroids, unit[:BOUND_ROWS])


def scan(queries: np.ndarray, rows: np.ndarray, bounds: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(query numbers, row numbers) of candidates that survive the scan, for rotated unit vectors.

    ``bounds`` are squared distances that the query's ``keep`` nearest are known not to exceed; they are
    drawn closer by the exact distances of the candidates that look nearest after the first step and half way.
    """
    width = queries.shape[1]
    first = min(STEP, width)
    partial = ((queries[:, None, :first] ** 2).sum(2) + (rows[None, :, :first] ** 2).sum(2)) - 2 * queries[:, :first] @ rows[:, :first].T
    if rows.shape[0] > keep:
        likely = np.argpartition(partial, keep - 1, axis=1)[:, :keep]
        exact = ((queries[:, None, :] - rows[likely]) ** 2).sum(2)
        bounds = np.minimum(bounds, exact.max(1))
    # Rounding must not drop a candidate that ties with the bound.
    bounds = bounds + 1e-9

    def limit(d: int) -> np.ndarray:
        return bounds * (1 if d >= width else d / width * (1 + ERRORS / np.sqrt(d)) ** 2) + 1e-9

    q, r = np.nonzero(partial <= limit(first)[:, None])
    so_far = partial[q, r]
    for d in range(first, width, STEP):
        e = min(d + STEP, width)
        so_far = so_far + ((queries[q, d:e] - rows[r, d:e]) ** 2).sum(1)
        if d < width / 2 <= e:
            # Half way the nearest so far are known better, and so is the bound.
            order = np.lexsort((so_far, q))
            best = order[np.arange(len(q)) - np.searchsorted(q, q) < keep]
            exact = ((queries[q[best]] - rows[r[best]]) ** 2).sum(1)
            nearer, n = np.zeros(len(queries)), np.bincount(q[best], minlength=len(queries))
            np.maximum.at(nearer, q[best], exact)
            bounds = np.where(n == keep, np.minimum(bounds, nearer + 1e-9), bounds)
        alive = so_far <= limit(e)[q]
        q, r, so_far = q[alive], r[alive], so_far[alive]
    return q, r


def _nearest_in_list(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The best candidates of one part of a list for some queries."""
    names = ["query", "class", "ids", "score", "least"]
    if not len(left) or not len(right):
        return pd.DataFrame({n: [] for n in names})
    queries, rows = _stack(left["vector"]), _stack(right["vector"])
    turn = rotation(queries.shape[1])
    turned_q, turned_r = units(queries) @ turn, units(rows) @ turn
    bounds, keep = left["bound"].to_numpy(), NEAREST + 1
    ids, least = right["ids"].to_numpy(), np.array([min(i) for i in right["ids"]])
    out = []
    step = max(1, _PAIRS // len(rows))
    for at in range(0, len(queries), step):
        q, r = scan(turned_q[at : at + step], turned_r, bounds[at : at + step], keep)
        score = cosines(queries[at + q], rows[r])
        order = np.lexsort((least[r], -score, q))
        q, r, score = q[order], r[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best = place < keep
        q, r, score = q[best], r[best], score[best]
        out.append(pd.DataFrame({"query": left["class"].to_numpy()[at + q], "class": right["class"].to_numpy()[r], "ids": ids[r], "score": score, "least": least[r]}))
    return pd.concat(out, ignore_index=True)


def _valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector, class) of the vectors that take part; equal vectors have equal classes."""
    vector = F.col("embedding").cast("array<double>")
    low, high = F.array_min(F.transform(vector, F.abs)), F.array_max(F.transform(vector, F.abs))
    usable = (
        F.col("vec_id").isNotNull()
        & (F.size(vector) > 0)
        & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
        & (high > 0)
        & low.isNotNull()
    )
    rows = pick(vectors, "vec_id", "embedding").where(F.coalesce(usable, F.lit(False)))
    # Adding zero makes -0.0 and 0.0 alike.
    clean = F.transform(vector, lambda x: x + F.lit(0.0))
    return rows.select("vec_id", clean.alias("vector")).withColumn("class", F.sha2(F.to_json("vector"), 256)).dropDuplicates(["vec_id", "class"])


def _cut(parts: dict[int, int], key: Column, seed: int) -> Column:
    """A part of the list for ``key``; ``parts`` has at most one entry for each list."""
    of = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.element_at(of, F.col("list"))).cast("int")


def search(vectors: DataFrame, is_query: Column, nearest: int = NEAREST, share: float = VISITED_SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` rows by cosine found for each row that ``is_query``
    (a condition on vec_id) selects, without the row itself; ties go to the smaller vec_id.

    Vectors that are null, empty, zero, or hold null or non-finite components, rows with a null id,
    and vectors of another dimension than the most frequent one (the larger on a tie) take no part.
    Rows repeated with id and vector count once.  Fewer candidates than ``nearest`` are all returned.

    Equal vectors are one candidate with its few smallest ids, and equal queries are searched once, so
    a vector that very many rows share costs no more than another.
    """
    if nearest != NEAREST:
        raise ValueError(f"lists are scanned for {NEAREST} neighbours")
    spark = vectors.sparkSession
    none = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    valid = _valid(vectors)
    dims = valid.groupBy(F.size("vector").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    if dims is None:
        return none
    stored = cut_lineage(valid.where(F.size("vector") == dims.d))

    # Each different vector with the ids that can be among the nearest: one more than asked for, as the query itself may be one.
    few = Window.partitionBy("class").orderBy("vec_id")
    classes = cut_lineage(
        stored.withColumn("n", F.row_number().over(few))
        .where(F.col("n") <= nearest + 1)
        .groupBy("class")
        .agg(F.first("vector").alias("vector"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    total = classes.count()
    sample = classes.orderBy(F.xxhash64("class", F.lit(1)), "class").limit(SAMPLE_ROWS).select("vector").collect()
    fitted = fit(_stack(r.vector for r in sample), total)
    known = spark.sparkContext.broadcast(fitted)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit = units(_stack(batch.column("vector").to_pylist()))
                yield batch.append_column("list", pa.array(known.value.lists(unit), pa.int32()))

    schema = "class string, vector array<double>, ids array<bigint>, list int"
    listed = classes.mapInArrow(assign, schema)
    sizes = {r.list: r.n for r in listed.groupBy("list").agg(F.count("*").alias("n")).collect()}
    size = np.zeros(len(fitted.centroids))
    for k, n in sizes.items():
        size[k] = n

    asked = stored.where(is_query).select("vec_id", "class")
    query_classes = classes.join(asked.select("class").distinct(), "class", "left_semi")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = units(_stack(batch.column("vector").to_pylist()))
            order = np.argsort(-(unit @ known.value.centroids.T), 1, kind="stable")
            held = size[order]
            # Up to the share, and in any case until there are enough candidates.
            visited = (held.cumsum(1) - held < max(share * size.sum(), 4 * nearest)) & (held > 0)
            # One more than the candidates wanted, since the sample may hold the query itself.
            near = 2 - 2 * unit @ known.value.sample.T
            k = nearest + 1
            bound = np.partition(near, k, axis=1)[:, k] if near.shape[1] > k else np.full(len(unit), 4.0)
            row, place = np.nonzero(visited)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("class").take(pa.array(row)),
                    batch.column("vector").take(pa.array(row)),
                    pa.array(np.maximum(bound, 0)[row]),
                    pa.array(order[row, place], pa.int32()),
                ],
                names=["class", "vector", "bound", "list"],
            )

    visits = cut_lineage(query_classes.mapInArrow(visit, "class string, vector array<double>, bound double, list int"))
    asking = {r.list: r.n for r in visits.groupBy("list").agg(F.count("*").alias("n")).collect()}
    if not asking:
        return none
    row_parts = {k: -(-n // LIST_ROWS) for k, n in sizes.items()}
    query_parts = {k: -(-asking.get(k, 1) // TASK_QUERIES) for k in sizes}

    def all_parts(parts: dict[int, int]) -> Column:
        of = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])
        return F.explode(F.sequence(F.lit(0), F.element_at(of, F.col("list")) - 1))

    keys = ["list", "row_part", "query_part"]
    left = visits.withColumn("query_part", _cut(query_parts, F.col("class"), 2)).withColumn("row_part", all_parts(row_parts))
    right = listed.where(F.col("list").isin(list(asking))).withColumn("row_part", _cut(row_parts, F.col("class"), 3)).withColumn("query_part", all_parts(query_parts))
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(_nearest_in_list, "query string, class string, ids array<bigint>, score double, least bigint")
    )
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "least")
    merged = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= nearest + 1)
    answers = merged.select("query", "score", F.explode("ids").alias("vec_id"), F.col("class").alias("found"))
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        asked.select(F.col("vec_id").alias("query_id"), F.col("class").alias("query"))
        .join(answers, "query")
        .where((F.col("vec_id") != F.col("query_id")) | (F.col("found") != F.col("query")))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )
