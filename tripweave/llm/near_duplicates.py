"""Near-duplicate texts: a MinHash LSH forest for candidates, exact Jaccard of word 5-grams after it.

Every text has a path of labels in each of several trees.  The paths of a tree are sorted, so the
texts that share a prefix with a text are a range of its tree, which binary search finds at any
length.  Each text asks each tree with a prefix of its own length: it starts with whole paths and shortens
one prefix after the other, always where that adds the fewest texts for the recall gained, until texts at
the threshold are found with the target recall.  So it asks crowded branches with long prefixes and
empty ones with short prefixes.  What shares an asked prefix is compared: first the paths, then, for
pairs that may be similar, the sets themselves.

No pair is ever a row.  A node is cut into blocks of bounded size and a task compares two
blocks at a time, so a node with very many members is spread over many tasks; a pair that
meets in several trees counts in the first.  A task gives, for each text, the number of
its links and one link that connects it; components of these are the groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.columns import in_plain_names, pick, slices, text_buffers
from tripweave.llm.words import mix, windows, words
from tripweave.operators.graph import connected_components
from tripweave.session import cut_lineage, small_batches

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 16, 6
RECALL = 0.999

# Sorted paths that are searched at once; a range that may go on beyond them counts as longer than all of them.
_PATHS = 1 << 20
# Of what they give, rows that are sent at once.
_ROWS = 1 << 14
# Texts of a node in one block; a task holds two blocks.
BLOCK = 512
# Candidate pairs that a task looks at in one step.
_PAIRS = 1 << 17

_DRAW = np.random.default_rng(0xF03E57)
_FACTORS = _DRAW.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _DRAW.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def recall_of(depths: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """The probability that a text at the threshold shares a prefix of these lengths in some tree."""
    return 1 - np.prod(1 - threshold ** depths.astype(float), axis=-1)


def shortened(crowds: np.ndarray, threshold: float = THRESHOLD, recall: float = RECALL) -> np.ndarray:
    """The prefix length of each text in each tree, from the number of texts at each length:
    ``crowds[text, tree, length - 1]``.

    Starting from whole paths, a text shortens the prefix that adds the fewest texts for its share of the
    missing recall, until the target holds.
    """
    n, trees, depth = crowds.shape
    chance = np.array([np.inf, *(-np.log(1 - threshold ** np.arange(1, depth + 1)))])  # of a miss, as minus its logarithm
    target = -np.log(1 - recall)
    depths = np.full((n, trees), depth)
    rows, each = np.arange(n), np.arange(trees)
    while len(rows):
        now = depths[rows]
        known = crowds[rows[:, None], each, now - 1]
        more = crowds[rows[:, None], each, np.maximum(now - 2, 0)] - known
        price = np.where(now > 1, (more + 1) / (chance[np.maximum(now - 1, 1)] - chance[now] + 1e-12), np.inf)
        best = price.argmin(1)
        open_ = (chance[now].sum(1) < target) & np.isfinite(price[np.arange(len(rows)), best])
        rows, best = rows[open_], best[open_]
        depths[rows, best] -= 1
    return depths.astype(np.uint8)


def crowds_of(paths: np.ndarray) -> np.ndarray:
    """For sorted paths (the tree above their labels): how many share each length of prefix, from 1 on.
    A range at either end of the paths counts as longer than all of them."""
    out = np.zeros((len(paths), DEPTH), np.int64)
    for length in range(1, DEPTH + 1):
        rest = np.uint64((1 << (8 * (DEPTH - length))) - 1)
        start, end = np.searchsorted(paths, paths & ~rest, "left"), np.searchsorted(paths, paths | rest, "right")
        out[:, length - 1] = end - start + len(paths) * ((start == 0) | (end == len(paths)))
    return out


def paths_of(sig: np.ndarray) -> np.ndarray:
    """The path of each text in each tree as a number that sorts by labels: tree, then the labels."""
    labels = sig.reshape(len(sig), TREES, DEPTH).astype(np.uint64)
    weights = np.uint64(1) << (np.uint64(8) * np.arange(DEPTH - 1, -1, -1, dtype=np.uint64))
    return (labels * weights).sum(2, dtype=np.uint64) | (np.arange(TREES, dtype=np.uint64) << np.uint64(8 * DEPTH))


def nodes_of(paths: np.ndarray, length: int) -> np.ndarray:
    """The node of each path at a length: the length, and the path without the labels beyond it."""
    rest = np.uint64((1 << (8 * (DEPTH - length))) - 1)
    return (paths & ~rest) | (np.uint64(length) << np.uint64(8 * DEPTH + 8))


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted different shingle hashes of each text, offsets of the texts in them).

    A text of fewer words than a shingle, but not none, has one shingle of all its words.
    """
    found = words(data, offsets)
    n = np.diff(found.offsets)
    text_of = found.text_of()
    hashes, owners = [], []
    for size in range(1, SHINGLE_WORDS + 1):
        each = windows(found.hashes, size)
        if not len(each):
            break
        here = text_of[: len(each)]
        good = here == text_of[size - 1 :]
        if size < SHINGLE_WORDS:
            good &= n[here] == size
        hashes.append(each[good])
        owners.append(here[good])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    value, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.searchsorted(owner[new], np.arange(len(offsets)))


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return (total[at[1:]] - total[at[:-1]]).view(np.int64)


def digests(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over the set of each text, and its size: equal for equal sets."""
    return _sums(mix(values ^ np.uint64(0xA5A5A5A5)), at), _sums(mix(values * _FACTORS[0]), at), np.diff(at)


def signatures(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """uint8 labels, TREES x DEPTH for each text: a few bits of a MinHash each; zeros for an empty set."""
    out = np.zeros((len(at) - 1, TREES * DEPTH), np.uint8)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        for f in range(TREES * DEPTH):
            least = np.minimum.reduceat((values * _FACTORS[f] + _SHIFTS[f]) >> np.uint64(16), at[full])
            out[full, f] = (mix(least) & np.uint64(255)).astype(np.uint8)
    return out


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, d1, d2, n, sig) of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, at = shingles(*text_buffers(batch.column("text")))
            sig = signatures(values, at)
            columns = [pa.array(x) for x in digests(values, at)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, _binary(sig)], names=["doc_id", "d1", "d2", "n", "sig"])

    return docs.mapInArrow(sign, "doc_id bigint, d1 bigint, d2 bigint, n bigint, sig binary")


# ---- Comparing the members of a node ------------------------------------------------


def _pairs(left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs between two blocks, or within one, in steps of bounded size."""
    step = max(1, _PAIRS // max(len(right), 1))
    for at in range(0, len(left), step):
        a, b = np.meshgrid(np.arange(at, min(at + step, len(left))), np.arange(len(right)), indexing="ij")
        a, b = a.ravel(), b.ravel()
        if same:
            a, b = a[a < b], b[a < b]
        yield left[a], right[b]


def _candidates(
    sig: np.ndarray, depth: np.ndarray, block: np.ndarray, node: tuple[int, int, int, int], threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs whose paths agree often enough for the threshold and that meet in this node first.

    A pair meets in a tree if one of the two asks with a prefix that the other shares: the shorter one of both.
    """
    tree, length, lo, hi = node
    labels = sig.shape[1]
    # Five standard errors below what two texts at the threshold agree in.
    enough = threshold * labels - 5 * np.sqrt(labels * threshold * (1 - threshold))
    a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    for i, j in _pairs(a, a if lo == hi else b, lo == hi):
        asked = np.minimum(depth[i, tree], depth[j, tree]) == length
        i, j = i[asked], j[asked]
        equal = sig[i] == sig[j]
        keep = equal.sum(1) >= enough
        i, j, equal = i[keep], j[keep], equal[keep]
        shared = np.minimum.accumulate(equal.reshape(len(i), TREES, DEPTH), 2).sum(2)
        first = (shared >= np.minimum(depth[i], depth[j])).argmax(1) == tree
        yield i[first], j[first]


def _by_node(batches: Iterator[pa.RecordBatch], most: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Batches that end where a node ends, of rows sorted by (node, lo, hi); a node's rows are bounded."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < most:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = [table.column(c).to_numpy() for c in ("node", "lo", "hi")]
        new = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))
        end = int(new[-1]) + 1 if len(new) else 0
        if end:
            yield from table.slice(0, end).combine_chunks().to_batches()
        held = table.slice(end).combine_chunks().to_batches()
        rows = table.num_rows - end
    if rows:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _nodes(batch: pa.RecordBatch) -> Iterator[tuple[int, int, tuple[int, int, int, int]]]:
    """(first row, end, (tree, length, lo, hi)) of the nodes of a sorted batch."""
    node, lo, hi = (batch.column(c).to_numpy() for c in ("node", "lo", "hi"))
    cuts = np.flatnonzero((node[1:] != node[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
    for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        where = int(node[s]) >> (8 * DEPTH)
        yield s, e, (where & 255, where >> 8, int(lo[s]), int(hi[s]))


def _matrix(column: pa.Array) -> np.ndarray:
    data, at = text_buffers(column)
    return data.reshape(len(column), -1) if len(data) else np.zeros((len(column), 0), np.uint8)


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary column of the bytes of each row, without a Python object for each."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _may_link(threshold: float) -> Callable:
    """The rows of a node that have a candidate in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_node(batches):
            sig, depth, block = _matrix(batch.column("sig")), _matrix(batch.column("depth")), batch.column("block").to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for s, e, node in _nodes(batch):
                for i, j in _candidates(sig[s:e], depth[s:e], block[s:e], node, threshold):
                    keep[s + i] = keep[s + j] = True
            yield batch.filter(pa.array(keep))

    return run


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets; pairs are grouped by their first."""
    key = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets)])
    known, place = np.unique(key, return_inverse=True)
    out = np.zeros(len(i), np.int64)
    mark = np.zeros(len(known) + 1, np.int64)
    order = np.argsort(i, kind="stable")
    heads = np.flatnonzero(np.diff(i[order], prepend=-1))
    for s, e in zip(heads.tolist(), [*heads[1:].tolist(), len(i)], strict=True):
        own = place[at[i[order[s]]] : at[i[order[s]] + 1]]
        mark[own] = 1
        for at_pair in order[s:e].tolist():
            other = j[at_pair]
            out[at_pair] = mark[place[at[other] : at[other + 1]]].sum()
        mark[own] = 0
    return out


def _link(threshold: float) -> Callable:
    """(id, links, root) of the rows of a node with links: copies of the texts they are linked to, and
    the least id they are connected to within the node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_node(batches, 1 << 11):
            sig, depth = _matrix(batch.column("sig")), _matrix(batch.column("depth"))
            block, ids, copies = (batch.column(c).to_numpy() for c in ("block", "id", "copies"))
            data, at = text_buffers(batch.column("shingles"))
            sets = [data[a:b].view(np.uint64) for a, b in zip(at[:-1], at[1:], strict=True)]
            size = np.diff(at) // 8
            links, root = np.zeros(batch.num_rows, np.int64), ids.copy()
            for s, e, node in _nodes(batch):
                joined = []
                for i, j in _candidates(sig[s:e], depth[s:e], block[s:e], node, threshold):
                    small, large = np.minimum(size[s + i], size[s + j]), np.maximum(size[s + i], size[s + j])
                    possible = small >= threshold * large
                    i, j = i[possible], j[possible]
                    if not len(i):
                        continue
                    common = _overlaps(sets[s:e], i, j)
                    good = common >= threshold * (size[s + i] + size[s + j] - common) - 1e-9
                    i, j = s + i[good], s + j[good]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    joined.append((i, j))
                changed = True
                while joined and changed:
                    before = root[s:e].copy()
                    for i, j in joined:
                        least = np.minimum(root[i], root[j])
                        np.minimum.at(root, i, least)
                        np.minimum.at(root, j, least)
                    changed = (root[s:e] != before).any()
            some = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(root[some])], names=["id", "links", "root"])

    return run


# ---- The forest ------------------------------------------------------------------


def _depths(classes: DataFrame, threshold: float) -> DataFrame:
    """(id, depth): one byte for each tree, the length of the prefix that a text asks it with."""

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = paths_of(_matrix(batch.column("sig"))).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("id").to_numpy(), TREES)), pa.array(found)], names=["id", "path"])

    def crowds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= _PATHS:
                yield from searched(held)
                held, n = [], 0
        if n:
            yield from searched(held)

    def searched(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        path = table.column("path").to_numpy().view(np.uint64)
        found = np.minimum(crowds_of(path), np.iinfo(np.int32).max).astype("<i4")
        tree = (path >> np.uint64(8 * DEPTH)).astype(np.int32)
        told = pa.RecordBatch.from_arrays([table.column("id").combine_chunks(), pa.array(tree), _binary(found)], names=["id", "tree", "crowd"])
        for at in range(0, told.num_rows, _ROWS):
            yield told.slice(at, _ROWS)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data = text_buffers(batch.column("crowds").flatten().field("crowd"))[0]
            found = shortened(data.view("<i4").reshape(batch.num_rows, TREES, DEPTH).astype(np.int64), threshold)
            yield pa.RecordBatch.from_arrays([batch.column("id"), _binary(found)], names=["id", "depth"])

    # Paths are numbers below 2**63, so their order is that of the labels.
    sorted_paths = classes.select("id", "sig").mapInArrow(paths, "id bigint, path bigint").repartitionByRange("path", "id").sortWithinPartitions("path", "id")
    told = sorted_paths.mapInArrow(crowds, "id bigint, tree int, crowd binary")
    return told.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("tree", "crowd"))).alias("crowds")).mapInArrow(chosen, "id bigint, depth binary")


def _entries(classes: DataFrame) -> DataFrame:
    """(id, node, asks): each text in the nodes above its paths, at the lengths that any text asks with."""
    byte = F.explode(F.transform(F.sequence(F.lit(1), F.lit(TREES)), lambda i: F.conv(F.hex(F.substring("depth", i, F.lit(1))), 16, 10).cast("int")))
    used = sorted(r[0] for r in classes.select(byte.alias("d")).distinct().collect())  # DEPTH of them at most

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, depth, ids = paths_of(_matrix(batch.column("sig"))), _matrix(batch.column("depth")), batch.column("id").to_numpy()
            for length in used:
                columns = [pa.array(np.repeat(ids, TREES)), pa.array(nodes_of(paths, length).ravel().view(np.int64)), pa.array((depth == length).ravel())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "node", "asks"])

    return classes.select("id", "sig", "depth").mapInArrow(entries, "id bigint, node bigint, asks boolean")


# ---- The join --------------------------------------------------------------------


def _grouped(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, class_id, n_links, first, d1, d2, n) of every row of ``docs`` (doc_id, text).

    ``first``: the row's class of equal sets is the one that names the group.  All that goes to Python is computed
    here, so that its rows, which hold texts and sets, go there in small batches.
    """
    with small_batches(docs.sparkSession):
        return _grouped_at_once(docs, threshold)


def _grouped_at_once(docs: DataFrame, threshold: float) -> DataFrame:
    signed = cut_lineage(_signed(docs))
    key = ["d1", "d2", "n"]
    # Texts with equal sets are copies: one of them stands for all.
    classes = cut_lineage(
        signed.where(F.col("n") > 0)
        .groupBy(*key)
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("sig").alias("sig"))
        .withColumn("id", F.monotonically_increasing_id())
    )

    # With the length of the prefix that each text asks each tree with.
    classes = cut_lineage(classes.join(_depths(classes, threshold), "id"))
    placed = _entries(classes)
    asked = F.sum(F.col("asks").cast("int")).alias("asked")
    shared = placed.groupBy("node").agg(F.count("*").alias("members"), asked).where("members > 1 AND asked > 0").drop("asked")
    blocks = F.ceil(F.col("members") / BLOCK)
    block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    members = (
        placed.join(shared, "node")
        .select("id", "node", block.alias("block"), other.alias("other"))
        .select("id", "node", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    )
    spec = "id bigint, node bigint, block int, lo int, hi int, sig binary, depth binary"
    order = ["node", "lo", "hi"]
    hopeful = cut_lineage(
        members.join(classes.select("id", "sig", "depth"), "id")
        .select("id", "node", "block", "lo", "hi", "sig", "depth")
        .repartition(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_may_link(threshold), spec)
        .drop("sig", "depth")
    )

    # The sets of the texts that may be similar to another one, computed from the text again.
    wanted = classes.join(hopeful.select("id").distinct(), "id", "left_semi")
    same_doc = F.coalesce("doc_id", F.lit(-(1 << 63)))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, at = shingles(*text_buffers(batch.column("text")))
            columns = [pa.array(x) for x in digests(values, at)]
            data = [values[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(data, pa.binary())], names=[*key, "shingles"])

    texts = docs.withColumn("k", same_doc).join(wanted.select(F.coalesce("rep", F.lit(-(1 << 63))).alias("k")).distinct(), "k", "left_semi")
    known = (
        texts.select("text")
        .mapInArrow(sets, "d1 bigint, d2 bigint, n bigint, shingles binary")
        .join(wanted.select(*key, "id", "copies", "sig", "depth"), key)
        .groupBy("id")
        .agg(*[F.first(c).alias(c) for c in ("copies", "sig", "depth", "shingles")])
    )
    found = cut_lineage(
        hopeful.join(known, "id")
        .repartition(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_link(threshold), "id bigint, links bigint, root bigint")
    )
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.where("id <> root").select(F.col("id").alias("src"), F.col("root").alias("dst")).distinct()
    ends = edges.select(F.col("src").alias("station_id")).unionByName(edges.select(F.col("dst").alias("station_id"))).distinct()
    joined = connected_components(cut_lineage(edges), cut_lineage(ends)).select(F.col("station_id").alias("id"), "component")
    told = classes.join(joined, "id", "left").join(links, "id", "left")
    told = cut_lineage(told.select(*key, "rep", "copies", F.coalesce("component", "id").alias("component"), F.coalesce("links", F.lit(0)).alias("links")))
    names = told.groupBy("component").agg(F.min("rep").alias("class_id"), F.min_by(F.struct(*key), F.struct("rep", *key)).alias("named"))
    labels = told.join(names, "component").select(
        *key, "class_id", (F.col("named") == F.struct(*key)).alias("first"), (F.col("links") + F.col("copies") - 1).alias("n_links")
    )
    alone = {"class_id": F.col("doc_id"), "first": F.lit(True), "n_links": F.lit(0).cast("bigint")}
    out = signed.drop("sig").join(labels, key, "left")
    no_words = F.col("n") == 0
    return out.select("doc_id", *[F.when(no_words, v).otherwise(F.col(c)).alias(c) for c, v in alone.items()], *key)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_links) of every document.

    Documents are linked if the Jaccard similarity of their sets of word 5-grams is ``threshold`` or
    more; ``n_links`` counts the other documents linked to this one, copies included, and
    ``class_id`` is the least doc_id of all that are connected by links.  A text of one to four
    words has one shingle.  A null, empty or wordless text is linked to nothing and is its own
    class.  Rows with null or repeated ids are documents of their own; a class of null ids only has
    a null class_id.  Other columns of ``docs`` are not read.

    The similarity of all candidates is exact.  Two texts at the threshold are candidates with a
    probability of at least ``RECALL``, more similar ones more often; equal sets always are copies.
    """
    return _grouped(pick(docs, "doc_id", "text"), threshold).select("doc_id", "class_id", "n_links")


def remove_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class: the one with the least doc_id.

    Ids that are null or occur more than once cannot tell rows apart, so those rows are matched to
    their classes by the digest of their text and numbered; all others are kept or dropped by id.
    """
    return in_plain_names(docs, ("doc_id", "text"), lambda d: _one_of_each(d, threshold))


def _one_of_each(docs: DataFrame, threshold: float) -> DataFrame:
    picked = pick(docs, "doc_id", "text")
    grouped = cut_lineage(_grouped(picked, threshold))
    counted = grouped.groupBy("doc_id").agg(F.count("*").alias("rows"))
    unclear = counted.where("rows > 1 OR doc_id IS NULL").select("doc_id")
    clear = grouped.join(counted.where("rows = 1"), "doc_id")
    # A class keeps its least id, if that id is clear; else one of the rows that are not.
    dropped = clear.where("doc_id <> class_id").select("doc_id")
    kept = docs.join(dropped.unionByName(unclear), "doc_id", "left_anti").where(F.col("doc_id").isNotNull())
    named = unclear.withColumn("u", F.lit(True))
    if unclear.isEmpty():
        return kept.select(*docs.columns)
    own = docs.join(named, docs["doc_id"].eqNullSafe(named["doc_id"]), "left_semi")
    schema = T.StructType([*own.schema.fields, *[T.StructField(c, T.LongType()) for c in ("d1", "d2", "n")]])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = digests(*shingles(*text_buffers(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], names=[*batch.schema.names, "d1", "d2", "n"])

    # One row of the class that names the group, if its least id is not a clear one; wordless rows all stay.
    chosen = grouped.join(clear.where("doc_id = class_id").select("class_id").withColumnRenamed("class_id", "c"), F.col("class_id") == F.col("c"), "left_anti")
    chosen = chosen.where("first AND n > 0").select("d1", "d2", "n").distinct()
    marked = own.mapInArrow(digest, schema)
    one = marked.where("n > 0").join(chosen, ["d1", "d2", "n"]).dropDuplicates(["d1", "d2", "n"])
    return kept.select(*docs.columns).unionByName(one.select(*docs.columns)).unionByName(marked.where("n = 0").select(*docs.columns))
