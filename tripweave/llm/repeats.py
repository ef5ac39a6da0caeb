"""Passages of 100 bytes or more that occurred before: found by run-length indexes of buckets of text.

All 100-byte windows of all texts would be too many rows.  Every window is instead filed
under the least hash among its 32-byte grams, so equal windows are filed alike.  Neighbouring
windows filed under one gram form a context of at most 168 bytes; a context is one row of
two hashes.  Contexts that are equal in whole are settled by their hashes.  Only contexts
that share the gram but differ, as at the ends of passages and around edits, need their
text.  These meet in buckets, and each bucket gets a run-length index: the Burrows-Wheeler
transform, compressed to its runs, with text positions and common prefix lengths sampled
where runs begin.  Between samples the matching statistics of a text follow by counting
down, so they are streamed in text order; matches of 100 bytes or more are marked.

Texts are never shuffled.  Marks go back to the partition that their text was read in, and
the texts are read again there; so the input has to give the same partitions each time, as
files do.  If it does not, the marks do not fit and the job fails.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.columns import pick, slices, text_buffers
from tripweave.llm.words import mix, powers
from tripweave.session import cut_lineage, fresh_folder
from tripweave.sources.tables import read_table, write_table

WINDOW = 100
GRAM = 32
_GRAMS = WINDOW - GRAM + 1  # grams of a window

# Bytes of a very long text that are hashed at a time.
SEGMENT = 1 << 22
# Contexts under one gram that are indexed together; more of them are compared window by window, spread by hash.
BUCKET_CONTEXTS = 20_000
# Bytes of contexts in one index, unless one gram has more.
INDEX_BYTES = 1 << 20

_ROW_BITS = 40  # of a row number below its partition
_WIDTH_BITS = 16  # of the number of windows below their start
_DONE = 1 << 15  # set in that number: already known to be repeated
_PLACE = np.uint64((1 << 24) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = np.random.default_rng(0xBEE).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_NO_ID = -(1 << 63)
_CONTEXT = T.StructType([T.StructField(c, T.LongType()) for c in ("m", "c", "doc", "row", "span")])
_SORTED = ["m", "c", "doc", "row", "span"]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = powers(_BASE, size), powers(_BACK, size)
    return _POWERS[size]


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * _power_tables(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def _range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    back = _power_tables(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * back[start] ^ (end - start).astype(np.uint64))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM bytes (a power of two), by doubling."""
    h = _VALUES[data]
    size = 1
    while size < GRAM:
        h = h[: len(h) - size] * _BASE + mix(h[size:])
        size *= 2
    return mix(h)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def contexts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gram hash, context hash, text number, start in the text, windows) of all contexts.

    A window belongs to the leftmost of its least grams, so no two windows of a context are equal.
    Texts shorter than a window have none.
    """
    if len(data) < WINDOW:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    grams = _gram_hashes(data)
    # The order of grams is their upper 40 bits, the same in every slice; then the place.
    packed = (grams & ~_PLACE) | (np.arange(len(grams), dtype=np.uint64) & _PLACE)
    place = (_sliding_least(packed, _GRAMS) & _PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(place)]
    whole = np.arange(len(place)) + WINDOW <= offsets[text + 1]
    new = whole.copy()
    new[1:] &= (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
    start = np.flatnonzero(new)
    last = whole.copy()
    last[:-1] &= new[1:] | ~whole[1:]
    end = np.flatnonzero(last) + 1
    c = _range_hashes(_prefix_sums(data), start, end + WINDOW - 1)
    return grams[place[start]], c, text[start], start - offsets[text[start]], end - start


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, offsets, first text, first byte) of the slice, or of parts of its one long text."""
    if len(offsets) > 2 or len(data) <= SEGMENT:
        yield data, offsets, 0, 0
        return
    for at in range(0, len(data), SEGMENT):
        part = data[at : at + SEGMENT + WINDOW - 1]
        yield part, np.array([0, len(part)]), 0, at


def _doc_ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _spans(start: np.ndarray, width: np.ndarray) -> np.ndarray:
    return (start << _WIDTH_BITS) | width


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices with the numbers of their rows: partition and place in it."""
    at = TaskContext.get().partitionId() << _ROW_BITS
    for batch in slices(batches):
        yield batch, np.arange(at, at + batch.num_rows)
        at += batch.num_rows


def _rows(columns: list[np.ndarray], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names=schema.names)


def _once_each(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Contexts equal in whole keep their first place under the gram.  The others are repeated for
    certain; they only travel on to be marked, under a hash of their place, so they crowd nowhere."""
    m, c, doc, row, span = columns
    order = np.lexsort((span, row, doc, c, m))
    m, c, doc, row, span = (x[order] for x in columns)
    known = np.zeros(len(m), bool)
    known[1:] = (m[1:] == m[:-1]) & (c[1:] == c[:-1])
    m, span = m.copy(), span.copy()
    m[known] = mix((row[known] * 1_000_003 + span[known]).astype(np.uint64)).view(m.dtype)
    span[known] |= _DONE
    return [m, c, doc, row, span]


def _find_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[list[np.ndarray]] = []
    n = 0
    for batch, numbers in _numbered(batches):
        doc = _doc_ids(batch)
        for data, offsets, _, base in _segments(*text_buffers(batch.column("text"))):
            m, c, text, start, width = contexts(data, offsets)
            held.append([m.view(np.int64), c.view(np.int64), doc[text], numbers[text], _spans(start + base, width)])
            n += len(m)
        if n >= 200_000:
            yield _rows(_once_each([np.concatenate(x) for x in zip(*held, strict=True)]), _CONTEXT)
            held, n = [], 0
    if n:
        yield _rows(_once_each([np.concatenate(x) for x in zip(*held, strict=True)]), _CONTEXT)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted contexts: ``c`` 0 for the repeated ones, 1 for those that need their text.

    Rows stream by; what is held between batches is one row.
    """
    waiting = None  # the first context of the current gram, as long as it is the only one
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy() for n in _CONTEXT.names]
        m, c, doc, row, span = columns
        done = (span & _DONE) > 0
        same_m, same_c = np.zeros(len(m), bool), np.zeros(len(m), bool)
        same_m[1:] = m[1:] == m[:-1]
        same_c[1:] = same_m[1:] & (c[1:] == c[:-1])
        if last is not None:
            same_m[0] = m[0] == last[0]
            same_c[0] = same_m[0] and c[0] == last[1]
        last = (m[-1], c[-1])
        repeated = same_c | done
        firsts = np.flatnonzero(~repeated)
        if waiting is not None:
            columns = [np.concatenate([[w], x]) for w, x in zip(waiting, columns, strict=True)]
            m, c, doc, row, span = columns
            same_m = np.concatenate([[False], same_m])
            repeated = np.concatenate([[False], repeated])
            firsts = np.concatenate([[0], firsts + 1])
        follows = same_m[firsts]
        needs = follows.copy()
        needs[:-1] |= follows[1:]
        waiting = None
        if len(firsts) and not needs[-1]:
            waiting = [x[firsts[-1]] for x in columns]
        needed = firsts[needs]
        out = np.concatenate([np.flatnonzero(repeated), needed])
        kind = np.concatenate([np.zeros(len(out) - len(needed), np.int64), np.ones(len(needed), np.int64)])
        yield _rows([m[out], kind, doc[out], row[out], span[out] & ~_DONE], _CONTEXT)


# ---- The run-length index -----------------------------------------------------------


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of the suffixes of ``symbols`` (1 to 256, 0 between texts), by prefix doubling."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(8, np.uint64)])
    key = np.zeros(n, np.uint64)
    for j in range(7):  # nine bits each
        key = (key << np.uint64(9)) | padded[j : j + n]
    depth = 7
    order = np.argsort(key, kind="stable")
    while True:
        rank = np.zeros(n, np.uint64)
        sorted_key = key[order]
        rank[order[1:]] = np.cumsum(sorted_key[1:] != sorted_key[:-1]).astype(np.uint64)
        if n == 0 or int(rank[order[-1]]) == n - 1:
            return order
        behind = np.zeros(n, np.uint64)
        behind[: n - depth] = rank[depth:] + np.uint64(1) if n > depth else 0
        key = (rank << np.uint64(32)) | behind
        order = np.argsort(key, kind="stable")
        depth *= 2


def _common(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at ``a`` and ``b``, up to ``most``."""
    padded = np.concatenate([symbols, np.zeros(most, symbols.dtype)])
    out, alive = np.zeros(len(a), np.int64), np.arange(len(a))
    step = 16
    for at in range(0, most, step):
        width = min(step, most - at)
        places = at + np.arange(width)
        same = padded[a[alive, None] + places] == padded[b[alive, None] + places]
        run = np.where(same.all(1), width, same.argmin(1))
        out[alive] += run
        alive = alive[run == width]
        if not len(alive):
            break
    return out


class RunLengthIndex:
    """The Burrows-Wheeler transform of some texts as runs, with samples where runs begin.

    For the position p that the first row of a run stands for, ``before`` is the position of the row
    above and ``common`` how long a prefix they share.  Inside a run the row above moves in step
    with the text, so at any position these follow from the last sample before it.
    """

    def __init__(self, symbols: np.ndarray):
        order = suffix_array(symbols)
        last = symbols[order - 1]  # order 0 gives the final symbol
        head = np.ones(len(order), bool)
        head[1:] = (last[1:] != last[:-1]) | (last[1:] == 0)
        # The first suffix of the text has nothing before it to move in step with.
        head |= order == 0
        after = np.flatnonzero(order[:-1] == 0) + 1
        head[after] = True
        rows = np.flatnonzero(head)
        self.run_symbols, self.run_lengths = last[rows], np.diff(np.append(rows, len(order)))
        at = order[rows]
        above = np.where(rows > 0, order[rows - 1], -1)
        common = np.zeros(len(rows), np.int64)
        some = np.flatnonzero(rows > 0)
        common[some] = _common(symbols, at[some], above[some], 4 * WINDOW)
        by_place = np.argsort(at)
        self.place, self.before, self.common = at[by_place], above[by_place], common[by_place]

    def matching_statistics(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(position of the nearest suffix above, length of the match) of positions 0 to n - 1, in text order."""
        places = np.arange(n)
        sample = np.searchsorted(self.place, places, "right") - 1
        away = places - self.place[sample]
        return self.before[sample] + away, np.maximum(self.common[sample] - away, 0)


def repeated_windows(texts: list[bytes]) -> list[np.ndarray]:
    """For each text, whether the window at each of its starts also starts earlier: in an earlier text, or before in its own."""
    size = np.array([len(t) for t in texts], np.int64)
    at = np.cumsum(size + 1) - (size + 1)
    symbols = np.zeros(int((size + 1).sum()), np.uint16)
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    symbols[:] = data
    symbols += 1
    symbols[at + size] = 0
    above, length = RunLengthIndex(symbols).matching_statistics(len(symbols))
    # Follow the matches to one window of each kind, and take the first of the kind in the texts.
    root = np.where(length >= WINDOW, above, np.arange(len(symbols)))
    while (root != (further := root[root])).any():
        root = further
    first = np.arange(len(symbols))
    np.minimum.at(first, root, np.arange(len(symbols)))
    marked = first[root] < np.arange(len(symbols))
    return [marked[a : a + max(0, n - WINDOW + 1)] for a, n in zip(at.tolist(), size.tolist(), strict=True)]


_TEXT = T.StructType([*[f for f in _CONTEXT.fields if f.name != "c"], T.StructField("text", T.BinaryType())])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks (c = 0) of contexts sorted by (m, doc, row, span): one index for the contexts of some grams."""

    def judged(held: pa.Table) -> pa.RecordBatch:
        m, doc, row, span = (held.column(n).to_numpy() for n in ("m", "doc", "row", "span"))
        which, starts, widths = [], [], []
        for k, marked in enumerate(repeated_windows(held.column("text").to_pylist())):
            edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
            s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            which.append(np.full(len(s), k))
            starts.append((span[k] >> _WIDTH_BITS) + s)
            widths.append(e - s)
        k = np.concatenate(which)
        return _rows([m[k], np.zeros(len(k), np.int64), doc[k], row[k], _spans(np.concatenate(starts), np.concatenate(widths))], _CONTEXT)

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column("text").nbytes
        if size < INDEX_BYTES:
            continue
        table = pa.Table.from_batches(held)
        m = table.column("m").to_numpy()
        last = int(np.searchsorted(m, m[-1]))  # where the gram begins that may go on
        if last:
            yield judged(table.slice(0, last))
        held = table.slice(last).to_batches()
        size = sum(b.column("text").nbytes for b in held) if last else 0
    if held and sum(b.num_rows for b in held):
        yield judged(pa.Table.from_batches(held))


# ---- Bringing rows back to the partition of their text ---------------------------------


def _by_partition(rows: DataFrame, folder: str) -> str:
    """Store rows below ``folder`` by the partition of their text, and give the folder."""
    part = F.shiftright("row", _ROW_BITS).cast("int")
    write_table(rows.withColumn("part", part).repartition("part"), folder, partition_by=["part"])
    return folder


def _of_partition(folder: str, columns: list[str]) -> list[np.ndarray]:
    """The stored rows of the partition of this task, sorted by row and span."""
    system, path = fs.FileSystem.from_uri(f"{folder}/part={TaskContext.get().partitionId()}")
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    files = [f.path for f in found if f.path.endswith(".parquet")]
    tables = [pq.ParquetFile(system.open_input_file(f)).read(columns) for f in files]
    got = [np.concatenate([t.column(c).to_numpy() for t in tables]) if tables else np.zeros(0, np.int64) for c in columns]
    order = np.lexsort((got[columns.index("span")], got[columns.index("row")]))
    return [x[order] for x in got]


def _same_documents(doc: np.ndarray, expected: np.ndarray) -> None:
    if (doc != expected).any():
        raise RuntimeError("the input came in other partitions than before; store it first")


def _fetch(folder: str, each_window: bool) -> Callable:
    """The texts of the stored contexts of this partition; or all their windows, as contexts of one window each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, doc, row, span = _of_partition(folder, ["m", "doc", "row", "span"])
        for batch, numbers in _numbered(batches):
            a, b = np.searchsorted(row, [numbers[0], numbers[-1] + 1])
            if a == b:
                continue
            data, offsets = text_buffers(batch.column("text"))
            text = row[a:b] - numbers[0]
            _same_documents(_doc_ids(batch)[text], doc[a:b])
            start, width = span[a:b] >> _WIDTH_BITS, span[a:b] & (_DONE - 1)
            if each_window:
                which = np.repeat(np.arange(b - a), width)
                s = start[which] + np.arange(len(which)) - np.repeat(np.cumsum(width) - width, width)
                at = offsets[text[which]] + s
                grams = _gram_hashes(data)
                full = _range_hashes(_prefix_sums(data), at, at + WINDOW)
                other = mix(grams[at] + mix(grams[at + GRAM] + mix(grams[at + 2 * GRAM] + mix(grams[at + WINDOW - GRAM]))))
                yield _rows(_once_each([full.view(np.int64), other.view(np.int64), doc[a:b][which], row[a:b][which], _spans(s, np.ones_like(s))]), _CONTEXT)
            else:
                at = (offsets[text] + start).tolist()
                raw = data.tobytes()
                texts = [raw[s : s + w + WINDOW - 1] for s, w in zip(at, width.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*[pa.array(x[a:b]) for x in (m, doc, row, span)], pa.array(texts, pa.binary())], names=_TEXT.names)

    return run


def _settled(found: DataFrame, folder: str) -> DataFrame:
    """Repeated contexts and those that need their text, stored once."""
    sorted_rows = found.repartition("m").sortWithinPartitions(*_SORTED)
    write_table(sorted_rows.mapInArrow(_settle, _CONTEXT), folder)
    return read_table(found.sparkSession, folder, _CONTEXT)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(m, c, doc, row, span) marks: windows of ``docs`` (doc_id, text) that also start earlier."""
    folder = fresh_folder(docs.sparkSession, "repeats")
    settled = _settled(docs.mapInArrow(_find_contexts, _CONTEXT), f"{folder}/contexts")
    needed = settled.where("c = 1")
    crowded = cut_lineage(needed.groupBy("m").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_CONTEXTS).select("m"))
    indexed = _by_partition(needed.join(crowded, "m", "left_anti"), f"{folder}/indexed")
    texts = docs.mapInArrow(_fetch(indexed, False), _TEXT)
    order = ["m", "doc", "row", "span"]
    marks = settled.where("c = 0").unionByName(texts.repartition("m").sortWithinPartitions(*order).mapInArrow(_index, _CONTEXT))
    if not crowded.isEmpty():
        windows = _by_partition(needed.join(crowded, "m", "left_semi"), f"{folder}/crowded")
        found = docs.mapInArrow(_fetch(windows, True), _CONTEXT)
        marks = marks.unionByName(_settled(found, f"{folder}/windows").where("c = 0"))
    return marks


def _covered(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the union of [start, end) in each text; rows sorted by text and start."""
    if not len(text):
        return text, start, end
    # Texts are laid out one after the other, so far apart that their runs cannot touch.
    gap = int(end.max()) + 2
    s, e = text * gap + start, text * gap + end
    reach = np.maximum.accumulate(e)
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(s)) - 1
    return text[heads], s[heads] - text[heads] * gap, reach[tails] - text[heads] * gap


def remove_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) without every byte that lies in a 100-byte string that also starts earlier:
    in a row with a smaller doc_id, or in the same row at an earlier start.

    Gives (doc_id, n_bytes, n_removed, n_spans, kept), ``kept`` being the remaining bytes, or with
    ``digest`` kept_sha256 in its place.  Strings are judged on the input, overlaps count, matches do
    not cross documents.  A null text is empty; texts of less than 100 bytes are kept whole.  Null ids
    come before all others; rows with equal ids count in the order in which they are read.  Other
    columns of ``docs`` are not read.
    """
    docs = pick(docs, "doc_id", "text")
    folder = _by_partition(repeated_spans(docs), fresh_folder(docs.sparkSession, "marks"))
    last = T.StructField("kept_sha256", T.StringType()) if digest else T.StructField("kept", T.BinaryType())
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")], last])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, row, span = _of_partition(folder, ["doc", "row", "span"])
        for batch, numbers in _numbered(batches):
            data, offsets = text_buffers(batch.column("text"))
            a, b = np.searchsorted(row, [numbers[0], numbers[-1] + 1])
            text = row[a:b] - numbers[0]
            _same_documents(_doc_ids(batch)[text], doc[a:b])
            start = span[a:b] >> _WIDTH_BITS
            text, start, end = _covered(text, start, start + (span[a:b] & (_DONE - 1)) + WINDOW - 1)
            removed = np.bincount(text, end - start, batch.num_rows).astype(np.int64)
            spans = np.bincount(text, minlength=batch.num_rows)
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, offsets[text] + start, 1)
            np.add.at(edge, offsets[text] + end, -1)
            stays = np.cumsum(edge) == 0
            kept = data[stays[:-1]].tobytes()
            ends = np.cumsum(np.diff(offsets) - removed)
            parts = [kept[s:e] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            told = [hashlib.sha256(p).hexdigest() for p in parts] if digest else pa.array(parts, pa.binary())
            columns = [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (np.diff(offsets), removed, spans)], pa.array(told)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(cut, schema)
