"""Phrases whose words stand together more often than their parts would by chance, per language.

Toivonen's way of mining: a sample proposes the frequent phrases; one pass over everything counts
them together with their *negative border*, the phrases of which both the first and the last ``k - 1``
words are proposed while they are not.  A phrase of the border that turns out to be frequent is a
border failure: it is proposed too, and an expansion pass counts what entered the border with it.  What
extends a phrase that is counted for the first time is counted in the same pass, since that phrase may
be frequent; so one expansion closes the border, and the counts do not depend on the sample.

The border is never listed.  Proposed phrases are kept as a bit filter of fixed size, and a task counts
what it meets in its texts if both ends pass the filter.  A false answer of the filter makes a task
count more than it has to, and never changes a count.

Most of a border is rare.  So the first pass counts hashes, eight bytes each; what collides only counts
more.  The expansion pass counts those whose hash is frequent by their text, together with the new
border; only its counts are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.columns import pick, slices, text_buffers
from tripweave.llm.words import LOWER, hash_spans, mix, runs
from tripweave.session import cut_lineage, small_side

LONGEST = 5
FREQUENT = 100
KEPT = 2000
UNKNOWN = "und"

SAMPLE_ONE_IN = 8  # pieces of text, by a hash; grows with the corpus and decides nothing but how much the passes count
CAUTION = 0.4  # a phrase is proposed at this share of the count that a frequent one has in the sample on average
FILTER_BITS = 1 << 26
HELD_CODES = 3_000_000  # counts that a task puts together before it hands them on

_ENDS = np.zeros(256, bool)  # ends a piece
_ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BLANK = _ENDS.copy()  # is no part of a word
_BLANK[[0x20, 0x09]] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)
_COUNTS = "lang string, phrase string, n bigint"
_CODES = "code bigint, n bigint"
_LEVEL = np.uint64(7)  # the last bits of a code are the number of words


@dataclass(frozen=True)
class Filter:
    """A set of 64-bit hashes; two bits each.  May hold a hash that was never added."""

    bits: np.ndarray

    @staticmethod
    def places(hashes: np.ndarray, size: int) -> np.ndarray:
        other = mix(hashes ^ _STEP)
        return np.concatenate([hashes, other]) % np.uint64(size)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = self.places(hashes, 8 * len(self.bits))
        found = (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
        return (found[: len(hashes)] & found[len(hashes) :]).astype(bool)


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word; words are not empty."""
    data, offsets = text_buffers(words)
    return hash_spans(data, offsets[:-1], offsets[1:])


def _salts(langs: pa.Array) -> np.ndarray:
    """A hash of each language, whose name may be empty."""
    return _hashes(pc.binary_join_element_wise("l", langs.cast(pa.string()), ""))


def _joined(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all but its last word and that of the last word."""
    return mix(head * _STEP + word)


@dataclass
class _Slice:
    """The words of some texts: codes into ``distinct``, and whether the next word is in the same piece."""

    distinct: pa.Array
    codes: np.ndarray
    text: np.ndarray
    link: np.ndarray

    @staticmethod
    def of(texts: pa.Array, salts: np.ndarray | None = None, one_in: int = 1) -> _Slice:
        """All words, or those of one in so many pieces, drawn by the salt of the text and their number."""
        data, offsets = text_buffers(texts)
        data = LOWER[data]
        starts, ends = runs(~_BLANK[data], offsets)
        text = np.searchsorted(offsets, starts, "right") - 1
        cuts = np.flatnonzero(_ENDS[data])
        piece = np.searchsorted(cuts, starts)
        if one_in > 1:
            number = piece - np.searchsorted(cuts, offsets[:-1])[text]
            drawn = mix(salts[text] + number.astype(np.uint64) * _STEP) % np.uint64(one_in) == 0
            starts, ends, text, piece = starts[drawn], ends[drawn], text[drawn], piece[drawn]
        lengths = ends - starts
        heads = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(heads[-1]) + np.repeat(starts - heads[:-1], lengths)
        buffers = [None, pa.py_buffer(heads.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[place]))]
        encoded = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
        link = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
        return _Slice(encoded.dictionary, encoded.indices.to_numpy().astype(np.int64), text, link)

    def phrases(self, at: np.ndarray, k: int) -> pa.Array:
        words = [self.distinct.take(pa.array(self.codes[at + j])) for j in range(k)]
        return (pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if k > 1 else words[0]).cast(pa.string())


@dataclass
class _Level:
    """The different phrases of ``k`` words that a slice holds: their hashes and counts, their two ends as
    places in the level before, where one of each begins, and which of them begins at each word (or -1)."""

    k: int
    hashes: np.ndarray
    n: np.ndarray
    head: np.ndarray
    tail: np.ndarray
    first: np.ndarray
    at: np.ndarray

    @property
    def codes(self) -> np.ndarray:
        return (self.hashes & ~_LEVEL) | np.uint64(self.k)


def _levels(cut: _Slice, lang: np.ndarray, salts: np.ndarray, longest: int) -> Iterator[_Level]:
    """Level by level; whoever takes one may set places of ``at`` to -1, which ends phrases there."""
    size = len(cut.distinct)
    each, first, ids, n = np.unique(lang * size + cut.codes, return_index=True, return_inverse=True, return_counts=True)
    words = mix(_hashes(cut.distinct)[each % size] ^ salts[each // size])
    none, word_ids = np.zeros(0, np.int64), ids.copy()
    level = _Level(1, words, n, none, none, first, ids)
    yield level
    for k in range(2, longest + 1):
        ids, size = level.at, len(level.hashes)
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0) & cut.link)
        if not len(at):
            return
        each, first, inverse, n = np.unique(ids[at] * size + ids[at + 1], return_index=True, return_inverse=True, return_counts=True)
        head, first = each // size, at[first]
        ids = np.full(len(ids), -1)
        ids[at] = inverse
        level = _Level(k, _joined(level.hashes[head], words[word_ids[first + k - 1]]), n, head, each % size, first, ids)
        yield level


def _stopped(level: _Level, alive: np.ndarray) -> None:
    """Only phrases that are alive go on."""
    level.at[(level.at >= 0) & ~alive[level.at]] = -1


def count_codes(
    texts: pa.Array, langs: pa.Array, salts: np.ndarray | None, one_in: int, levels: range, known: int, wanted: Filter | None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, counts) of the phrases of ``levels`` words of which both ends are in ``wanted``.

    ``wanted`` knows phrases of up to ``known`` words.  Of longer ones all shorter parts have to pass.
    """
    cut = _Slice.of(texts, salts, one_in)
    if not len(cut.codes):
        return
    encoded = langs.dictionary_encode()
    lang = encoded.indices.to_numpy().astype(np.int64)[cut.text]
    for level in _levels(cut, lang, _salts(encoded.dictionary), levels.stop - 1):
        if level.k in levels:
            yield level.codes, level.n.astype(np.int64)
        if level.k <= known:
            _stopped(level, wanted.has(level.codes))


def count_phrases(
    texts: pa.Array, langs: pa.Array, longest: int, counted: Filter, frequent: Filter
) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) of the phrases in ``frequent``, and of those whose ends are alive and were not
    both in ``counted``; and (lang, null, number of words).

    Alive is what is in ``counted`` or ``frequent``, and what was not counted before.
    """
    cut = _Slice.of(texts)
    if not len(cut.codes):
        return
    encoded = langs.dictionary_encode()
    names, lang = encoded.dictionary.cast(pa.string()), encoded.indices.to_numpy().astype(np.int64)[cut.text]

    def counts(of: np.ndarray, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([names.take(pa.array(of)), phrases, pa.array(n.astype(np.int64))], names=["lang", "phrase", "n"])

    total = np.bincount(lang, minlength=len(names))
    yield counts(np.flatnonzero(total), pa.nulls(int((total > 0).sum()), pa.string()), total[total > 0])
    old = np.zeros(0, bool)
    for level in _levels(cut, lang, _salts(names), longest):
        codes = level.codes
        # Single words have no ends: all of them were counted first.
        new = ~(old[level.head] & old[level.tail]) if level.k > 1 else np.zeros(len(codes), bool)
        often = frequent.has(codes)
        asked = new | often
        if asked.any():
            first = level.first[asked]
            yield counts(lang[first], cut.phrases(first, level.k), level.n[asked])
        old = counted.has(codes)
        _stopped(level, old | asked)


def _added_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One row for each code, with its counts added."""
    codes, n = (np.concatenate(columns) for columns in zip(*parts, strict=True))
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return pa.record_batch([pa.array(codes[starts].view(np.int64)), pa.array(np.add.reduceat(n, starts))], names=["code", "n"])


def _count_codes(docs: DataFrame, one_in: int, levels: range, known: int, wanted: Filter | None) -> DataFrame:
    """Counts of one pass over ``docs`` (lang, text, salt) by code."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for batch in slices(batches):
            salts = batch.column("salt").to_numpy().view(np.uint64)
            for codes, n in count_codes(batch.column("text"), batch.column("lang"), salts, one_in, levels, known, sent.value):
                held.append((codes, n))
                n_held += len(codes)
            if n_held >= HELD_CODES:
                yield _added_up(held)
                held, n_held = [], 0
        if n_held:
            yield _added_up(held)

    return docs.mapInArrow(run, _CODES).groupBy("code").agg(F.sum("n").alias("n"))


def _count_phrases(docs: DataFrame, longest: int, counted: Filter, frequent: Filter) -> DataFrame:
    """Counts of one pass over ``docs`` by text."""
    sent = docs.sparkSession.sparkContext.broadcast((counted, frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield from count_phrases(batch.column("text"), batch.column("lang"), longest, *sent.value)

    return docs.select("lang", "text").mapInArrow(run, _COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _with(codes: DataFrame, base: Filter | None, bits: int) -> Filter:
    """``base`` and some codes: the bits are set in tasks, and their words combined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places = np.unique(Filter.places(batch.column("code").to_numpy().view(np.uint64), bits))
            cell = places >> np.uint64(6)
            starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            held = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), starts)
            yield pa.record_batch([pa.array(cell[starts].astype(np.int64)), pa.array(held.view(np.int64))], names=["cell", "held"])

    cells = codes.select("code").mapInArrow(run, "cell bigint, held bigint")
    # At most one row for each 64 bits of the filter.
    table = cells.groupBy("cell").agg(F.bit_or("held").alias("held")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[table["cell"].to_numpy()] = table["held"].to_numpy().view(np.uint64)
    if base is not None:
        out |= base.bits.view(np.uint64)
    return Filter(out.view(np.uint8))


def _proposed(docs: DataFrame, one_in: int, least: int, longest: int, bits: int) -> Filter:
    """What is frequent in the sample: words, then pairs of those, then phrases of which all pairs are."""
    wanted = Filter(np.zeros(bits // 8, np.uint8))
    for known, levels in enumerate([range(1, 2), range(2, 3), range(3, longest + 1)]):
        if levels.start <= longest:
            counts = _count_codes(docs, one_in, levels, known, wanted)
            wanted = _with(counts.where(F.col("n") >= least), wanted, bits)
    return wanted


def frequent_phrases(
    docs: DataFrame,
    least: int = FREQUENT,
    longest: int = LONGEST,
    one_in: int = SAMPLE_ONE_IN,
    caution: float = CAUTION,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, phrase, n) of all phrases of up to ``longest`` words that occur ``least`` times or more in
    their language, with one row (lang, null, number of words) for each language.

    The result does not depend on ``one_in``, ``caution`` or ``bits``.
    """
    docs = pick(docs, "doc_id", "lang", "text").where("text IS NOT NULL AND text != ''")
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text", F.xxhash64("doc_id").alias("salt"))
    wanted = _proposed(docs, one_in, max(2, int(least * caution / one_in)), longest, bits)
    counts = _count_codes(docs, 1, range(1, longest + 1), longest, wanted)
    frequent = _with(counts.where(F.col("n") >= least), None, bits)
    found = _count_phrases(docs, longest, wanted, frequent)
    return cut_lineage(found.where((F.col("n") >= least) | F.col("phrase").isNull()))


def _scored(found: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of each phrase of two words or more, by its lowest-scoring cut."""
    words = F.split("phrase", " ")
    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    counts = found.where(F.col("phrase").isNotNull())
    totals, _n = small_side(found.where(F.col("phrase").isNull()).select(F.col("lang").alias("of"), F.col("n").alias("total")))
    cuts = (
        counts.where(F.size(words) > 1)
        .select("lang", "phrase", F.col("n").alias("a"), words.alias("w"))
        .select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
        .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    )
    sides = lambda name, n: counts.select(F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(name), F.col("n").alias(n))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    both = cuts
    for name, n in (("left", "l"), ("right", "r")):
        other = sides(name, n).withColumnRenamed(name, f"{name}_part")
        both = both.join(other, (F.col("lang") == F.col(f"{name}_lang")) & (F.col(name) == F.col(f"{name}_part")))
    both = both.join(totals, F.col("lang") == F.col("of")).withColumnsRenamed({"total": "n"})
    both = both.withColumns({"above": F.lit(1000).cast("decimal(38,0)") * wide("a") * wide("n"), "below": wide("l") * wide("r")})
    best = both.groupBy("lang", "phrase").agg(
        F.any_value("a").alias("a"), F.any_value("n").alias("n"), F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("b")
    )
    return best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")


def _kept(scored: DataFrame, found: DataFrame) -> DataFrame:
    """Without phrases that stand inside a longer one as often.

    If a longer phrase has the same count, so has the one between them with one word more; so it is
    enough to look at phrases with one word more at either end.
    """
    w = F.split("phrase", " ")
    ends = F.array(*[F.array_join(F.slice(w, start, F.size(w) - 1), " ") for start in (1, 2)])
    longer = found.where(F.col("phrase").isNotNull() & (F.size(w) > 2)).select("lang", "n", F.explode(ends).alias("inside"))
    longer = longer.groupBy(F.col("lang").alias("in_lang"), "inside").agg(F.max("n").alias("most"))
    on = (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inside")) & (F.col("most") >= F.col("a"))
    return scored.join(longer, on, "left_anti")


def collocations(docs: DataFrame, kept: int = KEPT, **mining) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``kept`` phrases of each language.

    A null or empty text has no words and a null language is ``und``.  Repeated rows count each.
    Other columns are not read.  ``mining`` goes to :func:`frequent_phrases`.
    """
    found = frequent_phrases(docs, **mining)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The first of each part of a language, then the first of those, so that no task orders a whole language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = _kept(_scored(found), found).withColumn("part", part)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= kept)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= kept)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
