"""Byte-level BPE by recursive SQL inside each task.

Each different word (match of the split pattern) of a task becomes rows of (word, place,
token).  A recursive query joins neighbouring tokens to the merge table, contracts the
leftmost pair of least rank of every word, and goes on until no pair of a word can merge.
An ordered aggregation over the vocabulary turns ids back into bytes.

A long word is contracted in blocks, which are joined pair by pair: the last tokens of one and the
first of the next are contracted anew, a few more of them each time until the outermost two come out as
they were.  Then merging leaves every two neighbours of the result as they are, when it is given these two
alone; and a first merge across some boundary of the whole word would also be the first one across
that boundary between its two neighbours alone.  So the result is what merging makes of the whole word.

DuckDB runs inside the Python worker, on one thread, in memory, on bounded batches of
words; Spark partitions the texts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripweave.llm.chunks import Memory, Pieces, encode_by_chunks, encoded
from tripweave.llm.columns import pick, slices

# Bytes of words in one recursive query.
BATCH_BYTES = 400_000
# Bytes of words and their ids that a task remembers, and of text that it encodes at once.
REMEMBERED_BYTES = 160 << 20
SLICE = 4 << 20
# Words with more bytes are cut into blocks of so many.
SHORT = 64
# What has more bytes than this, which happens where blocks do not fit together, contracts all places of its least pair.
LONGEST = 1000
JOINED_TOKENS = 4

_PLACED = """
  SELECT word, pos, tok, nxt, rank::BIGINT * 1048576 + pos * 1024 + nxt AS pair FROM (
    SELECT s.*, m.rank FROM (
      SELECT word, pos, tok, lead(tok) OVER w AS right_tok, lead(pos) OVER w AS nxt
      FROM ({tokens}) WINDOW w AS (PARTITION BY word ORDER BY pos)) s
    LEFT JOIN merges m ON m.l = s.tok AND m.r = s.right_tok)
"""

# Every state has, for each word, its least pair: rank, left place and right place in one number.
_LEAST = """(
  WITH placed AS MATERIALIZED ({placed})
  SELECT placed.*, l.least FROM placed JOIN (SELECT word, min(pair) AS least FROM placed GROUP BY word) l USING (word))
"""

_CONTRACT = f"""
WITH RECURSIVE state AS (
  {_LEAST.format(placed=_PLACED.format(tokens="SELECT word, pos, tok FROM start"))}
  UNION ALL
  {_LEAST.format(placed=_PLACED.format(tokens='''
    SELECT word, pos, CASE WHEN pair = least THEN (least // 1048576)::INT ELSE tok END AS tok
    FROM state WHERE least IS NOT NULL AND pos <> least % 1024'''))}
)
SELECT word, pos, tok FROM state WHERE least IS NULL ORDER BY word, pos
"""

# For long words where blocks cannot be joined: all places of the least pair that do not overlap, from the left, if its token is
# "safe": no pair with it as a part has a lower rank, so contracting one place cannot make a pair
# that would have to come before the others.  Else the leftmost place only.
_RANKED = """
  SELECT *, min(rank) OVER (PARTITION BY word) AS least FROM (
    SELECT s.*, m.rank FROM (
      SELECT word, pos, tok, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS right_tok,
             row_number() OVER (PARTITION BY word ORDER BY pos) AS n
      FROM ({tokens})) s
    LEFT JOIN merges m ON m.l = s.tok AND m.r = s.right_tok)
"""

_CONTRACT_LONG = f"""
WITH RECURSIVE state AS (
  {_RANKED.format(tokens="SELECT word, pos, tok FROM start")}
  UNION ALL
  {_RANKED.format(tokens='''
    SELECT word, pos, CASE WHEN taken THEN least ELSE tok END AS tok FROM (
      SELECT *, coalesce(lag(taken) OVER (PARTITION BY word ORDER BY pos), false) AS gone FROM (
        SELECT i.*, coalesce(rank = least AND (CASE WHEN u.tok IS NULL
                 THEN row_number() OVER (PARTITION BY word, rank = least, n - k ORDER BY pos) % 2 = 1
                 ELSE k = 1 END), false) AS taken
        FROM (SELECT *, count(*) FILTER (rank = least) OVER (PARTITION BY word ORDER BY pos) AS k
              FROM state WHERE least IS NOT NULL) i
        LEFT JOIN unsafe u ON u.tok = i.least))
    WHERE NOT gone''')}
)
SELECT word, pos, tok FROM state WHERE least IS NULL ORDER BY word, pos
"""

_DECODE = """
SELECT word, string_agg(v.hex, '' ORDER BY pos) AS hex FROM ids JOIN vocabulary v ON v.tok = ids.tok GROUP BY word ORDER BY word
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """token -> rank of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class WordCoder:
    """Encodes and decodes words with the ranks of one file."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        pairs, unsafe = [], set()
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left, right, rank))
                    unsafe.update(part for part in (left, right) if part > rank)
        self._table("merges", l=[p[0] for p in pairs], r=[p[1] for p in pairs], rank=[p[2] for p in pairs])
        self._table("unsafe", tok=sorted(unsafe))
        self.texts = {rank: token for token, rank in self.ranks.items()}
        given = pa.table({"tok": pa.array(list(self.ranks.values()), pa.int32()), "hex": [t.hex() for t in self.ranks]})
        self._take("vocabulary", given)

    def _take(self, name: str, given: pa.Table) -> None:
        self.con.register("given", given)
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _table(self, name: str, **columns) -> None:
        self._take(name, pa.table({k: pa.array(v, pa.int32()) for k, v in columns.items()}))

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word; a word that is a token is that token."""
        out = [None if (rank := self.ranks.get(w)) is None else np.array([rank], np.uint32) for w in words]
        for some, encode in ((lambda n: n <= SHORT, self._exact), (lambda n: n > SHORT, self._by_blocks)):
            todo = [i for i, ids in enumerate(out) if ids is None and some(len(words[i]))]
            for i, ids in zip(todo, encode([words[i] for i in todo]), strict=True):
                out[i] = ids
        return out

    def _by_blocks(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of long words, from those of their blocks, of which two become one in each round."""
        cut = [[w[a : a + SHORT] for a in range(0, len(w), SHORT)] for w in words]
        blocks = iter(self._exact([b for parts in cut for b in parts]))
        rows = [[next(blocks) for _ in parts] for parts in cut]
        while any(len(parts) > 1 for parts in rows):
            pairs = [(parts[j], parts[j + 1]) for parts in rows for j in range(0, len(parts) - 1, 2)]
            joined = iter(self._joined(pairs))
            rows = [[next(joined) if j + 1 < len(parts) else parts[j] for j in range(0, len(parts), 2)] for parts in rows]
        return [parts[0] for parts in rows]

    def _joined(self, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """The ids of the bytes of two neighbours, for each pair of them."""
        out: list = [None] * len(pairs)
        todo, k = list(range(len(pairs))), JOINED_TOKENS
        while todo:
            inner = [[*pairs[i][0][-k:].tolist(), *pairs[i][1][:k].tolist()] for i in todo]
            found, again = self._exact([b"".join([self.texts[t] for t in ids]) for ids in inner]), []
            for i, ids in zip(todo, found, strict=True):
                left, right = pairs[i]
                same_start = k >= len(left) or ids[0] == left[-k]
                same_end = k >= len(right) or ids[-1] == right[k - 1]
                if same_start and same_end:
                    out[i] = np.concatenate([left[: max(len(left) - k, 0)], ids, right[k:]])
                else:
                    again.append(i)
            todo, k = again, 2 * k
        return out

    def _exact(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word by contracting it as a whole."""
        out: list[np.ndarray | None] = [None] * len(words)
        batches: dict[bool, list[int]] = {False: [], True: []}
        size = {False: 0, True: 0}
        for i, word in enumerate(words):
            long = len(word) > LONGEST
            batches[long].append(i)
            size[long] += len(word)
            if size[long] >= BATCH_BYTES:
                self._contract(words, batches[long], long, out)
                batches[long], size[long] = [], 0
        for long, batch in batches.items():
            self._contract(words, batch, long, out)
        return out

    def _contract(self, words: list[bytes], batch: list[int], long: bool, out: list) -> None:
        if not batch:
            return
        data = np.frombuffer(b"".join(words[i] for i in batch), np.uint8)
        lengths = np.array([len(words[i]) for i in batch])
        heads = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(batch)), lengths)
        self._table("start", word=word, pos=np.arange(len(data)) - heads[word], tok=self.byte_ids[data])
        got = self.con.execute(_CONTRACT_LONG if long else _CONTRACT).fetchnumpy()
        ends = np.searchsorted(got["word"], np.arange(len(batch) + 1))
        ids = np.asarray(got["tok"]).astype(np.uint32)
        for k, i in enumerate(batch):
            out[i] = ids[ends[k] : ends[k + 1]]

    def decode(self, words: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids."""
        lengths = np.array([len(w) for w in words], np.int64)
        out = [b""] * len(words)
        if lengths.sum():
            word = np.repeat(np.arange(len(words)), lengths)
            self._table("ids", word=word, pos=np.arange(len(word)), tok=np.concatenate(words).astype(np.int32))
            for i, text in self.con.execute(_DECODE).fetchall():
                out[i] = bytes.fromhex(text)
        return out


_CODERS: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    """The coder of a file, one for each worker process."""
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]


class TextEncoder:
    """Arrow texts -> their ids (little-endian unsigned 32-bit integers) and the bytes that the ids decode to.

    Belongs to one task, and what it remembers goes with it.
    """

    def __init__(self, path: str, pattern: str):
        self.split, self.words, self.memory = regex.compile(pattern).findall, coder(path), Memory(REMEMBERED_BYTES, SHORT, entry=330)

    def __call__(self, texts: pa.Array) -> tuple[Pieces, Pieces]:
        ids, decoded = encode_by_chunks(texts, self._chunks, ("<u4", "u1"))
        return ids, decoded

    def _chunks(self, chunks: list[str]) -> tuple[list[bytes], list[bytes]]:
        values = encoded(chunks, self.split, self._words, _joined_parts, self.memory)
        return [ids for ids, _ in values], [decoded for _, decoded in values]

    def _words(self, new: list[str]) -> Iterator[tuple[bytes, bytes]]:
        ids = self.words.encode([w.encode() for w in new])
        return zip([i.astype("<u4").tobytes() for i in ids], self.words.decode(ids), strict=True)


def _joined_parts(values: list[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
    return b"".join([v[0] for v in values]), b"".join([v[1] for v in values])


def encode_texts(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) of every document; ``ids`` only if asked for.

    The digests are of the ids as little-endian unsigned 32-bit integers, and of the bytes that the
    ids decode to.  A null or empty text has no ids.  Repeated rows and null ids of documents pass
    as they are; other columns of ``docs`` are not read.  Nothing is shuffled.
    """
    out = [("ids", T.ArrayType(T.IntegerType()))] * with_ids
    out += [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    picked = pick(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = TextEncoder(path, pattern)
        for batch in slices(batches, most=SLICE):
            ids, decoded = encode(batch.column("text"))
            columns = [batch.column("doc_id")]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(ids.offsets, pa.int32()), pa.array(ids.values.view("<i4"))))
            columns += [
                pa.array(np.diff(ids.offsets)),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids.parts()], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded.parts()], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *[n for n, _ in out]])

    schema = T.StructType([picked.schema["doc_id"], *[T.StructField(n, t) for n, t in out]])
    return picked.mapInArrow(run, schema)


def decode_ids(rows: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with a binary column of the bytes that an array of ids stands for; null ids are empty."""
    schema = T.StructType([*rows.schema.fields, T.StructField(into, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(path)
        for batch in batches:
            given = [np.array(x or [], np.int64) for x in batch.column(ids).to_pylist()]
            columns = {n: batch.column(n) for n in batch.schema.names}
            yield pa.RecordBatch.from_pydict({**columns, into: pa.array(words.decode(given), pa.binary())})

    return rows.mapInArrow(run, schema)
