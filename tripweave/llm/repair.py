"""Conversations with dropped, empty, repeated or mislabelled turns, and their cheapest repair.

A repair keeps, reroles or deletes every row and may insert empty ones, so that the roles read
``(s?(ua)+)?``: an optional system turn, then user and assistant in turn.  Its audit is the initials of
its edits; among the cheapest repairs the one with the least audit counts.

The repair is found by depth-first branch and bound: an explicit stack of partial repairs, a lower
bound on what the rows that are left cost, the best whole repair so far, and for every node (row,
state of the role pattern) the best partial repair that reached it, which eliminates all others.  That
is sound: two partial repairs of equal cost at one node never start with one another, since what
follows could only be insertions, and those cost.  So the lesser one stays the lesser with any ending.

Rows are sorted by conversation and turn over all tasks, so that a long conversation is spread too.  A
task cuts it into segments of bounded size and searches each from every state to every state; the
segments are then put together in order.  Only the digest of a long repaired conversation is made by
one task, which reads its rows as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.columns import pick
from tripweave.session import cut_lineage, small_side

# ---- Fixed values: kinds of damage by the remainder, costs, the pattern of roles -----
DROPPED, EMPTIED, UNSTOPPED, REPEATED, RELABELLED, KINDS = 0, 1, 2, 3, 4, 20
REROLE, DELETE, INSERT, FINISH = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
STOPS = ".!?"
START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired rows so far end with
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
WHOLE = (START, ASSISTANT)
ROLE = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
# --------------------------------------------------------------------------------------

SEGMENT_ROWS = 1024
SEGMENT_BYTES = 8 << 20  # of text; a longer row is a segment of its own


# ---- Search ------------------------------------------------------------------


@dataclass(frozen=True)
class Row:
    initial: str  # of the role
    doomed: bool  # blank or duplicate: has to go
    truncated: bool


Found = tuple[int, str]  # cost, audit


class Bounds:
    """Lower bounds on the cost of the rows from the i-th on, given the state before them: what the
    cheapest ending costs, whatever its audit.  ``None`` where no ending reaches a goal."""

    def __init__(self, rows: list[Row], goals: tuple[int, ...]):
        ahead: list[int | None] = [0 if state in goals else None for state in range(4)]
        self.levels = [self._inserted(ahead)]
        for row in reversed(rows):
            after, here = self.levels[-1], []
            for state in range(4):
                ways = [(cost, after[to]) for _, cost, to in edits(row, state)]
                here.append(min((cost + rest for cost, rest in ways if rest is not None), default=None))
            self.levels.append(self._inserted(here))
        self.levels.reverse()

    @staticmethod
    def _inserted(costs: list[int | None]) -> list[int | None]:
        """The same where empty rows may come first; more than a pair of them never helps."""
        for _ in range(2):
            found = [costs[NEXT[state, WANTED[state]]] for state in range(4)]
            costs = [min((c for c in (old, None if f is None else f + INSERT) if c is not None), default=None) for old, f in zip(costs, found, strict=True)]
        return costs

    def __call__(self, i: int, state: int) -> int | None:
        return self.levels[i][state]


def edits(row: Row, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, state after it) of what can be done with a row."""
    out = [("D", DELETE, state)]
    if not row.doomed:
        stay = FINISH * row.truncated
        if (state, row.initial) in NEXT:
            out.append(("K", stay, NEXT[state, row.initial]))
        out.append(("R", stay + REROLE, NEXT[state, WANTED[state]]))
    return out


def search(rows: list[Row], start: int, goals: tuple[int, ...], bounds: Bounds | None = None) -> Found | None:
    """The cheapest repair of ``rows`` from a state to one of the goals, the least audit among equal ones."""
    bounds, n = bounds or Bounds(rows, goals), len(rows)
    best: Found | None = None
    reached: dict[tuple[int, int], Found] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        rest = bounds(i, state)
        if rest is None or (best is not None and (cost + rest, audit) > best):
            continue
        if (i, state) in reached and reached[i, state] <= (cost, audit):
            continue
        reached[i, state] = (cost, audit)
        if i == n and state in goals and (best is None or (cost, audit) < best):
            best = (cost, audit)
        children = [(i, NEXT[state, WANTED[state]], cost + INSERT, audit + "I")]
        if i < n:
            children += [(i + 1, to, cost + more, audit + edit) for edit, more, to in edits(rows[i], state)]
        told = [(c[2] + bounds(c[0], c[1]), c[3], c) for c in children if bounds(c[0], c[1]) is not None]
        # The most promising child is taken first: it is pushed last.
        stack.extend(c for _, _, c in sorted(told, reverse=True))
    return best


def repaired(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[str]:
    """The repaired ``role:text`` of (role, text) rows, by their audit."""
    rows, state = iter(rows), START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else WANTED[state]
        yield f"{role if edit == 'K' else ROLE[initial]}:{text}"
        state = NEXT[state, initial]


def digest_of(lines: Iterator[str]) -> str:
    out = hashlib.sha256()
    for i, line in enumerate(lines):
        out.update((("\n" if i else "") + line).encode())
    return out.hexdigest()


# ---- Segments ------------------------------------------------------------------


@dataclass
class Segment:
    """Consecutive rows of one conversation; ``key`` orders the segments of a conversation."""

    key: tuple = ()
    rows: list[Row] = field(default_factory=list)
    texts: list[tuple[str, str]] = field(default_factory=list)
    size: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: list[int] = field(default_factory=list)  # different ones, in order

    def add(self, row: dict, again: bool) -> None:
        role, text, turn = row["role"], row["text"], row["turn"]
        duplicate = not row["blank"] and again
        truncated = row["truncated"] and not duplicate
        if self.rows and self.rows[-1].initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.rows.append(Row(role[:1], row["blank"] or duplicate, truncated))
        self.texts.append((role, text))
        self.size += len(text)
        self.blank += row["blank"]
        self.duplicate += duplicate
        self.truncated += truncated
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    @property
    def full(self) -> bool:
        return len(self.rows) >= SEGMENT_ROWS or self.size >= SEGMENT_BYTES

    def told(self, alone: bool, joined: bool) -> dict:
        """The segment as a row; with its answer if it may be all of its conversation, and with the
        tables from state to state if it may not."""
        has_turn, turn, role, digest, part = self.key
        out = {"has_turn": has_turn, "turn": turn, "role": role, "digest": digest, "part": part}
        out |= {"n_rows": len(self.rows), "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}
        out |= {"first_turn": self.turns[0] if self.turns else None, "last_turn": self.turns[-1] if self.turns else None, "n_turns": len(self.turns)}
        out |= {"first_initial": self.rows[0].initial if self.rows else None, "last_initial": self.rows[-1].initial if self.rows else None}
        out |= {"cost": None, "audit": None, "sha": None, "moves": None}
        if alone:
            out["cost"], out["audit"] = search(self.rows, START, WHOLE)
            out["sha"] = digest_of(repaired(self.texts, out["audit"]))
        if joined and self.rows:
            states = (START, SYSTEM, USER, ASSISTANT)
            bounds = [Bounds(self.rows, (b,)) for b in states]
            moves = [(a, b, search(self.rows, a, (b,), bounds[b])) for a in states for b in states]
            out["moves"] = [{"a": a, "b": b, "cost": m[0], "audit": m[1]} for a, b, m in moves if m is not None]
        return out


_SEGMENT = [
    ("has_turn", "boolean"), ("turn", "bigint"), ("role", "string"), ("digest", "binary"), ("part", "bigint"), ("n_rows", "bigint"),
    ("blank", "bigint"), ("duplicate", "bigint"), ("truncated", "bigint"), ("illegal", "bigint"), ("first_turn", "bigint"),
    ("last_turn", "bigint"), ("n_turns", "bigint"), ("first_initial", "string"), ("last_initial", "string"), ("cost", "bigint"),
    ("audit", "string"), ("sha", "string"), ("moves", "array<struct<a:int,b:int,cost:bigint,audit:string>>"),
]
_RESULT = [(c, "bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", "string"), ("repaired_sha256", "string")]


def _with_id(schema: T.StructType, columns: list[tuple[str, str]]) -> T.StructType:
    rest = T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in columns))
    return T.StructType([T.StructField("conv_id", schema["conv_id"].dataType)] + rest.fields)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield from batch.slice(at, 1024).to_pylist()


def _batches(rows: Iterator[dict], shape: pa.Schema, most: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_pylist(held, shape)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, shape)


def _segments(rows: Iterator[dict]) -> Iterator[dict]:
    """The segments of sorted rows of one task.  Its first and last conversation may go on elsewhere."""
    nothing = object()
    conv, segment, part, at_edge, before = nothing, Segment(), 0, True, None

    def closed(last: bool, more: bool) -> dict:
        whole = part == 0 and not more
        return {"conv_id": conv} | segment.told(alone=whole, joined=at_edge or last or not whole)

    for row in rows:
        key = (row["has_turn"], row["turn"], row["role"], row["digest"])
        other = conv is nothing or row["conv_id"] != conv
        if other or segment.full:
            if conv is not nothing:
                yield closed(False, more=not other)
                at_edge, part = at_edge and not other, 0 if other else part + 1
            conv, segment = row["conv_id"], Segment((*key, 0 if other else part))
        if other:
            before = None
        if not row["gone"]:
            segment.add(row, row["again"] or key == before)
            before = key
    if conv is not nothing:
        yield closed(True, more=False)


def _folded(segments: Iterator[dict]) -> Iterator[dict]:
    """One row for each conversation from its sorted segments; without a digest if there were several."""
    nothing = object()
    conv, held = nothing, None

    def result() -> dict:
        turns = held["last"] - held["first"] + 1 - held["n_turns"] if held["n_turns"] else 0
        out = {"conv_id": conv, "gaps": turns} | {k: held[k] for k in ("blank", "duplicate", "truncated", "illegal")}
        if held["parts"] == 1:
            cost, audit, sha = held["alone"]
        else:
            (cost, audit), sha = min(held["moves"][s] for s in WHOLE if s in held["moves"]), None
        return out | {"cost": cost, "audit": audit, "repaired_sha256": sha}

    for s in segments:
        if conv is nothing or s["conv_id"] != conv:
            if conv is not nothing:
                yield result()
            conv = s["conv_id"]
            held = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "n_turns", "parts"), 0)
            held |= {"first": None, "last": None, "initial": None, "alone": None, "moves": {START: (0, "")}}
        held["parts"] += 1
        held["alone"] = (s["cost"], s["audit"], s["sha"])
        if s["n_rows"]:
            for name in ("blank", "duplicate", "truncated", "illegal"):
                held[name] += s[name]
            if held["initial"] is not None and held["initial"] + s["first_initial"] not in LEGAL:
                held["illegal"] += 1
            held["initial"] = s["last_initial"]
            if s["n_turns"]:
                held["n_turns"] += s["n_turns"] - (held["last"] == s["first_turn"])
                held["first"] = s["first_turn"] if held["first"] is None else held["first"]
                held["last"] = s["last_turn"]
            moves: dict[int, Found] = {}
            for m in s["moves"] or ():
                if m["a"] in held["moves"]:
                    cost, audit = held["moves"][m["a"]]
                    found = (cost + m["cost"], audit + m["audit"])
                    moves[m["b"]] = min(found, moves.get(m["b"], found))
            held["moves"] = moves
    if conv is not nothing:
        yield result()


def _digests(rows: Iterator[dict]) -> Iterator[dict]:
    """(conv_id, repaired_sha256) from rows that are sorted, after a row that holds the audit."""
    rows = iter(rows)
    row = next(rows, None)
    while row is not None:
        conv, audit, ahead = row["conv_id"], row["text"], [next(rows, None)]

        def own(conv=conv, ahead=ahead) -> Iterator[tuple[str, str]]:
            while ahead[0] is not None and not ahead[0]["is_audit"]:
                yield ahead[0]["role"], ahead[0]["text"]
                ahead[0] = next(rows, None)

        texts = own()
        sha = digest_of(repaired(texts, audit))
        for _ in texts:
            raise ValueError("a conversation has more rows than its audit tells")
        yield {"conv_id": conv, "repaired_sha256": sha}
        row = ahead[0]


# ---- Damage and faults ----------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows after damage; a dropped one stays as a mark, ``gone``.

    Null roles and texts are one space.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    name = F.concat(told[0], F.lit(":"), told[1])
    kind = F.crc32(name.cast("binary")) % KINDS
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == EMPTIED, "").when(F.col("kind") == UNSTOPPED, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    gone = F.col("kind") == DROPPED
    return rows.select(
        "conv_id",
        "turn",
        F.when(gone, "").when(F.col("kind") == RELABELLED, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone, "").otherwise(text).alias("text"),
        gone.alias("gone"),
        F.explode(times).alias("copy"),
    ).drop("copy")


def _with_faults(rows: DataFrame) -> DataFrame:
    """Adds what orders and judges a row alone: has_turn, digest (of role and text), blank, truncated."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    name = F.concat_ws(":", F.length("role").cast("string"), "role", "text")
    return rows.select(
        "conv_id", "turn", "role", "text", "gone",
        F.col("turn").isNotNull().alias("has_turn"),
        F.unhex(F.sha2(name, 256)).alias("digest"),
        (bare == "").alias("blank"),
        ((bare != "") & ~F.right(bare, F.lit(1)).isin(*STOPS)).alias("truncated"),
    )


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every
    conversation after damage.

    Rows are in the order of their turns, null first; rows of one turn by role, then by the SHA-256 of role
    and text, by which duplicates are told too.  Rows without a conversation are one conversation.
    Repeated rows are duplicates.  A conversation without rows after damage has zeros and empty texts.
    Other columns are not read.
    """
    order = ["has_turn", "turn", "role", "digest"]
    rows = _with_faults(damage(conversations))
    kept = rows.where(~F.col("gone") & ~F.col("blank"))
    first = F.min(F.struct("has_turn", "turn")).alias("first")
    several = kept.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(first, F.count("*").alias("n")).where("n > 1").drop("n")
    seen, _n = small_side(several)
    here = F.struct("has_turn", "turn")
    told = rows.join(seen, _same(F.col("conv_id"), F.col("c")) & (F.col("digest") == F.col("d")), "left")
    told = told.withColumn("again", F.coalesce(F.col("first") < here, F.lit(False))).drop("c", "d", "first")
    # Rows with one key stay together, so that each repeated row meets the one before it.
    dealt = told.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    segment, result = _with_id(rows.schema, _SEGMENT), _with_id(rows.schema, _RESULT)
    segments = dealt.mapInArrow(_by_rows(_segments, segment), segment)
    sorted_segments = segments.repartition("conv_id").sortWithinPartitions("conv_id", *order, "part")
    folded = cut_lineage(sorted_segments.mapInArrow(_by_rows(_folded, result), result))
    long, n_long = small_side(folded.where(F.col("repaired_sha256").isNull()).select(F.col("conv_id").alias("c")))
    if not n_long:
        return folded
    audits = folded.where(F.col("repaired_sha256").isNull()).select("conv_id", F.col("audit").alias("text"))
    audits = audits.withColumns({"is_audit": F.lit(True), "role": F.lit("")} | {c: F.lit(None).cast(rows.schema[c].dataType) for c in ("has_turn", "turn", "digest")})
    again = rows.where(~F.col("gone")).join(long, _same(F.col("conv_id"), F.col("c")), "left_semi").withColumn("is_audit", F.lit(False))
    columns = ["conv_id", "is_audit", *order, "text"]
    stream = again.select(*columns).unionByName(audits.select(*columns))
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("is_audit"), *order)
    shape = _with_id(rows.schema, [("repaired_sha256", "string")])
    digests = stream.mapInArrow(_by_rows(_digests, shape), shape).toDF("c", "sha")
    joined = folded.join(digests, _same(F.col("conv_id"), F.col("c")), "left")
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", "sha")).select(folded.columns)


def _by_rows(function, schema: T.StructType):
    """A function of rows as one of Arrow batches."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(function(_rows(batches)), shape)

    return run
