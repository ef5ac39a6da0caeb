"""Repairs against every possible repair, and whole tables against a plain reading of the rules."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from conftest import SMALL

from tripweave.llm import plans, repair

PATTERN = re.compile("(s?(ua)+)?")
SPACES = " \t\n\x0b\x0c\r"


def every_repair(rows):
    """The best (cost, audit) by trying all edits."""
    inserts = [()] + [(a,) for a in "ua"] + list(itertools.product("ua", repeat=2))
    best = None
    per_row = []
    for row in rows:
        options = [(4, "D", "")]
        if not row.doomed:
            more = 3 * row.truncated
            options += [(more, "K", row.initial), (3 + more, "R", "u"), (3 + more, "R", "a")]
        per_row.append(options)
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for edits in itertools.product(*per_row):
            roles, audit, cost = "".join(gaps[0]), "I" * len(gaps[0]), 3 * sum(map(len, gaps))
            for (c, e, r), gap in zip(edits, gaps[1:], strict=True):
                roles, audit, cost = roles + r + "".join(gap), audit + e + "I" * len(gap), cost + c
            if PATTERN.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def by_table(rows):
    """The same row by row, with the best of every state."""
    def inserted(reached):
        for _ in range(4):
            for state, (cost, audit) in list(reached.items()):
                to = repair.NEXT[state, repair.WANTED[state]]
                found = (cost + 3, audit + "I")
                reached[to] = min(found, reached.get(to, found))
        return reached

    reached = inserted({repair.START: (0, "")})
    for row in rows:
        ahead = {}
        for state, (cost, audit) in reached.items():
            moves = [(state, cost + 4, "D")]
            if not row.doomed:
                more = cost + 3 * row.truncated
                moves += [(repair.NEXT[state, repair.WANTED[state]], more + 3, "R")]
                moves += [(repair.NEXT[state, row.initial], more, "K")] if (state, row.initial) in repair.NEXT else []
            for to, c, e in moves:
                ahead[to] = min((c, audit + e), ahead.get(to, (c, audit + e)))
        reached = inserted(ahead)
    return min(reached[s] for s in repair.WHOLE if s in reached)


def drawn(seed, n, initials="suaut "):
    draw = random.Random(seed)
    return [repair.Row(draw.choice(initials), draw.random() < 0.15, draw.random() < 0.2) for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2])
def test_best_of_all_repairs(n):
    kinds = [repair.Row(i, d, t) for i in ("s", "u", "a", "x") for d, t in ((False, False), (False, True), (True, False))]
    for rows in itertools.product(kinds, repeat=n):
        assert repair.search(list(rows), repair.START, repair.WHOLE) == every_repair(rows)


def test_best_of_all_repairs_of_three_rows():
    for seed in range(12):
        rows = drawn(seed, 3)
        assert repair.search(rows, repair.START, repair.WHOLE) == every_repair(rows)


def test_long_conversations():
    for seed in range(300):
        rows = drawn(seed, seed % 60, random.Random(seed).choice(["su", "ua", "u", "a", "suat", "sss"]))
        assert repair.search(rows, repair.START, repair.WHOLE) == by_table(rows)


def test_bounds_never_exceed_what_is_left():
    for seed in range(60):
        rows = drawn(seed, 9)
        for goals in (repair.WHOLE, (repair.USER,), (repair.SYSTEM,)):
            bounds = repair.Bounds(rows, goals)
            for i in range(len(rows) + 1):
                for state in range(4):
                    found = repair.search(rows[i:], state, goals)
                    assert (found is None) == (bounds(i, state) is None)
                    assert found is None or bounds(i, state) <= found[0]


def test_work_grows_with_the_rows():
    """Few nodes are expanded, also where everything has to change and costs are equal."""
    for initials in ("u", "a", "s", "ut", "sua", "uuua"):
        for truncated in (False, True):
            rows = [repair.Row(initials[i % len(initials)], False, truncated) for i in range(repair.SEGMENT_ROWS)]
            calls, bounds = [0], repair.Bounds(rows, repair.WHOLE)

            def counted(i, state, bounds=bounds, calls=calls):
                calls[0] += 1
                return bounds(i, state)

            assert repair.search(rows, repair.START, repair.WHOLE, counted) == by_table(rows)
            assert calls[0] < 20 * len(rows), (initials, truncated)


def test_segments_put_together_are_the_whole(monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", 3)
    for seed in range(40):
        draw = random.Random(seed)
        rows = []
        for conv in range(4):
            for turn in range(draw.randint(0, 14)):
                role = draw.choice(["system", "user", "assistant", "tool"])
                text = draw.choice(["a.", "b", "", "c!"]) + str(turn)
                rows.append(sorted_row(conv, turn // 2, role, text))
        rows.sort(key=lambda r: (r["conv_id"], r["turn"], r["role"], r["digest"]))
        segments = list(repair._segments(iter(rows)))
        got = {r["conv_id"]: r for r in repair._folded(iter(segments))}
        assert set(got) == {r["conv_id"] for r in rows}
        for conv, result in got.items():
            own = [r for r in rows if r["conv_id"] == conv]
            assert (result["cost"], result["audit"]) == by_table([repair.Row(r["role"][:1], r["blank"], r["truncated"]) for r in own])
            if result["repaired_sha256"] is None:
                audit = {"conv_id": conv, "is_audit": True, "role": "", "text": result["audit"]}
                more = next(repair._digests(iter([audit, *({**r, "is_audit": False} for r in own)])))
                result["repaired_sha256"] = more["repaired_sha256"]
            assert result["repaired_sha256"] == repair.digest_of(repair.repaired([(r["role"], r["text"]) for r in own], result["audit"]))


def sorted_row(conv, turn, role, text):
    return {
        "conv_id": conv, "turn": turn, "role": role, "text": text, "gone": False, "has_turn": True, "again": False,
        "digest": f"{role}:{text}".encode(), "blank": not text.strip(), "truncated": text[-1:] not in tuple(".!?"),
    }


# ---- Whole tables ----------------------------------------------------------------


def expected(rows):
    """conv_id -> result, from (conv_id, turn, role, text) rows."""
    groups = {}
    for conv, turn, role, text in rows:
        group = groups.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        group += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, group in groups.items():
        def order(r):
            return (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest())

        group.sort(key=order)
        seen, faults, judged = set(), [], []
        for _turn, role, text in group:
            bare = text.rstrip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            judged.append(repair.Row(role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, _, _ in group if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a.initial + b.initial not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        cost, audit = by_table(judged)
        lines, state, todo = [], repair.START, iter(group)
        for edit in audit:
            _, role, text = (None, "", "") if edit == "I" else next(todo)
            if edit != "D":
                role = role if edit == "K" else {"u": "user", "a": "assistant"}[repair.WANTED[state]]
                state = repair.NEXT[state, role[:1]]
                lines.append(f"{role}:{text}")
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return out


def result(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    got = {r[0]: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def odd_rows():
    draw = random.Random(5)
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["Fine.", "so on", "", None, "\t\n", "Why? \n", "é!", "...", "x "]
    rows = [(c, draw.choice([*range(6), None]), draw.choice(roles), draw.choice(texts)) for c in [*range(30), None] for _ in range(draw.randint(1, 9))]
    rows += [(100, t, draw.choice(roles[:3]), f"Row {t % 700}" + draw.choice(["", "."])) for t in range(3000)]
    rows += [(101, 1, "user", "The same.")] * 2500
    rows += [(102, t, "user" if t % 2 == 0 else "assistant", "word " * 20_000 + "end.") for t in range(3)]
    rows += [(103, None, "user", None)] * 4 + [(103, -5, "assistant", "Low."), (103, 10**12, "user", "High.")]
    return rows


def test_odd_tables(spark):
    rows = odd_rows()
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    table = table.selectExpr("*", "'x' AS Text", "1 AS gone", "2 AS digest", "3 AS c")
    assert result(repair.repair(table)) == expected(rows)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(plans.queries()["op13_conversation_repair"](spark, SMALL)) == expected(rows)


def test_text_ids(spark):
    rows = [("a", 0, "user", "One."), ("a", 1, "assistant", "Two."), ("b", 0, "assistant", "Three.")]
    table = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert result(repair.repair(table)) == expected(rows)


def test_no_rows(spark):
    table = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert repair.repair(table).count() == 0
