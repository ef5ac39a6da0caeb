"""Secrets in texts, and weak candidates that only count as parts of a whole credential.

Base spans stand on their own: assigned values, access identifiers, long hexadecimal
runs.  Weak candidates (bare keys, login names, endpoints) are ordinary text most of
the time; an interval join within the paragraph reports them only where the parts that
would complete the credential are near.

DataFrame functions only.  The text is read once and never shuffled: what moves are
the places of the parts found in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.columns import in_plain_names, pick
from tripweave.session import cut_lineage

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# With at least as many characters as count; for runs of one class this is the same as dropping short matches.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KEY = r"(?<![A-Za-z0-9+/])(?=[^0-9]{0,39}[0-9])(?=[^A-Z]{0,39}[A-Z])(?=[^a-z]{0,39}[a-z])[A-Za-z0-9+/]{40,}={0,2}"
LOGIN = r"""(?i)(user|user_?name|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
ENDPOINT = r"""(?i)(https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp|ftp|ssh)://[^\s"'<>]+"""
BREAK = r"\n[\x20\t]*\n"

BASE = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
WEAK = {"key": KEY, "login": LOGIN, "endpoint": ENDPOINT}
KINDS = [*BASE, *WEAK]
ASSIGNED_CHARACTERS = 6

# What completes a weak candidate: for each tuple, one part of these kinds has to be near.
IDENTIFIERS = ("access", "login")
SECRETS = ("assign", "hex", "key")
COMPLEMENTS = {"key": (IDENTIFIERS,), "login": (SECRETS,), "endpoint": (IDENTIFIERS, SECRETS)}

# Code points between the starts of two parts that belong together.
REACH = 400

_MARK = "[SECRET]"


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """array<struct<kind, gap, len, ok>> of all matches from left to right; gap: code points since the last one."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else None

    def part(match: Column, i: Column) -> Column:
        ok = F.length(F.get(values, i)) >= ASSIGNED_CHARACTERS if values is not None else F.lit(True)
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(F.get(gaps, i)).alias("gap"),
            F.length(match).alias("len"),
            ok.alias("ok"),
        )

    return F.when(text.rlike(pattern), F.transform(found, part))


def _any(text: Column, patterns: Sequence[str]) -> Column:
    out = F.lit(False)
    for pattern in patterns:
        out = out | text.rlike(pattern)
    return out


def _located(parts: DataFrame) -> DataFrame:
    """(row, kind, start, end, scope) of each part; scope: paragraphs before it."""
    each = parts.select("row", F.explode("parts").alias("p")).select("row", "p.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(so_far))
        .withColumn("start", F.col("end") - F.col("len"))
        .where("ok")
    )
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    is_base = F.col("kind").isin(*BASE)
    return (
        placed.withColumn("scope", F.count(F.when(F.col("kind") == "break", 1)).over(before))
        .withColumn("covered", F.coalesce(F.max(F.when(is_base, F.col("end"))).over(before), F.lit(0)) > F.col("start"))
        .where((F.col("kind") != "break") & (is_base | ~F.col("covered")))
        .select("row", "kind", "start", "end", "scope")
    )


def _near(weak: DataFrame, others: DataFrame, kinds: Sequence[str], reach: int) -> DataFrame:
    """The weak candidates with a part of ``kinds`` in their scope that starts within ``reach``.

    A semi join on (row, scope, cell of the position); each part stands in its own cell and both
    neighbours, so one equality finds all within reach and no pair is ever listed.
    """
    cell = F.floor(F.col("start") / reach)
    sides = others.where(F.col("kind").isin(*kinds)).select(
        F.col("row").alias("r"),
        F.col("scope").alias("s"),
        F.col("start").alias("at"),
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("c"),
    )
    here = F.floor(weak["start"] / reach)
    on = (
        (weak["row"] == sides["r"])
        & (weak["scope"] == sides["s"])
        & (here == sides["c"])
        & (F.abs(weak["start"] - sides["at"]) <= reach)
    )
    return weak.join(sides, on, "left_semi")


def _reported(located: DataFrame, reach: int) -> DataFrame:
    """Base spans, and the weak candidates whose complements are near."""
    out = located.where(F.col("kind").isin(*BASE))
    for kind, groups in COMPLEMENTS.items():
        weak = located.where(F.col("kind") == kind)
        for kinds in groups:
            weak = _near(weak, located, kinds, reach)
        out = out.unionByName(weak)
    return out.select("row", "kind", "start", "end")


def _parts(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(row, parts, *keep) of each document; parts is empty where nothing was found."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        *keep,
        F.monotonically_increasing_id().alias("row"),
        text.alias("whole"),
        *[_matches(text, kind, pattern).alias(f"m_{kind}") for kind, pattern in {**BASE, **WEAK}.items()],
    )
    # Paragraphs matter only where a weak candidate might be completed.
    weak = F.coalesce(*[F.col(f"m_{kind}") for kind in WEAK]).isNotNull()
    breaks = F.when(weak, _matches(F.col("whole"), "break", BREAK))
    lists = [F.coalesce(c, F.expr("array()")) for c in [*[F.col(f"m_{kind}") for kind in KINDS], breaks]]
    return found.select(*keep, "row", F.concat(*lists).alias("parts"))


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def _spans(reported: DataFrame) -> DataFrame:
    """(row, spans): spans by start, then kind as listed, then end."""
    one = F.struct("start", _order(F.col("kind")).alias("order"), "end", "kind")
    return reported.groupBy("row").agg(F.array_sort(F.collect_list(one)).alias("spans"))


def _told(spans: Column) -> Column:
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, spans): every document with its spans, array<struct<start, order, end, kind>> in code
    points (end exclusive), sorted by start, then by kind in the order of ``KINDS``.

    A null or empty text has no spans.  Repeated rows and rows of one or a null doc_id are separate
    documents.  Spans of different kinds may overlap, but a weak candidate inside a base span is not
    reported.  Other columns of ``docs`` are not read.
    """
    parts = cut_lineage(_parts(pick(docs, "doc_id", "text"), ["doc_id"]))
    spans = _spans(_reported(_located(parts.where(F.size("parts") > 0)), reach))
    none = F.expr("CAST(array() AS array<struct<start:bigint, `order`:bigint, end:bigint, kind:string>>)")
    return parts.join(spans, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def secrets(docs: DataFrame) -> DataFrame:
    """The digest of each document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = scan_secrets(docs)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[of(kind) for kind in BASE],
        F.sha2(_told(base), 256).alias("base_sha256"),
        _told(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, reach: int = REACH, length: str | None = None) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by a mark; other documents pass unchanged.

    A column named by ``length`` becomes the number of characters of the changed texts.

    Only documents in which some part was found are stored and joined to their spans.
    """
    return in_plain_names(docs, ("text", length or "text"), lambda d: _redacted(d, reach, length))


def _redacted(docs: DataFrame, reach: int, length: str | None) -> DataFrame:
    names = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    some = _any(text, [*BASE.values(), *WEAK.values()])
    held = cut_lineage(_parts(docs.where(some), names))
    located = _reported(_located(held), reach)
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        located.withColumn("from", F.coalesce(F.max("end").over(before), F.lit(0)))
        .withColumn("to", F.greatest("from", "start"))
        .groupBy("row")
        .agg(
            F.array_sort(F.collect_list(F.struct("from", "to", "end"))).alias("pieces"),
            F.max("end").alias("last"),
        )
    )
    kept = F.transform("pieces", lambda p: F.col("text").substr((p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int")))
    tail = F.col("text").substr((F.col("last") + 1).cast("int"), F.length("text"))
    clean = F.array_join(F.concat(kept, F.array(tail)), _MARK)
    changed = held.join(pieces, "row", "left").withColumn("text", F.when(F.col("last").isNull(), F.col("text")).otherwise(clean))
    if length:
        changed = changed.withColumn(length, F.when(F.col("last").isNull(), F.col(length)).otherwise(F.length("text").cast("bigint")))
    return docs.where(~some).unionByName(changed.select(*names))
