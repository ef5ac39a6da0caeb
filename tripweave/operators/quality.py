"""Constraint checks: which rows break which rule, and how often.

All row rules of a table are evaluated in one pass.  Rules about keys are
pre-aggregated per key before any join, so a key that holds a large share of
the rows is one row by the time it is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave import model
from tripweave.model import ForeignKey
from tripweave.operators.documents import with_parts
from tripweave.session import small_side

ROW_RULE_KINDS = ("not_null", "value", "enum", "length")


def _broken(holds: Column) -> Column:
    """A rule is broken only where its predicate is false; null passes."""
    return ~F.coalesce(holds, F.lit(True))


def row_rules(table: str, kinds: tuple[str, ...] = ROW_RULE_KINDS) -> dict[str, Column]:
    """The row rules of a table: rule name to a column that is true if broken."""
    rules: dict[str, Column] = {}
    if "not_null" in kinds:
        for field in model.SCHEMAS[table].fields:
            if not field.nullable:
                rules[f"{table}.{field.name}.not_null"] = F.col(field.name).isNull()
    if "value" in kinds:
        for name, predicate in model.VALUE_CHECKS.get(table, {}).items():
            rules[f"{table}.{name}"] = _broken(F.expr(predicate))
    if "enum" in kinds:
        for column, values in model.ENUMS.get(table, {}).items():
            rules[f"{table}.{column}.enum"] = _broken(F.col(column).isin(values))
    if "length" in kinds:
        for column, limit in model.LENGTHS.get(table, {}).items():
            rules[f"{table}.{column}.length"] = _broken(F.char_length(F.col(column)) <= limit)
    return rules


def battery_rules(range_check: bool = True, only_battery: bool = True) -> dict[str, Column]:
    """The rules of the evolved events table."""
    rules = {}
    if range_check:
        rules["events.battery_level.range"] = _broken(F.expr(model.BATTERY_RANGE))
    if only_battery:
        rules["events.battery_level.only_battery"] = _broken(F.expr(model.BATTERY_ONLY))
    return rules


def count_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n_violations) for every rule, zero counts included; one pass."""
    counts = df.agg(*[F.count_if(broken).alias(f"n{i}") for i, broken in enumerate(rules.values())])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"n{i}").alias("n_violations")) for i, name in enumerate(rules)]
    return counts.select(F.inline(F.array(*pairs)))


def count_duplicates(df: DataFrame, table: str, key: str | None = None) -> DataFrame:
    """(rule, n_violations): rows beyond the first of their key.

    Keys are counted by a 64-bit hash first, eight bytes of shuffle each however long the key;
    the keys themselves are compared only where a hash repeats.
    """
    key = key or model.KEYS[table]
    keys = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(key).alias("hash"))
    repeated, rows = small_side(keys.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))
    rule = F.lit(f"{table}.{key}.unique").alias("rule")
    if not rows:
        return df.sparkSession.range(1).select(rule, F.lit(0).cast("bigint").alias("n_violations"))
    per_key = keys.join(repeated, "hash", "left_semi").groupBy("key").agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_violations")).select(rule, "n_violations")


def _key_usage(df: DataFrame, columns: list[str]) -> DataFrame:
    """(which, key, n): how many rows use a value as the key in ``columns[which]``.

    One scan serves all key columns, and a value that fills a third of the rows
    is one row per task by the time it is shuffled.  Keys of different types are
    compared as text.
    """
    mixed = len({df.schema[c].dataType for c in columns}) > 1
    pairs = [
        F.struct(F.lit(i).alias("which"), (F.col(c).cast("string") if mixed else F.col(c)).alias("key"))
        for i, c in enumerate(columns)
    ]
    used = df.select(F.inline(F.array(*pairs))).where(F.col("key").isNotNull())
    return used.groupBy("which", "key").agg(F.count("*").alias("n"))


def _parent_keys(fks: list[ForeignKey], parents: dict[str, DataFrame], key_type: T.DataType) -> DataFrame:
    """(which, key) of all keys that ``fks[which]`` may refer to."""
    known = [
        parents[fk.parent].select(F.lit(i).alias("which"), F.col(fk.parent_key).cast(key_type).alias("key"))
        for i, fk in enumerate(fks)
    ]
    return reduce(DataFrame.unionByName, known)


def orphan_keys(child: DataFrame, fks: list[ForeignKey], parents: dict[str, DataFrame]) -> DataFrame:
    """(which, key, n): foreign-key values without a parent, and their row count."""
    used = _key_usage(child, [fk.column for fk in fks])
    return used.join(_parent_keys(fks, parents, used.schema["key"].dataType), ["which", "key"], "left_anti")


def count_orphans(child: DataFrame, fks: list[ForeignKey], parents: dict[str, DataFrame]) -> DataFrame:
    """(rule, n_violations): child rows whose parent is missing, per foreign key."""
    orphans = orphan_keys(child, fks, parents)
    sums = [
        F.coalesce(F.sum(F.when(F.col("which") == i, F.col("n"))), F.lit(0)).alias(f"n{i}") for i in range(len(fks))
    ]
    pairs = [F.struct(F.lit(fk.rule).alias("rule"), F.col(f"n{i}").alias("n_violations")) for i, fk in enumerate(fks)]
    return orphans.agg(*sums).select(F.inline(F.array(*pairs)))


def _offending_keys(df: DataFrame, table: str, fks: list[ForeignKey], parents: dict[str, DataFrame]) -> DataFrame:
    """(which, key): orphans of ``fks[which]``, and after them the repeated keys of
    the table itself; from a single pass over the key columns."""
    used = _key_usage(df, [fk.column for fk in fks] + [model.KEYS[table]])
    repeated = F.col("n") > 1
    if not fks:
        return used.where(repeated).select("which", "key")
    known = _parent_keys(fks, parents, used.schema["key"].dataType).distinct().withColumn("known", F.lit(True))
    orphan = F.col("known").isNull()
    bad = F.when(F.col("which") == len(fks), repeated).otherwise(orphan)
    return used.join(known, ["which", "key"], "left").where(bad).select("which", "key")


def check_rows(tables: dict[str, DataFrame], kinds: tuple[str, ...] = ROW_RULE_KINDS) -> DataFrame:
    """Violation counts of the row rules of all given tables."""
    parts = []
    for name, df in tables.items():
        rules = row_rules(name, kinds)
        if rules:
            parts.append(count_violations(df, rules))
    return reduce(DataFrame.unionByName, parts)


def check_unique(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [count_duplicates(df, name) for name, df in tables.items()])


def _foreign_keys(table: str, parents: dict[str, DataFrame] | None) -> list[ForeignKey]:
    return [fk for fk in model.FOREIGN_KEYS if fk.child == table and fk.parent in (parents or {})]


def check_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    checked = {name: _foreign_keys(name, tables) for name in tables}
    return reduce(
        DataFrame.unionByName, [count_orphans(tables[name], fks, tables) for name, fks in checked.items() if fks]
    )


def check_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Every rule of the model with its number of violations.

    Two passes over each table: one for all its row rules, and one over its key columns, which
    serves its foreign keys, its own key, and the foreign keys of other tables that point to it.
    """
    return check_rows(tables).unionByName(_check_keys(tables))


def _check_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """(rule, n_violations) of the unique and foreign-key rules of all tables.

    Every key column of a table gives (relation, hash of the key, rows that are parents, rows that
    are children); one aggregation per relation and key then tells repeated keys and missing
    parents.  Keys are compared by two hashes, so texts are not shuffled.
    """
    fks = [fk for fk in model.FOREIGN_KEYS if fk.child in tables and fk.parent in tables]
    sides = []
    for name, df in tables.items():
        own = model.KEYS[name]
        uses = [(own, name, -1)] + [(fk.column, fk.parent, i) for i, fk in enumerate(fks) if fk.child == name]

        def entry(column: str, parent: str, which: int) -> Column:
            text = F.col(column).cast("string")
            return F.struct(
                F.lit(parent).alias("parent"),
                F.lit(which).alias("which"),
                F.xxhash64(text).alias("h1"),
                F.xxhash64(F.lit(7), text).alias("h2"),
                F.col(column).isNotNull().alias("known"),
            )

        pairs = F.array(*[entry(column, parent, which) for column, parent, which in uses])
        sides.append(df.select(F.inline(pairs)).where("known").drop("known"))
    used = reduce(DataFrame.unionByName, sides)
    # Combined in each task first, so a key that fills a third of the rows is one row per task.
    owned = F.sum(F.when(F.col("which") == -1, 1).otherwise(0)).alias("owned")
    asked = [F.sum(F.when(F.col("which") == i, 1).otherwise(0)).alias(f"asked{i}") for i in range(len(fks))]
    per_key = used.groupBy("parent", "h1", "h2").agg(owned, *asked)
    found = per_key.agg(
        *[F.coalesce(F.sum(F.when((F.col("parent") == t) & (F.col("owned") > 1), F.col("owned") - 1)), F.lit(0)).alias(f"u{i}") for i, t in enumerate(tables)],
        *[F.coalesce(F.sum(F.when(F.col("owned") == 0, F.col(f"asked{i}"))), F.lit(0)).alias(f"f{i}") for i in range(len(fks))],
    )
    rules = [(f"{t}.{model.KEYS[t]}.unique", f"u{i}") for i, t in enumerate(tables)] + [(fk.rule, f"f{i}") for i, fk in enumerate(fks)]
    return found.select(F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(c).alias("n_violations")) for r, c in rules])))


def keep_valid_rows(df: DataFrame, table: str) -> DataFrame:
    """The rows that keep all row rules of their table; a plain filter."""
    holds = [~broken for broken in row_rules(table).values()]
    return df.where(reduce(lambda a, b: a & b, holds))


def broken_rules(df: DataFrame, table: str, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """``df`` with ``broken_rules``, the array of the names of the rules a row breaks.

    Row rules need no shuffle.  For foreign keys and for the uniqueness of the
    key the offending key values are computed first, on narrow columns; they are
    usually few and then reach the rows by broadcast.  All rows of a repeated
    key are marked, since an unordered table has no first one.
    """
    flags = [F.when(broken, F.lit(name)) for name, broken in row_rules(table).items()]
    fks = _foreign_keys(table, parents)
    columns = [fk.column for fk in fks] + [model.KEYS[table]]
    names = [fk.rule for fk in fks] + [f"{table}.{model.KEYS[table]}.unique"]
    offending, rows = small_side(_offending_keys(df, table, fks, parents or {}))

    marked = df
    if rows:
        key_type = offending.schema["key"].dataType
        for i, (name, column) in enumerate(zip(names, columns, strict=True)):
            keys = offending.where(F.col("which") == i).select(F.col("key").alias(f"_bad{i}"))
            marked = marked.join(keys, F.col(column).cast(key_type) == F.col(f"_bad{i}"), "left")
            flags.append(F.when(F.col(f"_bad{i}").isNotNull(), F.lit(name)))
    return marked.select(*df.columns, F.array_compact(F.array(*flags)).alias("broken_rules"))


def split(
    df: DataFrame, table: str, parents: dict[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); the rejected rows keep their ``broken_rules``."""
    marked = broken_rules(df, table, parents)
    bad = F.size("broken_rules") > 0
    return marked.where(~bad).drop("broken_rules"), marked.where(bad)


# ---- Documents --------------------------------------------------------------


def document_rules(docs: DataFrame) -> dict[str, Column]:
    """The rules of trip documents: required fields, and per event its required
    fields, its type and its battery level.  A rule about events is broken once
    per document, however many events break it.  Documents of the first schema
    version have no battery level; the field counts as absent."""
    rules = {
        f"trips.{f.name}.required": F.col(f.name).isNull()
        for f in model.TRIP_DOCUMENT.fields
        if f.name not in ("trip_id", "part", "parts")
    }
    item_type = docs.schema["events"].dataType.elementType
    for name in ("timestamp", "event_type", "value"):
        rules[f"trips.events.{name}.required"] = F.exists(f"events.{name}", lambda v: v.isNull())
    rules["trips.events.event_type.enum"] = F.exists(
        "events.event_type", lambda v: _broken(v.isin(model.EVENT_TYPES))
    )
    if "battery_level" in item_type.names:
        rules["trips.events.battery_level.range"] = F.exists(
            "events.battery_level", lambda v: _broken(v.between(model.BATTERY_MIN, model.BATTERY_MAX))
        )
    return {name: F.coalesce(broken, F.lit(False)) for name, broken in rules.items()}


def document_table_rules(table: str) -> dict[str, Column]:
    """The rules of the user and station documents."""
    rules = {
        f"{table}.{f.name}.required": F.col(f.name).isNull()
        for f in model.SCHEMAS[table].fields
        if f.name != model.KEYS[table]
    }
    if table == "stations":
        rules["stations.capacity.minimum"] = _broken(F.col("capacity") >= 1)
    return rules


def _count_documents(flagged: DataFrame, key: str, rules: list[str]) -> DataFrame:
    """(rule, n_violations) of documents from the flags f0, f1, ... of their parts, which are computed once.
    Whole documents are added up per task, parts are put together by key.  A row that does not say how many
    parts it has counts as a document."""
    in_parts = F.coalesce(F.col("parts") > 1, F.lit(False))
    placed = flagged.withColumn("in_parts", in_parts).withColumn(key, F.when(F.col("in_parts"), F.col(key)))
    found = placed.groupBy("in_parts", key).agg(*[F.count_if(f"f{i}").alias(f"f{i}") for i in range(len(rules))])
    n = [F.coalesce(F.sum(F.when(F.col("in_parts"), F.least(F.col(f"f{i}"), F.lit(1))).otherwise(F.col(f"f{i}"))), F.lit(0)) for i in range(len(rules))]
    counts = found.agg(*[c.alias(f"n{i}") for i, c in enumerate(n)])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"n{i}").alias("n_violations")) for i, name in enumerate(rules)]
    return counts.select(F.inline(F.array(*pairs)))


def check_documents(docs: DataFrame, users: DataFrame, stations: DataFrame) -> DataFrame:
    """(rule, n_violations) for the documents of the three collections.

    A trip document that is stored in parts counts once per rule.
    """
    rules = document_rules(docs)
    flags = [broken.alias(f"f{i}") for i, broken in enumerate(rules.values())]
    return (
        _count_documents(with_parts(docs).select("trip_id", "parts", *flags), "trip_id", list(rules))
        .unionByName(count_violations(users, document_table_rules("users")))
        .unionByName(count_violations(stations, document_table_rules("stations")))
    )


def check_versions(docs: DataFrame, versions: tuple[int, ...] = (1, 2)) -> DataFrame:
    """(version, rule, n_violations) of trip documents of mixed schema versions: each is judged by the rules
    of its own version.  A document of the first version may not have a battery level at all."""
    rules = document_rules(docs)
    late = "trips.events.battery_level.range"
    first = F.col("version") == 1
    absent = F.exists("events.battery_level", lambda v: v.isNotNull())
    own = {name: ~first & broken if name == late else broken for name, broken in rules.items()}
    own["trips.events.battery_level.absent"] = first & F.coalesce(absent, F.lit(False))
    flags = [broken.alias(f"f{i}") for i, broken in enumerate(own.values())]
    flagged = with_parts(docs).select("trip_id", "parts", "version", *flags)
    # A document in parts counts once per rule.
    whole = flagged.where(F.col("parts") == 1).drop("trip_id", "parts")
    cut = flagged.where(F.col("parts") > 1).groupBy("trip_id", "version").agg(*[F.bool_or(f"f{i}").alias(f"f{i}") for i in range(len(own))])
    asked = [(v, name, F.count_if((F.col("version") == v) & F.col(f"f{i}"))) for v in versions for i, name in enumerate(own)]
    counts = whole.unionByName(cut.drop("trip_id")).agg(*[n.alias(f"n{i}") for i, (_, _, n) in enumerate(asked)])
    rows = [F.struct(F.lit(v).alias("version"), F.lit(name).alias("rule"), F.col(f"n{i}").alias("n_violations")) for i, (v, name, _) in enumerate(asked)]
    return counts.select(F.inline(F.array(*rows)))


def _json_shape(value: Column) -> Column:
    """The JSON type of a variant: BIGINT, DECIMAL(..), DOUBLE, STRING, BOOLEAN, VOID, ARRAY<..> or OBJECT<..>."""
    return F.schema_of_variant(value)


def _fits(value: Column, kind: T.DataType) -> Column:
    """True if the variant ``value`` has the JSON type of ``kind`` and converts to it.  Times and dates
    are text in JSON, numbers are not."""
    shape = _json_shape(value)
    as_text = F.try_variant_get(value, "$", "string")
    if isinstance(kind, T.StringType):
        return shape == "STRING"
    if isinstance(kind, T.IntegralType):
        return (shape == "BIGINT") & as_text.try_cast(kind).isNotNull()
    if isinstance(kind, T.NumericType):
        number = (shape == "BIGINT") | (shape == "DOUBLE") | shape.startswith("DECIMAL")
        return number & as_text.try_cast(kind).isNotNull()
    return (shape == "STRING") & as_text.try_cast(kind).isNotNull()


def _fields(value: Column, kind: T.StructType) -> Column:
    """The fields of a variant as a struct of variants; null if it is no object."""
    return F.try_variant_get(value, "$", _of_variants(kind))


def _of_variants(kind: T.StructType) -> str:
    return "struct<" + ",".join(f"`{f.name}`:variant" for f in kind.fields) + ">"


def _any_field_broken(fields: Column, kind: T.StructType) -> Column:
    return reduce(lambda a, b: a | b, [_type_broken(fields[f.name], f.dataType) for f in kind.fields])


def _type_broken(value: Column, kind: T.DataType) -> Column:
    """True if the variant ``value`` is there, is not null, and has not the type of ``kind`` throughout.

    Objects and arrays are taken apart once; the JSON type is asked of plain values only, since that of a
    nested one would be put together from all that it holds."""
    there = value.isNotNull() & ~F.is_variant_null(value)
    if isinstance(kind, T.StructType):
        fields = _fields(value, kind)
        broken = fields.isNull() | _any_field_broken(fields, kind)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        items = F.try_variant_get(value, "$", f"array<{_of_variants(kind.elementType)}>")
        broken = items.isNull() | F.exists(items, lambda e: e.isNull() | _any_field_broken(e, kind.elementType))
    elif isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        wrong = F.exists(items, lambda e: e.isNull() | F.is_variant_null(e) | _type_broken(e, kind.elementType))
        broken = items.isNull() | F.coalesce(wrong, F.lit(True))
    else:
        broken = ~_fits(value, kind)
    return there & F.coalesce(broken, F.lit(True))


def check_document_types(raw: DataFrame, text: str, schema: T.StructType, name: str) -> DataFrame:
    """(rule, n_violations): documents, given as JSON text, with a field that has not the JSON type and
    shape of its type.  Text that is no JSON object breaks ``<name>.json``; fields that are absent or
    null are the business of the required rules.  A document in parts counts once per rule.
    """
    parsed = raw.select(F.col(text).alias("text"), F.try_parse_json(text).alias("d"))
    parsed = parsed.select("text", "d", _fields(F.col("d"), schema).alias("fields"))
    # Text that is no object has no fields.
    rules = {f"{name}.json": F.col("text").isNotNull() & F.col("fields").isNull()}
    for f in schema.fields:
        rules[f"{name}.{f.name}.type"] = F.coalesce(_type_broken(F.col("fields")[f.name], f.dataType), F.lit(False))
    flags = [broken.alias(f"f{i}") for i, broken in enumerate(rules.values())]
    if "parts" not in schema.names:
        return count_violations(parsed.select(*flags), {rule: F.col(f"f{i}") for i, rule in enumerate(rules)})
    parts = F.try_variant_get("d", "$.parts", "int")
    key = F.when(parts > 1, F.get_json_object("text", f"$.{model.KEYS[name]}")).alias("key")
    return _count_documents(parsed.select(key, parts.alias("parts"), *flags), "key", list(rules))
