"""License notices in texts, by an exact set-similarity join of text blocks with templates.

A template is the set of the words of a known notice.  A block is ``2 * step`` consecutive words
that start at a multiple of ``step``, so that every stretch of at most ``step`` words lies whole in
one.  The join finds every pair of a block and a template of which the block holds a share of
``threshold`` or more.  All words are ordered from the rarest to the most frequent of the whole
corpus; then a block that qualifies has to hold a word of the template's short *prefix* (its rarest
words), has enough template words in all (*length*), and enough of both from the common word on
(*position*).  What passes is counted exactly.

DataFrame functions only.  Texts are never shuffled, and only documents that hold a rare word at all
are cut into blocks.
"""

from __future__ import annotations

import json
import math
import re
import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm.columns import pick
from tripweave.session import cut_lineage

# A word before A-Z become a-z: [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+ by what it holds.  Java looks single characters
# up in a table, and asks ranges one after the other for each character.
WORD = f"[{string.digits}{string.ascii_letters}\\x{{80}}-\\x{{10FFFF}}]+"


class Template(NamedTuple):
    name: str
    label: str
    marks: str  # words that tell this license from its relatives; a block without them gets no label
    text: str


# ---- Fixed values: phrases, and notices as their licenses word them ---------------
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

TEMPLATES = (
    Template("mit-notice", "mit", "released mit", "released under the MIT License"),
    Template("mit-grant", "mit", "", """Permission is hereby granted, free of charge, to any person obtaining a
        copy of this software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
        do so, subject to the following conditions"""),
    Template("apache-notice", "apache-2", "apache 2", "licensed under the Apache License, Version 2.0"),
    Template("apache-header", "apache-2", "apache 2", """Licensed under the Apache License, Version 2.0 (the
        "License"); you may not use this file except in compliance with the License. You may obtain a copy of the
        License at"""),
    Template("bsd-terms", "bsd", "", """Redistribution and use in source and binary forms, with or without
        modification, are permitted provided that the following conditions are met"""),
    Template("gpl-notice", "gpl-3", "gnu 3", "this work is licensed under the GNU General Public License, version 3"),
    Template("gpl-header", "gpl-3", "gnu 3", """This program is free software: you can redistribute it and/or
        modify it under the terms of the GNU General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version"""),
    Template("cc-by-nc-notice", "cc-by-nc", "cc by nc", "licensed under CC BY-NC 4.0"),
    Template("cc-by-notice", "cc-by", "creative attribution 4", """This work is licensed under a Creative Commons
        Attribution 4.0 International License"""),
)
# -----------------------------------------------------------------------------------

STEPS = (16, 128)  # a template belongs to the first step that is not below its number of words
THRESHOLD = 0.8


def words_of(text: str) -> list[str]:
    """The words of an ASCII text, as the columns below find them."""
    return re.findall("[0-9a-z]+", text.lower())


class Entry(NamedTuple):
    template: Template
    step: int
    words: frozenset[str]
    need: int  # so many of them make a block qualify


def entries(templates: tuple[Template, ...], threshold: float) -> list[Entry]:
    out = []
    for t in templates:
        found = words_of(t.text)
        step = next((s for s in STEPS if len(found) <= s), None)
        if step is None or not found:
            raise ValueError(f"{t.name} needs 1 to {STEPS[-1]} words")
        distinct = frozenset(found)
        out.append(Entry(t, step, distinct, max(1, math.ceil(threshold * len(distinct) - 1e-9))))
    return out


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _among(word: Column, some: list[str]) -> Column:
    """Whether ``word``, with a-z for A-Z, is one of some ASCII words.

    ``lower`` changes other letters too; those that become ASCII then get shorter.
    """
    return F.lower(word).isin(some) & (F.octet_length(F.lower(word)) == F.octet_length(word))


def _frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each word of the vocabulary occurs in all texts.  One row a word reaches the driver."""
    found = docs.select(F.explode(F.filter(_words(F.col("text")), lambda w: _among(w, vocabulary))).alias("w"))
    counted = found.groupBy(F.lower("w").alias("w")).agg(F.count("*").alias("n"))
    return dict.fromkeys(vocabulary, 0) | {r.w: r.n for r in counted.collect()}


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table of fixed size, as a literal of the plan."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _places(known: Column, phrase: str) -> Column:
    """Starts of a phrase in ``known``, which holds every word of it together with its place."""
    wanted = phrase.split()

    def here(j: Column) -> Column:
        start, ok = F.get(known, j), F.lit(True)
        for k, word in enumerate(wanted):
            other = F.get(known, j + k)
            ok = ok & F.coalesce((other["t"] == word) & (other["p"] == start["p"] + k), F.lit(False))
        return ok

    last = F.size(known) - len(wanted)
    starts = F.filter(F.sequence(F.lit(0), last), here)
    return F.when(last >= 0, F.transform(starts, lambda j: F.get(known, j)["p"])).otherwise(F.expr("CAST(array() AS array<int>)"))


def _labelled(places: Column, label: str) -> Column:
    return F.transform(places, lambda p: F.struct(p.cast("bigint").alias("p"), F.lit(label).alias("label")))


def _found(known: DataFrame, index: list[Entry], rank: dict[str, int]) -> DataFrame:
    """(row, template, label, share) for every block and template that qualify."""
    spark = known.sparkSession
    vocabulary = sorted({(w, e.step) for e in index for w in e.words})
    words = _table(spark, [{"t": w, "step": s, "g": rank[w]} for w, s in vocabulary], "t string, step int, g int")
    ordered = {e.template.name: sorted(rank[w] for w in e.words) for e in index}
    prefixes = [
        {"step": e.step, "g": g, "i": i, "need": e.need, "template": e.template.name, "label": e.template.label,
         "whole": ordered[e.template.name], "marks": [rank[w] for w in words_of(e.template.marks)]}
        for e in index
        for i, g in enumerate(ordered[e.template.name][: len(e.words) - e.need + 1])
    ]
    shape = "step int, g int, i int, need int, template string, label string, whole array<int>, marks array<int>"
    cell = F.floor(F.col("p") / F.col("step"))
    blocks = (
        known.select("row", F.inline("known"))
        .join(F.broadcast(words), "t")
        .select("row", "step", "g", F.explode(F.array(cell - 1, cell)).alias("block"))
        .where("block >= 0")
        .groupBy("row", "step", "block")
        .agg(F.sort_array(F.collect_set("g")).alias("held"))  # of at most 2 * step words
    )
    rest = F.size("held") - F.col("j")
    return (
        blocks.select("*", F.posexplode("held").alias("j", "g"))
        .join(F.broadcast(_table(spark, prefixes, shape)), ["step", "g"])
        .where((F.size("held") >= F.col("need")) & (F.size("whole") - F.col("i") >= F.col("need")) & (rest >= F.col("need")))
        .withColumn("common", F.size(F.array_intersect("held", "whole")))
        .where("common >= need")
        .withColumn("told", F.size(F.array_except("marks", "held")) == 0)
        .select("row", "template", F.when(F.col("told"), F.col("label")).alias("label"), (F.col("common") / F.size("whole")).alias("share"))
    )


def _read(docs: DataFrame, index: list[Entry]) -> tuple[DataFrame, dict[str, int]]:
    """Each document with its number of words and, where a rare word of a template or phrase occurs,
    all words of templates and phrases with their places; and the order of these words."""
    vocabulary = sorted({w for e in index for w in e.words} | {w for p in PHRASES for w in p.split()})
    docs = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    n = _frequencies(docs, vocabulary)
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (n[w], w)))}
    rare = {min(p.split(), key=rank.get) for p in PHRASES}
    for e in index:
        rare |= set(sorted(e.words, key=rank.get)[: len(e.words) - e.need + 1])
    probe = sorted(rare)
    placed = F.transform(F.col("words"), lambda w, p: F.when(_among(w, vocabulary), F.struct(F.lower(w).alias("t"), p.alias("p"))))
    known = F.when(F.exists("words", lambda w: _among(w, probe)), F.filter(placed, lambda x: x.isNotNull()))
    read = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), _words(F.col("text")).alias("words"))
    return read.select("doc_id", "row", F.size("words").cast("bigint").alias("n_words"), known.alias("known")), rank


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, places, found): every document with the places of the phrases, array<struct<p,
    label>>, and the blocks that qualify as one struct<template, label, share> a template with its largest share.

    ``label`` is null if the block lacks a mark of the license.  A null or empty text has no words.
    Repeated rows and rows of one or a null doc_id are separate documents.  Other columns are not read.
    Of equal shares of one template the one with a label counts.
    """
    index = entries(templates, threshold)
    read, rank = _read(docs, index)
    stored = cut_lineage(read)
    held = stored.where(F.col("known").isNotNull()).select("row", "known")
    best = _found(held, index, rank).groupBy("row", "template").agg(F.max(F.struct("share", "label")).alias("b"))
    found = best.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("template", "b.label", "b.share"))).alias("found"))
    phrases = [_labelled(_places(F.col("known"), phrase), label) for phrase, label in PHRASES.items()]
    places = F.when(F.col("known").isNotNull(), F.array_sort(F.concat(*phrases)))
    none = F.expr("CAST(array() AS array<struct<p:bigint,label:string>>)")
    nothing = F.expr("CAST(array() AS array<struct<template:string,label:string,share:double>>)")
    return stored.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce(places, none).alias("places"), F.coalesce("found", nothing).alias("found")
    )


def licenses(docs: DataFrame) -> DataFrame:
    """The digest of each document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is 1 where a phrase stands, else the largest share of a template that a block holds, else 0.
    """
    scanned = scan_licenses(docs)
    starts = F.transform("places", lambda s: s["p"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda s: s["label"])))
    told = F.filter(F.transform("found", lambda f: f["label"]), lambda label: label.isNotNull())
    best = F.coalesce(F.array_max(F.transform("found", lambda f: f["share"])), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, told)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
