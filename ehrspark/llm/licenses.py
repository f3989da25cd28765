"""License scan by diagonal voting (operator 9).

Native: DataFrame functions only. All word pairs of a text are joined, by
hash and then by their words, to the places of the same pair in the templates.
A hit votes for the diagonal text place - template place. Neighbouring
diagonals of one template, where words were put in or left out, are merged
within ``gap`` words, and a span is verified by the share of the template's
distinct pairs that it holds. A phrase of the base stands where all its pairs
vote for one diagonal. Templates are notices and the paragraphs of the whole
licenses in ``license_texts``, of which pairs common to many vote last, where
the others leave the template possible.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import LOWER, UPPER, materialize

#: What is no part of a word, the base's phrases with their
#: labels, and sentences of well-known licenses with theirs.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0."],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "mit-notice": ["Released under the MIT License.", "Licensed under the MIT License."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "agpl-3.0": ["of the GNU Affero General Public License as published",
                 "Licensed under the GNU Affero General Public License, version 3.",
                 "Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your version"],
    "lgpl": ["of the GNU Lesser General Public License as published",
             "Licensed under the GNU Lesser General Public License."],
    "cc-by": ["CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Released under CC0 1.0 Universal."],
    "epl-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Licensed under the Eclipse Public License, Version 2.0."],
    "isc": ["Licensed under the ISC License."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: Paragraphs of the texts are at least SHORT words long: a shorter one, a heading, goes to the next. Their pairs that
#: stand in more than COMMON paragraphs vote only where the others leave a template possible.
SHORT, COMMON = 8, 8
PARAGRAPH = re.compile(r"\n[^\w\n]*\n|\n(?=\W*(?:\d+\.|[a-z*]\)|\([a-z]+\))\s)")
#: What other licenses, not held here, have word for word: GPL 3 but for its name, Creative Commons 4.0 but for the choice.
SHARED = {"gpl-3.0": (re.compile("gnu general public"), "agpl-3.0|gpl-3.0"), "cc-by-sa": (re.compile("share ?alike|adapter|by sa"), "cc-4.0")}


def split(text: str) -> list[str]:
    return [w for w in re.split(NO_WORD, text.translate(str.maketrans(UPPER, LOWER))) if w]


@cache
def paragraphs(short: int = SHORT) -> dict[tuple[str, ...], str]:
    """The words of each paragraph of the whole licenses, with its label: the licenses that hold it, joined by |."""
    found: dict[tuple[str, ...], set[str]] = {}
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        own, alike = SHARED.get(path.stem, (re.compile(""), ""))
        parts: list[list[str]] = []
        carry: list[str] = []
        for part in PARAGRAPH.split(path.read_text()):
            words = split(part)
            if not parts and words[:1] == ["copyright"]:  # the holder's line
                continue
            carry = carry + words
            if len(carry) >= short:
                parts.append(carry)
                carry = []
        if carry:
            parts[-1:] = [parts[-1] + carry]
        for words in parts:
            found.setdefault(tuple(words), set()).add(path.stem if own.search(" ".join(words)) else alike)
    return {words: "|".join(sorted({x for label in labels for x in label.split("|")})) for words, labels in found.items()}


def template_pairs(spark: SparkSession, phrases: dict[str, str], templates: dict[str, list[str]], texts: dict[tuple[str, ...], str], most: int | None = None, short: int = SHORT,
                   rare: int = COMMON, share: float = 0.8) -> DataFrame:
    """(template, label, base, n_pairs, n_distinct, pair, at, id, first, need): the voting word pairs of all templates, some 25,000 rows.

    Pairs vote ``first`` unless they stand in more than ``rare`` paragraphs. ``need`` of these a text must hold, if a span is to hold
    ``share`` of all; where that is none, all pairs of the template vote first and ``need`` is null.
    """
    rows = []
    known = [(label, True, split(p)) for p, label in phrases.items()] + [(label, False, split(t)) for label, texts in templates.items() for t in texts]
    for k, (label, base, words) in enumerate(known):
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        rows += [(k, label, base, len(pairs), len(set(pairs)), p, i) for i, p in enumerate(pairs)]
    common = Counter(pair for words in texts for pair in set(zip(words, words[1:])))
    for k, (words, label) in enumerate(texts.items(), len(known)):
        pairs = list(enumerate(zip(words, words[1:])))
        some = [(i, p) for i, p in pairs if most is None or common[p] <= most]
        pairs = some if len({p for _, p in some}) >= short else pairs
        n = len({p for _, p in pairs})
        late = {p for _, p in pairs if common[p] > rare}
        need = math.ceil(share * n - 1e-9) - len(late) if late else 0
        late, need = (late, need) if need > 0 else (set(), None)
        rows += [(k, label, False, len(pairs), n, " ".join(p), i, p not in late, need) for i, p in pairs]
    ids = {p: i for i, p in enumerate(sorted({r[5] for r in rows}))}
    rows = [(*r[:7], ids[r[5]], *(r[7:] or (True, None))) for r in rows]
    return spark.createDataFrame(rows, "template int, label string, base boolean, n_pairs int, n_distinct int, pair string, at int, id int, first boolean, need int")


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), NO_WORD), lambda w: w != "")


def places(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, place, id) of each pair of a text that a template has, and one row more for each document, with a null id.

    That row comes as a pair no text can hold, so one pass over the texts
    gives places and documents alike.
    """
    w = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words_of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("w"))
    both = F.zip_with("w", F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))  # the last is null
    rolling = w.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.posexplode(F.concat(both, F.array(F.lit("")))).alias("place", "pair"))
    rolling = rolling.where(F.col("pair").isNotNull()).withColumn("hash", F.xxhash64("pair"))
    end = F.struct(F.lit("").alias("pair"), F.lit(None).cast("int").alias("id"))
    table = pairs.select("pair", "id").distinct().unionByName(pairs.limit(1).select(end.alias("e")).select("e.*")).withColumn("hash", F.xxhash64("pair"))
    return rolling.join(F.broadcast(table), ["hash", "pair"]).drop("hash", "pair")  # its size is that of the templates


def hits(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, place, template, label, base, n_pairs, n_distinct, pair, at): the votes of each text, and for
    each document one row more with a null template.

    Pairs that vote first tell which templates a text may hold; for these the template's other pairs vote too.
    """
    found = materialize(places(docs, pairs), "places")
    pairs = pairs.drop("pair").withColumnRenamed("id", "pair")
    first, late = (F.broadcast(pairs.where(F.col("first") == x).drop("first")) for x in (True, False))
    votes = found.join(first, F.col("id") == F.col("pair"))
    may = votes.where("need is not null").groupBy("row", "template").agg(F.count(F.lit(1)).alias("n"), F.first("need").alias("need")).where("n >= need").select("row", "template")
    more = found.where("id is not null").join(may, "row").join(late, (F.col("id") == F.col("pair")) & (may["template"] == late["template"])).drop(may["template"])
    ends = found.where("id is null")
    return votes.unionByName(more).drop("id", "need").unionByName(ends.drop("id"), allowMissingColumns=True)


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, list[str]] = TEMPLATES, gap: int = 4, share: float = 0.8, texts: dict[tuple[str, ...], str] | None = None, common: int | None = None, short: int = SHORT, rare: int = COMMON) -> DataFrame:
    """One row for each document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, and spans (label, first and last word, score).

    A null or empty text has no words, no labels (empty strings) and score 0.
    ``texts``: words and label of paragraphs, by default of the whole licenses, in paragraphs of ``short`` words at least.
    All pairs vote: those in more than ``rare`` paragraphs where the others leave a span of ``share`` possible, so no label or span is lost.
    With ``common``, pairs in more paragraphs never vote unless fewer than ``short`` others are left.
    The score is the largest share of a template's distinct pairs that a span
    holds, 1 for a phrase of the base; below ``share`` pairs that had no vote may be missing in it. Spans are those of at least ``share``;
    those of one label that overlap stay apart if their templates differ.
    """
    texts = paragraphs(short) if texts is None else texts
    # One exchange: what follows groups and orders hits within a text.
    found = hits(docs, template_pairs(docs.sparkSession, phrases, templates, texts, common, short, rare, share)).repartition("row")
    found = found.withColumn("diagonal", F.col("place") - F.col("at"))
    # Votes by diagonal; each document's row without a template comes along.
    votes = found.groupBy("row", "doc_id", "n_words", "template", "label", "base", "n_pairs", "n_distinct", "diagonal").agg(
        F.count(F.lit(1)).alias("votes"), F.min("place").alias("low"), F.max("place").alias("high"), F.collect_set("pair").alias("pairs"))
    votes = votes.where(F.col("template").isNull() | ~F.col("base") | (F.col("votes") == F.col("n_pairs")))
    # A diagonal goes on from the one before it if both are near, in place and in diagonal.
    order = Window.partitionBy("row", "template").orderBy("diagonal", "low")
    near = (F.col("diagonal") - F.lag("diagonal").over(order) <= gap) & (F.col("low") - F.lag("high").over(order) <= gap) & ~F.col("base")
    group = Window.partitionBy("row", "template").orderBy("diagonal", "low").rowsBetween(Window.unboundedPreceding, 0)
    votes = votes.withColumn("new", F.when(near, 0).otherwise(1)).withColumn("span", F.sum("new").over(group))
    spans = votes.groupBy("row", "doc_id", "n_words", "template", "label", "base", "span").agg(
        F.min("low").alias("first"), (F.max("high") + 1).alias("last"), (F.size(F.array_distinct(F.flatten(F.collect_list("pairs")))) / F.first("n_distinct")).alias("score"))
    here, base = F.col("template").isNotNull() & (F.col("score") >= share), F.coalesce(F.col("base"), F.lit(False))
    text = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("label")))), ",")
    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        text(base).alias("base_labels"), text(here).alias("labels"), F.coalesce(F.max(F.when(F.col("template").isNotNull(), F.col("score"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(here, F.struct("first", "last", "label", "score")))).alias("spans")).drop("row")
