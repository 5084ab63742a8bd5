"""Licence scans by a positional rare-token index, in DataFrame functions only.

Texts are words of ASCII letters and digits and other non-ASCII characters, A-Z lower-cased.  A first pass keeps, of each
whole text, the positions of words that occur in a licence template.  Over all texts it counts how many hold each such
word, which gives idf.  Each text's licence words, all of them, look up the templates' postings; those that agree on
where the template would begin, give or take a few words, count together.  A template is found if enough of the idf of its rare words is
there and one of its mandatory key phrases stands in the text, word by word.

The base labels come from three phrases whose words stand consecutively anywhere; they are always reported.

Defined results: null and empty texts have no words and no labels; repeated rows repeat; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.shared import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases whose words must stand consecutively, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label, words of the licence in their order, mandatory key phrases of which one must stand in the text.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("associated documentation files",)),
    ("apache", "licensed under the apache license version", ("apache license",)),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("compliance with the license", "apache license")),
    ("gpl", "licensed under the gnu general public license version", ("general public license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("general public license",)),
    ("lgpl", "licensed under the gnu lesser general public license version", ("lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license version", ("affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms",)),
    ("bsd", "released under the bsd license", ("bsd license",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    ("boost", "distributed under the boost software license version", ("boost software license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("modify and or distribute this software",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released",)),
    ("cc-by-nc", "licensed under cc by nc", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    ("cc-by", "licensed under a creative commons attribution license", ("creative commons attribution",)),
)
#: Words too common to be looked up; a key phrase is checked at its other words' places.
COMMON = ("a", "and", "any", "are", "at", "by", "can", "for", "in", "into", "is", "it", "may", "not", "of", "or", "that", "the", "this", "to", "use", "with", "you")
#: how far apart beginnings may lie, share of a template's rare idf that must be there
SLACK, SHARE = 8, 0.5


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(c, UPPER, LOWER)


def rare_words(words: str) -> list[tuple[int, str]]:
    """(place, word) of a phrase's words that are looked up."""
    return [(i, w) for i, w in enumerate(words.split()) if w not in COMMON]


def vocabulary() -> list[str]:
    """The words that are kept of a text: those of templates and of phrases."""
    return sorted({w for _, text, keys in TEMPLATES for x in (text, *keys) for _, w in rare_words(x)} | {w for p, _ in BASE for w in p.split()})


def licence_words(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) as (doc_id, n_words, found): found has (at, word) for each licence word, in order."""
    split = docs.select("doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), 0).alias("words"))
    known = vocabulary()
    places = F.when(F.size("words") > 0, F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.lower(F.get("words", i)).isin(known))).otherwise(F.array().cast("array<int>"))
    kept = split.select("doc_id", F.size("words").cast("long").alias("n_words"), F.transform(places, lambda i: F.struct(i.cast("long").alias("at"), lower_ascii(F.get("words", i)).alias("word"))).alias("found"))
    return kept.withColumn("found", F.filter("found", lambda x: x["word"].isin(known)))


def phrase_places(found: Column, words: str) -> Column:
    """Where a phrase begins, of the places found: all its words that are looked up stand where they should.

    As many places as the phrase is long come into question for each of them, one by one, so the work is linear in the places found.
    """
    parts = rare_words(words) if any(w in COMMON for w in words.split()) else list(enumerate(words.split()))
    (skip, first), rest = parts[0], parts[1:]

    def fits(k: Column) -> Column:
        own = F.get(found, k)

        def stands(i: int, w: str) -> Column:
            after = [F.get(found, k + d) for d in range(1, i - skip + 1)]
            return F.coalesce(reduce(lambda a, b: a | b, [F.coalesce((y["at"] == own["at"] + (i - skip)) & (y["word"] == w), F.lit(False)) for y in after]), F.lit(False))

        return reduce(lambda a, b: a & b, [stands(i, w) for i, w in rest], own["word"] == first)

    places = F.transform(F.filter(F.sequence(F.lit(0), F.size(found) - 1), fits), lambda k: F.get(found, k)["at"] - skip)
    return F.when(F.size(found) > 0, places).otherwise(F.array().cast("array<long>"))


def adjacent_places(found: Column, words: str) -> Column:
    """Where a phrase all of whose words are kept begins: its words are neighbours in found as well, so a look at the next ones is enough."""
    parts = words.split()
    last = F.size(found) - len(parts)
    at = lambda i, k: F.get(found, i + k)

    def fits(i: Column) -> Column:
        tests = [(at(i, k)["word"] == w) & (at(i, k)["at"] == at(i, 0)["at"] + k) for k, w in enumerate(parts)]
        return reduce(lambda a, b: a & b, tests)

    return F.when(last >= 0, F.transform(F.filter(F.sequence(F.lit(0), last), fits), lambda i: at(i, 0)["at"])).otherwise(F.array().cast("array<long>"))


def idf_by_word(found: DataFrame) -> dict[str, float]:
    """idf of the vocabulary's words over all texts: at most as many rows as it has words reach the driver."""
    n = found.count()
    held = found.select(F.explode(F.array_distinct(F.transform("found", lambda x: x["word"]))).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in held.collect()}
    return {w: math.log((1 + n) / (1 + counts.get(w, 0))) + 1 for w in vocabulary()}


def matches(spark: SparkSession, rows: DataFrame, idf: dict[str, float]) -> DataFrame:
    """(row, labels, score) of rows (row, found): the templates that are there and the best share of a template's rare idf."""
    postings = spark.sql("select * from values " + ", ".join(f"('{w}', {t}, {i}L, {idf[w]}D)" for t, (_, text, _) in enumerate(TEMPLATES) for i, w in rare_words(text)) + " as p(word, template, place, idf)")
    looked = rows.select("row", F.explode("found").alias("x")).select("row", "x.at", "x.word")
    hits = looked.join(F.broadcast(postings), "word").select("row", "template", "word", "idf", (F.col("at") - F.col("place")).alias("begin"))
    # a beginning counts for its own cell and the next, so that near beginnings meet in one of them
    cells = hits.select("row", "template", "word", "idf", F.explode(F.array(F.floor(F.col("begin") / SLACK), F.floor(F.col("begin") / SLACK) + 1)).alias("cell")).distinct()
    whole = {t: sum(idf[w] for w in {w for _, w in rare_words(text)}) for t, (_, text, _) in enumerate(TEMPLATES)}
    total = F.element_at(F.create_map(*[F.lit(x) for t, v in whole.items() for x in (t, v)]), F.col("template"))
    shares = cells.groupBy("row", "template", "cell").agg((F.sum("idf") / F.first(total)).alias("share")).filter(F.col("share") >= SHARE)
    best = shares.groupBy("row", "template").agg(F.max("share").alias("share")).groupBy("row").agg(F.collect_list(F.struct("template", "share")).alias("near"))
    verified = rows.select("row", "found").join(best, "row")
    said = [F.when(reduce(lambda a, b: a | b, [F.size(phrase_places(F.col("found"), k)) > 0 for k in keys]), F.lit(t)) for t, (_, _, keys) in enumerate(TEMPLATES)]
    verified = verified.withColumn("there", F.array_compact(F.array(*said)))
    ok = F.filter("near", lambda x: F.array_contains("there", x["template"]))
    names = F.create_map(*[F.lit(x) for t, (label, _, _) in enumerate(TEMPLATES) for x in (t, label)])
    return verified.select("row", F.transform(ok, lambda x: F.element_at(names, x["template"])).alias("named"), F.array_max(F.transform(ok, lambda x: F.least(x["share"], F.lit(1.0)))).alias("share"))


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of docs (doc_id, text).

    score is 1 with a base label, else the best share of a template that is found, else 0.
    """
    rows = written(spark, licence_words(docs).withColumn("row", F.monotonically_increasing_id()), "licence-words")
    base = [adjacent_places(F.col("found"), p) for p, _ in BASE]
    own = rows.select("row", "doc_id", "n_words", *(c.alias(f"p{k}") for k, c in enumerate(base)))
    places = F.concat(*(f"p{k}" for k in range(len(BASE))))
    labels = F.array_compact(F.array(*(F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE))))
    out = own.join(matches(spark, rows, idf_by_word(rows)), "row", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(labels, F.coalesce("named", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.when(F.size(labels) > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
