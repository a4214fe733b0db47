"""License scan by a positional rare-token index.

Licence templates are split into words; every template word has its postings (template, position). How many of the
corpus' documents hold each such word is counted over all of them, which gives the words' IDF. Each template keeps its
highest-IDF places in the index, as many as leave too few others to cover it: any start at which enough of the template
stands has one of them in place. They are looked up in each file for the templates whose mandatory key phrases stand
in it; every posting names the position at which its template would start. All these starts are verified: the key
phrases and enough of the template's words must be in their places. The best coverage counts, and it is that of all
starts there are.

Texts are split once: the shared folder keeps each file's count of words, its template words and, for those that pass
the gate, all words. Files without any substring that a key phrase needs cannot pass verification and are only
counted. The base phrases' places are found in the word array itself.

Everything is DataFrame and SQL functions. Defined cases: a null text is empty; texts without words have n_words 0;
no place gives null first_word and last_word, '' labels and score 0; repeated rows each get their own (equal) row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialize

#: Characters between words, upper case not yet lowered; splitting by a class of ASCII only is the fast way.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Share of a template that must stand in place.
MIN_COVERAGE = 0.6
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key_phrases: tuple[str, ...]


#: Notices by which public licences are stated, and phrases they can't be without.
TEMPLATES = [
    Template("agpl-3.0", "licensed under the gnu affero general public license version 3", ("affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("licensed under cc by 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("licensed under cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("licensed under cc by sa 4 0",)),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    Template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("mit-notice", "released under the mit license", ("mit license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("proprietary", "all rights reserved", ("all rights reserved",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, NOT_WORD), "")


def rows_of(spark, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A table of literals."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, r, strict=True)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def gate_pattern(templates: list[Template]) -> str:
    """Case-insensitive pattern of substrings, of which each accepted template or base phrase needs one."""
    phrases = [p for t in templates for p in t.key_phrases[:1]] + list(BASE.values())
    return "(?i)" + "|".join(sorted({re.escape(max(p.split(), key=len)) for p in phrases}))


def vocabulary(templates: list[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()})


def word_idf(known: DataFrame, templates: list[Template], n: int) -> DataFrame:
    """(word, idf) of the templates' vocabulary, from those of its words (column ``known``) that each document holds."""
    counts = known.select(F.explode("known").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    every = rows_of(known.sparkSession, ["word"], [(w,) for w in vocabulary(templates)])
    return every.join(counts, "word", "left").select("word", F.log((n + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0)).alias("idf"))


def least_in_place(t: Template) -> int:
    n = len(t.text.split())
    return next(k for k in range(n + 1) if k / n >= MIN_COVERAGE)


def template_index(idf: DataFrame, templates: list[Template]) -> DataFrame:
    """(word, postings): each template's rarest places, of which a start that passes has one in place at least."""
    rows = [(w, i, at, len(t.text.split()) - least_in_place(t) + 1) for i, t in enumerate(templates) for at, w in enumerate(t.text.split())]
    places = rows_of(idf.sparkSession, ["word", "template", "at", "needed"], rows).join(idf, "word")
    by_rarity = Window.partitionBy("template").orderBy(F.col("idf").desc(), "at")
    rare = places.withColumn("rank", F.row_number().over(by_rarity)).filter("rank <= needed")
    return rare.groupBy("word").agg(F.collect_list(F.struct("template", "at")).alias("postings"))


def base_places(words: Column) -> Column:
    """Array of (at, label), one for each place where a base phrase's words stand consecutively."""
    none = F.array().cast("array<struct<at:bigint,label:string>>")

    def of_phrase(label: str, phrase: list[str]) -> Column:
        def here(w: Column, i: Column) -> Column:
            found = w == phrase[0]
            for k in range(1, len(phrase)):
                found = found & (F.get(words, i + k) == phrase[k])
            return F.when(found, F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))

        return F.when(F.size(words) >= len(phrase), F.filter(F.transform(words, here), lambda p: p.isNotNull())).otherwise(none)

    return F.concat(*[of_phrase(label, phrase.split()) for label, phrase in BASE.items()])


def standing(words: Column, templates: list[Template]) -> Column:
    """Array of the templates all of whose key phrases stand in the file."""
    text = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))

    def here(i: int, t: Template) -> Column:
        phrases = F.lit(True)
        for p in t.key_phrases:
            phrases = phrases & F.contains(text, F.lit(f" {p} "))
        return F.when(phrases, F.lit(i))

    return F.array_compact(F.array(*[here(i, t) for i, t in enumerate(templates)]))


def candidates(gated: DataFrame, idf: DataFrame, templates: list[Template]) -> DataFrame:
    """(doc_key, candidates): for each file all starts, of the templates that may stand in it, that a rare place names."""
    # The index has one row for each word of the fixed templates, so its size does not depend on the data.
    index = F.broadcast(template_index(idf, templates))
    possible = gated.select("doc_key", "words", standing(F.col("words"), templates).alias("standing")).filter(F.size("standing") > 0)
    tokens = possible.select("doc_key", "standing", F.posexplode("words").alias("pos", "word")).join(index, "word")
    named = tokens.select("doc_key", "standing", "pos", F.explode("postings").alias("p")).filter(F.array_contains("standing", F.col("p.template")))
    starts = named.select("doc_key", "p.template", (F.col("pos") - F.col("p.at")).alias("start")).distinct()
    return starts.groupBy("doc_key").agg(F.collect_list(F.struct("template", "start")).alias("candidates"))


def verified(words: Column, found: Column, templates: list[Template]) -> Column:
    """Array of (label, coverage) of the templates of which a candidate passes, with the best coverage.

    A candidate passes where all key phrases stand in their places of the template and enough of its words do.
    """

    def check(i: int, t: Template) -> Column:
        tw = t.text.split()
        must = {k + j for p in t.key_phrases for k in [key_place(tw, p.split())] for j in range(len(p.split()))}

        def in_place(c: Column, k: int) -> Column:
            return F.coalesce((c["start"] + k >= 0) & (F.get(words, c["start"] + k) == tw[k]), F.lit(False))

        def keyed(c: Column) -> Column:
            return reduce(lambda a, b: a & b, [in_place(c, k) for k in sorted(must)], c["template"] == i)

        def coverage(c: Column) -> Column:
            return sum((in_place(c, k).cast("int") for k in range(len(tw))), F.lit(0)) / float(len(tw))

        best = F.array_max(F.transform(F.filter(found, keyed), coverage))
        return F.transform(F.filter(F.array(best), lambda b: b >= MIN_COVERAGE), lambda b: F.struct(F.lit(t.label).alias("label"), b.alias("coverage")))

    return F.concat(*[check(i, t) for i, t in enumerate(templates)])


def key_place(words: list[str], phrase: list[str]) -> int:
    """Where in the template its key phrase stands."""
    return next(k for k in range(len(words)) if words[k : k + len(phrase)] == phrase)


def scan_licenses(df: DataFrame, templates: list[Template] = TEMPLATES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, places, found): places of base phrases as (at, label), verified templates as (label, coverage)."""
    bare = F.coalesce(F.col(text), F.lit(""))
    docs = df.select(F.col(key), bare.alias("body")).withColumn("all_words", split_words(lower_ascii(F.col("body"))))
    docs = docs.select(
        key, F.xxhash64("body").alias("body_hash"), F.size("all_words").cast("long").alias("n_words"),
        F.array_intersect("all_words", F.array(*[F.lit(w) for w in vocabulary(templates)])).alias("known"),
        F.when(F.col("body").rlike(gate_pattern(templates)), F.col("all_words")).alias("words"),
    )
    # The one pass over the texts: counts and known words of all documents, all words of those that pass the gate.
    docs = materialize(docs, "license-words")
    idf = materialize(word_idf(docs, templates, docs.count()), "license-idf")
    places_type, found_type = "array<struct<at:bigint,label:string>>", "array<struct<label:string,coverage:double>>"
    rest = docs.filter("words is null").select(key, "n_words", F.array().cast(places_type).alias("places"), F.array().cast(found_type).alias("found"))
    gated = docs.filter("words is not null").select(key, F.struct(key, "body_hash").alias("doc_key"), "n_words", "words")
    found = candidates(gated.dropDuplicates(["doc_key"]), idf, templates).withColumnRenamed("doc_key", "c_key")
    same = (F.col("doc_key")[key].eqNullSafe(F.col("c_key")[key])) & (F.col("doc_key")["body_hash"] == F.col("c_key")["body_hash"])
    hits = gated.join(found, same, "left").select(
        key, "n_words", base_places(F.col("words")).cast(places_type).alias("places"),
        verified(F.col("words"), F.coalesce("candidates", F.array().cast("array<struct<template:int,start:int>>")), templates).cast(found_type).alias("found"),
    )
    return rest.unionByName(hits)


def op7_licenses(spark, sf_dir):
    s = scan_licenses(documents(spark, sf_dir))
    at = F.transform("places", lambda p: p["at"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    labels = F.array_sort(F.array_union(base, F.transform("found", lambda f: f["label"])))
    score = F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("found", lambda f: f["coverage"])), F.lit(0.0)))
    return s.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"),
    )
