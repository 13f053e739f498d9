"""License scans: fixed phrases, and an exact set-similarity join with templates (native).

A text block meets a template when the block's words hold at least `threshold`
of the template's different words. Blocks are lines, and, wherever lines break,
runs of words of the text: of as many words as the template has, and as many
more as may be missing (its length divided by `threshold`). The join is exact:

* words are ordered by the count of texts that hold them in the whole corpus,
  rarest first; only words of some template can be shared, so only those are
  counted and kept;
* prefix: a block that shares a of a template's n words holds one of the
  template's n - a + 1 rarest;
* length: the block has a or more template words, and so has its whole text;
* position: where a shared word has i words of the template and j of the block
  before it, no more than min(i, j) + min(n - i, m - j) words can be shared.

Runs are looked for around each word of a prefix: the filters hold for all words
that a run with it can reach, and the best run among these is then counted.

What passes is verified by counting. Every text is split once; the rest works on
a written table of the words that count. The templates are a parameter, so their
words (some hundreds) are the only side that is broadcast.

Edge cases: null and empty texts have no words, no labels and score 0. A line
of any length is one block, too. Rows that repeat an id get the labels of their own
text.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skysift.llm.common import written

#: The phrases of the base labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices as they commonly stand in texts, with the labels they give.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

_SEP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _python_words(text: str) -> list[str]:
    return re.findall(_WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def lowered(text: Column) -> Column:
    """`text` in lower case, where A-Z are the only letters that become a-z.

    `lower` is far cheaper than a translation of 26 letters. Of the other letters it makes a letter a-z of the
    Kelvin sign alone, which is put aside, and an i with a mark, a word's character outside ASCII, of the dotted I.
    """
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u212b")))


def _literal(words: list) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _holds(words: Column, wanted: list[str], least: int) -> Column:
    """Whether `words`, all different, hold `least` or more of the `wanted`."""
    return F.size(F.array_intersect(words, _literal(wanted))) >= least


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return F.coalesce(out, F.lit(False))


class Templates:
    """Word sets of labelled templates, with the numbers of words that a block must share."""

    def __init__(self, templates, threshold: float) -> None:
        self.labels = [label for label, _ in templates]
        self.sets = [sorted(set(_python_words(text))) for _, text in templates]
        self.least = [math.ceil(threshold * len(words) - 1e-9) for words in self.sets]
        self.reach = [math.ceil(len(_python_words(text)) / threshold - 1e-9) for _, text in templates]
        self.vocabulary = sorted({w for words in self.sets for w in words})


def read_words(docs: DataFrame, phrases: dict[str, str], wanted: Templates) -> DataFrame:
    """A written table of `docs` (id, text_hash, lowered), which reads every text once.

    n_words; held: the words of templates in the text; at, found: places and labels of the phrases. Of texts that
    hold enough words of some template also, by number in the vocabulary, lines: the template words of each line,
    and placed: those of the text with their places, where lines break.
    """
    vocabulary = _literal(wanted.vocabulary).cast("array<string>")
    number = F.create_map(*[x for i, w in enumerate(wanted.vocabulary) for x in (F.lit(w), F.lit(i))]).cast("map<string,int>")
    known = sorted({*wanted.vocabulary, *(w for p in phrases for w in p.split())})
    split = docs.select("id", "text_hash", "lowered", F.split("lowered", _SEP + "+").alias("words"))
    # A separator at either end of the text leaves an empty word there.
    first = F.when(F.col("words")[0] == "", 1).otherwise(0)
    last = F.when((F.size("words") > 1) & (F.element_at("words", -1) == ""), 1).otherwise(0)
    split = split.withColumn("held", F.array_intersect("words", _literal(known).cast("array<string>")))
    may_meet = _any([_holds(F.col("held"), words, least) for words, least in zip(wanted.sets, wanted.least, strict=True)])
    may_hold = _any([_holds(F.col("held"), sorted(set(p.split())), len(set(p.split()))) for p in phrases])
    split = split.select("id", "text_hash", "lowered", "words", "held", (F.size("words") - first - last).cast("long").alias("n_words"), first.alias("shift"), may_meet.alias("may_meet"), may_hold.alias("may_hold"))

    place = lambda x: x["i"] - F.col("shift")
    numbered = F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i")))

    def starts(phrase: list[str]) -> Column:
        here = lambda x: _all([(x["w"] if k == 0 else F.get("words", x["i"] + k)) == word for k, word in enumerate(phrase)])
        return F.transform(F.filter(numbered, here), place)

    at = F.flatten(F.array(*[starts(p.split()) for p in phrases])) if phrases else F.array().cast("array<int>")
    met = F.array(*[F.when(F.size(starts(p.split())) > 0, F.lit(label)) for p, label in phrases.items()]) if phrases else F.array().cast("array<string>")
    in_line = lambda line: F.transform(F.array_intersect(F.split(line, _SEP + "+"), vocabulary), lambda w: F.element_at(number, w))
    lines = F.transform(F.split("lowered", "\n"), in_line)
    # Equal lines of a document are one block.
    lines = F.array_distinct(F.filter(F.transform(lines, lambda line: F.array_sort(line)), lambda line: F.size(line) >= min(wanted.least, default=0)))
    placed = F.transform(F.filter(numbered, lambda x: x["w"].isin(wanted.vocabulary)), lambda x: F.struct(place(x).alias("i"), F.element_at(number, x["w"]).alias("word")))
    read = split.select(
        "id",
        "text_hash",
        "n_words",
        F.array_intersect("held", vocabulary).alias("held"),
        F.when(F.col("may_hold"), at).alias("at"),
        F.when(F.col("may_hold"), F.array_sort(F.array_distinct(F.array_compact(met)))).otherwise(F.array().cast("array<string>")).alias("found"),
        F.when(F.col("may_meet"), lines).alias("lines"),
        # One line has no run that it does not hold itself.
        F.when(F.col("may_meet") & F.col("lowered").contains("\n"), placed).alias("placed"),
    )
    return written(read, "license-words")


def template_join(read: DataFrame, wanted: Templates) -> DataFrame:
    """All (id, text_hash, label, containment) of blocks of the texts of `read_words` that meet a template."""
    counts = dict(read.select(F.explode("held").alias("w")).groupBy("w").count().collect())  # as many rows as the templates have words
    vocabulary, least, sets = wanted.vocabulary, wanted.least, wanted.sets
    rank = {w: r for r, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    ordered = [sorted(rank[w] for w in words) for words in sets]
    prefixes = [(k, ranks[i], i) for k, ranks in enumerate(ordered) for i in range(len(ranks) - least[k] + 1)]
    heads = sorted({r for _, r, _ in prefixes})
    rank_of = _literal([rank[w] for w in vocabulary]).cast("array<int>")
    met_words = read.filter(F.col("lines").isNotNull()).select(
        "id",
        "text_hash",
        F.transform("lines", lambda line: F.array_sort(F.transform(line, lambda w: F.get(rank_of, w)))).alias("lines"),
        F.transform("placed", lambda x: F.struct(x["i"].alias("i"), F.get(rank_of, x["word"]).alias("rank"))).alias("placed"),
    )
    blocks = met_words.select("id", "text_hash", F.explode("lines").alias("ranks"))
    rows = [(k, r, i, least[k], len(ordered[k]), ordered[k], wanted.labels[k], wanted.reach[k]) for k, r, i in prefixes]
    heads_table = read.sparkSession.createDataFrame(rows, "template int, rank int, i int, least int, n int, wanted array<int>, label string, reach int")
    met = blocks.select("id", "text_hash", "ranks", F.posexplode("ranks").alias("j", "rank")).join(F.broadcast(heads_table), "rank")
    m = F.size("ranks")
    bound = F.least("i", "j") + F.least(F.col("n") - F.col("i"), m - F.col("j"))
    passes = (m >= F.col("least")) & (bound >= F.col("least"))
    met = met.filter(passes)
    shared = F.size(F.array_intersect("ranks", "wanted"))
    found = [F.col(c) for c in ("id", "text_hash", "label")]
    in_lines = met.select(*found, shared.alias("shared"), "least", (shared / F.col("n")).alias("containment"))
    # The words that any run with this word can hold: as many before and after it as the longest run has.
    far = max(wanted.reach, default=1)
    around = F.slice("placed", F.greatest(F.col("at") - far + 2, F.lit(1)), F.lit(2 * far - 1))
    runs = met_words.select("id", "text_hash", "placed", F.posexplode("placed").alias("at", "word")).filter(F.col("word.rank").isin(heads))
    runs = runs.select("id", "text_hash", F.col("word.rank").alias("rank"), F.col("word.i").alias("place"), around.alias("around")).join(F.broadcast(heads_table), "rank")
    runs = runs.withColumn("around", F.filter("around", lambda x: F.abs(x["i"] - F.col("place")) < F.col("reach")))
    runs = runs.withColumn("ranks", F.array_sort(F.array_distinct(F.transform("around", lambda x: x["rank"])))).withColumn("j", F.array_position("ranks", F.col("rank")).cast("int") - 1).filter(passes)
    # Only words of the template count in the runs.
    runs = runs.withColumn("around", F.filter("around", lambda x: F.array_contains("wanted", x["rank"]))).filter(F.size(F.array_intersect("ranks", "wanted")) >= F.col("least"))
    run = lambda x: F.filter("around", lambda y: (y["i"] >= x["i"]) & (y["i"] < x["i"] + F.col("reach")))
    best = F.array_max(F.transform("around", lambda x: F.size(F.array_distinct(F.transform(run(x), lambda y: y["rank"])))))
    in_runs = runs.select(*found, best.alias("shared"), "least", (best / F.col("n")).alias("containment"))
    return in_lines.unionByName(in_runs).filter(F.col("shared") >= F.col("least")).select(*found, "containment")


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", phrases=None, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row a document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the largest containment found, and 1 where a phrase stands.
    """
    wanted = Templates(templates, threshold)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), lowered(F.col(text_col)).alias("lowered"))
    base = read_words(rows, PHRASES if phrases is None else phrases, wanted)
    more = template_join(base, wanted).groupBy("id", "text_hash").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    more = written(more, "license-found")
    same = F.col("b.id").eqNullSafe(F.col("m.id")) & (F.col("b.text_hash") == F.col("m.text_hash"))
    joined = base.select("id", "text_hash", "n_words", "at", "found").alias("b").join(more.alias("m"), same, "left")
    every = F.array_sort(F.array_union("found", F.coalesce("more", F.array().cast("array<string>"))))
    n_base = F.coalesce(F.size("at"), F.lit(0))
    return joined.select(
        F.col("b.id").alias(id_col),
        "n_words",
        F.when(F.col("at").isNull(), F.lit(0)).otherwise(n_base).cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"),
        F.array_join("found", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("found") > 0, 1.0).otherwise(0.0)).alias("score"),
    )
