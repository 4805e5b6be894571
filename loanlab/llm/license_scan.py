"""Operator 2: licence scan by a positional rare-token index (DataFrame functions only).

A template is a notice with a mandatory key phrase.  Its words are ranked by IDF over all documents
(one aggregation over the licence vocabulary).  A file's licence words, highest IDF first, name the
templates to try; a template's postings are the places of its key phrase's two rarest words.
Subtracting the place in the template from each place in the file gives offsets; offsets common to
both words are verified on the whole key phrase.  The score is the largest share of a
template's IDF that stands at its place.

Everything after the IDF pass happens within the row of a file: no shuffle, no join, no hot key.

Words: A-Z lower-cased, runs outside ASCII separators.  ``lower`` also lower-cases other
letters; the only one that becomes a plain ASCII letter alone is the Kelvin sign, and no
template has a word with k.

Defined results: null or empty text: no words, no labels (empty strings), score 0, first_word and
last_word null; repeated rows are returned as often as they occur; other columns are not read.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases with their labels, and the notices that the method adds
# (label, notice, key phrase).
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
TEMPLATES = (
    ("mit", "released under the mit license", "under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution"),
    ("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license version 3", "gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license version 2 0", "mozilla public license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("unlicense", "free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
)


def words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS), "")


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, notice, _ in templates for w in notice.split()})


def idf(docs: DataFrame, text_col: str = "text", templates=TEMPLATES) -> dict[str, float]:
    """IDF over all documents of the words of the templates (a fixed, small vocabulary)."""
    vocab = F.array(*[F.lit(w) for w in vocabulary(templates)])
    there = docs.select(words(text_col).alias("w")).select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(vocab, "w"))).alias("w"))
    seen = {r.w: r.n for r in there.groupBy("w").agg(F.count("*").alias("n")).collect()}
    total = seen.get("", 0)  # the empty word stands for every document
    return {w: math.log((total + 1) / (seen.get(w, 0) + 1)) + 1e-6 for w in vocabulary(templates)}


def _lits(ws) -> Column:
    return F.array(*[F.lit(w) for w in ws])


def _places(word: str) -> Column:
    """Places of a word in the file."""
    return F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", i) == F.lit(word))


def _shifted(places: Column, at: int) -> Column:
    return F.transform(places, lambda i: i - at)


def _starts(phrase: list[str], weight: dict[str, float]) -> Column:
    """Starts of a phrase in the file: offsets of its two rarest words, intersected, then verified."""
    rare = sorted(set(phrase), key=lambda x: (-weight[x], x))[:2]
    offsets = [_shifted(_places(x), phrase.index(x)) for x in rare]
    if len(offsets) == 1:  # a phrase of one distinct word
        offsets *= 2
    common = F.filter(F.array_intersect(*offsets), lambda o: (o >= 0) & (o + len(phrase) <= F.size("w")))
    exact = F.filter(common, lambda o: F.slice("w", o + 1, len(phrase)) == _lits(phrase))
    return F.when(F.forall(_lits(rare), lambda x: F.array_contains(F.col("present"), x)), exact).otherwise(F.array().cast("array<int>"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, base=BASE) -> DataFrame:
    """One row for each document; see the module for the columns."""
    weight = idf(docs, text_col, templates)
    ranked = sorted(weight, key=lambda x: (-weight[x], x))
    out = docs.select(F.col(id_col).alias("doc_id"), words(text_col).alias("w"))
    out = out.select("doc_id", "w", F.array_intersect(_lits(ranked), F.col("w")).alias("present"))
    cols = {}
    for t, (_, _, key) in enumerate(templates):
        cols[f"t{t}"] = _starts(key.split(), weight)
    for p, (_, phrase) in enumerate(base):
        same = next((t for t, (_, _, key) in enumerate(templates) if key == phrase), None)
        cols[f"b{p}"] = _starts(phrase.split(), weight) if same is None else None
    out = out.select("*", *[c.alias(n) for n, c in cols.items() if c is not None])
    base_cols = [f"b{p}" if cols[f"b{p}"] is not None else f"t{next(t for t, x in enumerate(templates) if x[2] == phrase)}" for p, (_, phrase) in enumerate(base)]

    def share(t: int) -> Column:
        _, notice, key = templates[t]
        ws, start = notice.split(), " ".join(notice.split()).split(key)[0].count(" ")
        total = sum(weight[x] for x in ws)
        at = lambda o: sum((F.when(F.get("w", o + (j - start)) == F.lit(x), F.lit(weight[x] / total)).otherwise(0.0) for j, x in enumerate(ws)), F.lit(0.0))
        return F.when(F.size(f"t{t}") > 0, F.array_max(F.transform(f"t{t}", lambda o: at(o)))).otherwise(0.0)

    every = F.concat(*base_cols)
    labels = lambda pairs: F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(F.size(c) > 0, F.lit(x)) for x, c in pairs]), lambda x: x.isNotNull()))), ",")
    own = [(label, f"t{t}") for t, (label, _, _) in enumerate(templates)]
    based = [(label, c) for (label, _), c in zip(base, base_cols)]
    return out.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        labels(based).alias("base_labels"), labels(own + based).alias("labels"),
        F.round(F.least(F.lit(1.0), F.greatest(*[share(t) for t in range(len(templates))])), 6).alias("score"))
