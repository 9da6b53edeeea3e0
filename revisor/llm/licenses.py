"""License scan by a positional rare-token index (operator 5), DataFrame functions only.

Two kinds of finds:

* *base phrases*: every place where the words of a phrase stand one after the
  other;
* *templates*: licence notices, found through their rarest words.  Document
  frequencies of all template words are counted over the whole corpus; the
  word of highest IDF in a template's mandatory key phrases indexes it.  In a text
  every occurrence of an indexed word votes, through the postings (template,
  position), for the place where the template would have to start.  A place
  counts if every mandatory key phrase stands there and the IDF of the template's
  words that stand where they should reaches ``MIN_SHARE`` of the IDF of all of
  them.  A place that counts holds the phrases and so the word that votes for it:
  none is lost, whatever else in the notice was altered.

Only texts that hold the rarest word of some base phrase or key phrase are looked
at word by word; the others can't hold any.  Words are cut and folded A-Z over
the whole text.

Defined cases: a null text is empty: no words, no labels, score 0; null ids and
repeated rows are scanned one by one; a text of any length is one row's array of
words; ties between templates at one place keep both
labels; an empty table counts no words and gives no rows; columns beyond id and
text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisor.llm.common import rename_free

#: What parts the words of a folded text, and the base phrases.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Licence notices (label, words, mandatory key phrases).
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the license",
     ["except in compliance with the license"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the "
                   "gnu general public license", ["free software", "gnu general public license"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("mit-notice", "released under the mit license", ["mit license"]),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ["permission is hereby granted free of charge"]),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted",
     ["redistribution and use in source and binary forms"]),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee "
                 "is hereby granted", ["with or without fee is hereby granted"]),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license v 2 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright",
     ["to the extent possible under law"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
]
MIN_SHARE = 0.7
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, folded; a null text has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), GAP), "")


def vocabulary() -> list[str]:
    return sorted({w for _, text, _ in TEMPLATES for w in text.split()})


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[dict[str, int], int]:
    """In how many documents each template word occurs, and the number of documents."""
    vocab = vocabulary()
    listed = F.array_intersect(words_of(F.col("text")), F.array(*[F.lit(w) for w in vocab]))
    # one row for the document itself, marked by the empty string, which is no word
    marked = rename_free(docs, text=text_col).select(F.explode(F.array_append(listed, F.lit(""))).alias("word"))
    counts = {r["word"]: r["n"] for r in marked.groupBy("word").agg(F.count("*").alias("n")).collect()}
    total = counts.pop("", 0)
    return {w: counts.get(w, 0) for w in vocab}, total


def idf(frequency: int, total: int) -> float:
    return math.log((1 + total) / (1 + frequency)) + 1.0


def index(weights: dict[str, float]) -> dict[str, list[tuple[int, int]]]:
    """Postings, word to (template, position): the rarest word of each template's key phrases; ties go by the word."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, (_, text, phrases) in enumerate(TEMPLATES):
        body = text.split()
        held = [(w, _position(body, phrase.split()) + k) for phrase in phrases for k, w in enumerate(phrase.split())]
        word, at = min(held, key=lambda x: (-weights[x[0]], x))
        postings.setdefault(word, []).append((t, at))
    return postings


def _stands(words: Column, start: Column, phrase: list[str]) -> Column:
    """Whether the phrase's words stand at ``start`` (from 0), within the text."""
    test = (start >= 0) & (start + len(phrase) <= F.size(words))
    for k, w in enumerate(phrase):
        test = test & (F.get(words, start + k) == w)
    return test


def _base_places(words: Column) -> Column:
    """Array of (start, end, label) of all base phrases."""
    phrases = [(p.split(), label) for p, label in BASE_PHRASES.items()]
    first = sorted({p[0] for p, _ in phrases})

    def at(w: Column, i: Column) -> Column:
        found = F.lit(None).cast("struct<start:int,last:int,label:string>")
        for phrase, label in phrases:
            place = F.struct(i.alias("start"), (i + len(phrase) - 1).alias("last"), F.lit(label).alias("label"))
            found = F.when((w == phrase[0]) & _stands(words, i, phrase), place).otherwise(found)
        return F.when(w.isin(first), found)

    return F.filter(F.transform(words, at), lambda x: x.isNotNull())


def _template_places(words: Column, weights: dict[str, float]) -> Column:
    """Array of (template, share) of all template places that reach the share and hold the key phrases."""
    postings = index(weights)
    kind = "array<struct<template:int,start:int>>"

    def votes(w: Column, i: Column) -> Column:
        found = F.lit(None).cast(kind)
        for word, places in sorted(postings.items()):
            own = F.array(*[F.struct(F.lit(t).alias("template"), (i - p).cast("int").alias("start")) for t, p in places])
            found = F.when(w == word, own).otherwise(found)
        return F.when(w.isin(sorted(postings)), found)

    starts = F.array_distinct(F.flatten(F.filter(F.transform(words, votes), lambda x: x.isNotNull())))

    def judged(vote: Column) -> Column:
        share = F.lit(0.0)
        for t, (_, text, phrases) in enumerate(TEMPLATES):
            body = text.split()
            total = sum(weights[w] for w in body)
            start = vote["start"]
            present = F.lit(0.0)
            for k, w in enumerate(body):
                here = (start + k >= 0) & (F.get(words, F.greatest(start + k, F.lit(0))) == w)
                present = present + F.when(here, F.lit(weights[w] / total)).otherwise(0.0)
            must = F.lit(True)
            for phrase in phrases:
                must = must & _stands(words, start + _position(body, phrase.split()), phrase.split())
            share = F.when(vote["template"] == t, F.when(must, present).otherwise(0.0)).otherwise(share)
        return F.struct(vote["template"].alias("template"), F.least(share, F.lit(1.0)).alias("share"))

    return F.filter(F.transform(starts, judged), lambda x: x["share"] >= MIN_SHARE)


def _position(body: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(body)) if body[i:i + len(phrase)] == phrase)


def _required(weights: dict[str, float]) -> list[str]:
    """The rarest word of every base phrase and of every template's first key phrase."""
    phrases = [p for p in BASE_PHRASES] + [phrases[0] for _, _, phrases in TEMPLATES]
    return sorted({max(p.split(), key=lambda w: (weights.get(w, 0.0), w)) for p in phrases})


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         frequencies: tuple[dict[str, int], int] | None = None) -> DataFrame:
    """One row per document: word count, base places, labels and the best template share.

    ``frequencies`` (word to document count, number of documents) default to
    those of ``docs`` itself.
    """
    counts, total = frequencies or document_frequencies(docs, text_col)
    weights = {w: idf(n, total) for w, n in counts.items()}
    labels = F.array(*[F.lit(label) for label, _, _ in TEMPLATES])
    none = F.array().cast("array<string>")
    rows = rename_free(docs, doc_id=id_col, text=text_col).select("doc_id", words_of(F.col("text")).alias("all"))
    may_hold = F.arrays_overlap("all", F.array(*[F.lit(w) for w in _required(weights)]))
    rows = rows.select("doc_id", F.size("all").cast("long").alias("n_words"),
                       F.when(may_hold, F.col("all")).otherwise(none).alias("words"))
    rows = rows.select("doc_id", "n_words", _base_places(F.col("words")).alias("base"),
                       _template_places(F.col("words"), weights).alias("found"))
    base_labels = F.array_distinct(F.transform("base", lambda x: x["label"]))
    all_labels = F.array_union(base_labels, F.transform("found", lambda x: F.get(labels, x["template"])))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(all_labels), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0)).alias("score"))
