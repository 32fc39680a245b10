"""License scans: exact set-similarity join of text blocks with license templates.

A block (a line, unless told otherwise) meets a template if it holds at least a share
`threshold` of the template's distinct words. Words are ordered by how many documents
hold them, rarest first. With k = ceil(threshold * size), a block that meets a template
must hold one of the template's first size - k + 1 words (prefix filter), at least k
words of the templates (length filter), and its first common prefix word must leave
enough words after it on both sides (positional filter); what passes is counted. The
templates are a parameter of fixed size, so their words are literals of the plan, and
blocks are met inside their own row, without any shuffle.

With `wrapped`, blocks are besides all runs of neighbouring words of a paragraph as long as
the template's text over the threshold, so a notice may be broken over lines.

Definite results: a null text is the empty text; null ids are kept; repeated rows are
scanned one by one; blank blocks meet nothing; an empty table gives no rows. Result columns
start with `l_`; where a column of the input does too, they start with `l__` (and so on).
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import free_prefix, named
from counterfoil.llm.quality import only_once

# Phrases and labels of the base scan.
PHRASES = {
    "mit": ("mit", "license"),
    "apache": ("apache", "license"),
    "gpl": ("general", "public", "license"),
}

# Notices by which works name their license, and their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("all-rights-reserved", "All rights reserved."),
)
THRESHOLD = 0.8

_BLANK_LINE = r"\n[\x20\x09\x0D]*\n"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    """Distinct words of a template."""
    return list(dict.fromkeys(re.findall(r"[0-9a-z]+", text.lower())))


def needed(size: int, threshold: float) -> int:
    """The fewest common words that meet the threshold."""
    return math.ceil(round(threshold * size, 9))


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    pure = F.length(text) == F.octet_length(text)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def words_in(text: Column) -> Column:
    return F.array_remove(F.split(text, _NO_WORD), "")


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def word_order(docs: DataFrame, words: list[str], text_col: str = "text") -> list[str]:
    """Words by the number of documents that hold them, rarest first.

    Counts all documents; collects one row per word of the templates.
    """
    text = lowered(F.coalesce(named(text_col).cast("string"), F.lit("")))
    held = docs.select(F.explode(F.array_intersect(words_in(text), _strings(words))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(words, key=lambda w: (counts.get(w, 0), w))


def _phrase_places(words: Column, phrase: tuple[str, ...]) -> Column:
    def here(i: Column) -> Column:
        return reduce(
            lambda a, b: a & b,
            (F.coalesce(F.get(words, i + k) == w, F.lit(False)) for k, w in enumerate(phrase)),
        )

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def scanned(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD, separator: str = "\n", text_col: str = "text",
    wrapped: bool = False,
) -> DataFrame:
    """docs with l_n_words, the places of each base phrase in l_places, and l_hits.

    l_hits: array of (label, score) of every template that some block meets, score being
    the share of the template's words in its best block.
    """
    sets = [(label, template_words(text)) for label, text in templates]
    vocabulary = sorted({w for _, words in sets for w in words})
    order = word_order(docs, vocabulary, text_col)
    rank = {w: k for k, w in enumerate(order)}
    sets = [(label, sorted(words, key=rank.__getitem__)) for label, words in sets]
    lengths = [len(re.findall(r"[0-9a-z]+", text.lower())) for _, text in templates]
    spans = [math.ceil(round(n / threshold, 9)) for n in lengths]
    needs = [needed(len(words), threshold) for _, words in sets]
    prefixes = [words[: len(words) - k + 1] for (_, words), k in zip(sets, needs, strict=True)]

    p = free_prefix(docs, "l_")
    prepared = docs.withColumn(
        f"{p}text", lowered(F.coalesce(named(text_col).cast("string"), F.lit("")))
    ).withColumn(f"{p}words", words_in(F.col(f"{p}text")))
    words = F.col(f"{p}words")
    none = F.array().cast("array<int>")
    places = F.struct(
        *(
            F.when(F.array_contains(words, phrase[-1]), _phrase_places(words, phrase))
            .otherwise(none)
            .alias(label)
            for label, phrase in PHRASES.items()
        )
    )
    # template words of each block, rarest first, of documents with any prefix word
    blocks = F.filter(
        F.transform(
            F.split(f"{p}text", separator),
            lambda b: F.array_intersect(_strings(order), words_in(b)),
        ),
        lambda b: F.size(b) >= min(needs, default=1),
    )
    any_prefix = _strings(sorted({w for p in prefixes for w in p}))
    prepared = prepared.withColumn(
        f"{p}blocks",
        F.when(F.arrays_overlap(words, any_prefix), blocks).otherwise(
            F.array().cast("array<array<string>>")
        ),
    )

    def best(own: list[str], prefix: list[str], need: int) -> Column:
        template = _strings(own)

        def common(block: Column) -> Column:
            first = F.get(F.array_intersect(_strings(prefix), block), 0)
            i, j = F.array_position(template, first), F.array_position(block, first)
            room = F.least(i, j) + F.least(len(own) - i, F.size(block) - j)
            may = (F.size(block) >= need) & first.isNotNull() & (room >= need)
            return F.when(may, F.size(F.array_intersect(template, block))).otherwise(0)

        return F.coalesce(F.array_max(F.transform(f"{p}blocks", common)), F.lit(0))

    def in_window(own: list[str], need: int, span: int) -> Column:
        template = _strings(own)

        def most(words: Column) -> Column:
            starts = F.filter(
                F.sequence(F.lit(0), F.size(words) - 1),
                lambda i: F.array_contains(template, F.get(words, i)),
            )
            return F.array_max(
                F.transform(
                    starts, lambda i: F.size(F.array_intersect(template, F.slice(words, i + 1, span)))
                )
            )

        # windows are looked at only where the paragraph holds enough words
        paragraphs = F.filter(
            F.transform(F.split(f"{p}text", _BLANK_LINE), words_in),
            lambda own_words: F.size(F.array_intersect(template, own_words)) >= need,
        )
        enough = F.size(F.array_intersect(template, f"{p}words")) >= need
        return F.when(enough, F.coalesce(F.array_max(F.transform(paragraphs, most)), F.lit(0))).otherwise(0)

    def score(own: list[str], prefix: list[str], need: int, span: int) -> Column:
        line = best(own, prefix, need)
        return F.greatest(line, in_window(own, need, span)) if wrapped else line

    hits = [
        F.struct(
            F.lit(label).alias("label"),
            (score(own, prefix, need, span) / F.lit(float(len(own)))).alias("score"),
            F.lit(need / len(own)).alias("need"),
        )
        for (label, own), prefix, need, span in zip(sets, prefixes, needs, spans, strict=True)
    ]
    found = F.filter(F.array(*hits), lambda h: h["score"] >= h["need"] - 1e-9)
    no_hits = F.array().cast("array<struct<label: string, score: double, need: double>>")
    return prepared.withColumn(
        f"{p}all",
        only_once(
            F.size(f"{p}words").cast("long").alias(f"{p}n_words"),
            places.alias(f"{p}places"),
            F.when(F.lit(wrapped) | (F.size(f"{p}blocks") > 0), found).otherwise(no_hits).alias(f"{p}hits"),
        ),
    ).select(*map(named, docs.columns), f"{p}all.*")
