"""License scan: exact set-similarity join of text blocks with license notices.

A notice is a label, its words and the share of its distinct words that a block
must hold. Blocks of a document are its sentences and lines and, whatever line ends and
comment marks stand in it, the overlapping windows of twice the notice's length over the whole
text, begun at every length-th word. References, short forms that name a license ("released under
the MIT License", SPDX identifiers), are notices with a share of one whose blocks are all
windows of their own length and whose words must stand in order there. The join finds
every block that holds a notice:

* order: the words of all notices stand in one global order, rarest first, by
  the number of documents of the whole corpus that hold them (ties by word);
* prefix: of m distinct words with o = ceil(share * m) needed, a holding block has one of
  the notice's first m - o + 1. An inverted index from these words to their
  notices is looked up with the words of a document: a document without any of them
  is done, the others visit the notices they hit, and of those only
  the windows that reach a hit;
* length: the block has at least o words of notices;
* position: from the first shared word on, at least o words must be left in
  block and notice.

Notices are an argument, a list the size of a rule book, not of the corpus: as a literal index
the join runs inside each row, without explode or shuffle and with
nothing for a hot document or notice to gather on. Only the frequency table,
one row per notice word, comes to the driver.

Beside it the fixed phrases are located word by word in the whole text.

Defined cases: null and empty texts have no words and no labels; one row comes
out for every row that comes in, repeated or not; null ids stay null; an empty
table gives an empty result; other columns are ignored; texts are read whole.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# Fixed phrases and the labels they carry.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


class Notice(NamedTuple):
    """Words of a notice in lower case, single spaces between; ``share`` of them as (part, whole)."""

    label: str
    text: str
    share: tuple[int, int] = (8, 10)
    in_order: bool = False


# Fixed texts: opening or telling sentences of licenses.
TEMPLATES = [
    Notice("apache-2.0", "licensed under the apache license version 2 0"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
                  "that the following conditions are met"),
    Notice("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    Notice("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    Notice("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                  "associated documentation files"),
    Notice("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Notice("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license", (1, 1)),
    Notice("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", (1, 1)),
    Notice("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    Notice("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    Notice("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    Notice("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", (1, 1)),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Notice("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license", (1, 1)),
    Notice("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    Notice("odbl", "this database is made available under the open database license"),
    Notice("ofl-1.1", "this font software is licensed under the sil open font license version 1 1"),
    Notice("unlicense", "this is free and unencumbered software released into the public domain"),
    Notice("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
]
# Names and SPDX identifiers by which a short notice refers to a license, as words. Fixed texts.
NAMES = {
    "apache-2.0": ("apache license 2 0", "apache license v2 0", "apache license version 2 0", "apache license v 2 0", "apache license v2",
                   "apache license version 2", "apache 2 0", "apache 2 license"),
    "bsd": ("bsd license", "bsd licence", "bsd 2 clause", "bsd 3 clause", "2 clause bsd", "3 clause bsd", "two clause bsd", "three clause bsd",
            "new bsd license", "modified bsd license", "revised bsd license", "simplified bsd license"),
    "cc-by-4.0": ("cc by 4 0", "creative commons attribution 4 0"),
    "cc-by-nc-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0", "creative commons attribution non commercial 4 0"),
    "gpl-3.0": ("gpl 3 0", "gpl v3", "gpl v3 0", "gplv3", "gpl version 3", "general public license 3 0", "general public license v3",
                "general public license v3 0", "general public license version 3"),
    "mit": ("mit license", "mit licence", "expat license", "expat licence"),
    "mpl-2.0": ("mpl 2 0", "mpl v2 0", "mpl version 2 0", "mozilla public license 2 0", "mozilla public license v2 0", "mozilla public license v 2 0",
                "mozilla public license version 2 0"),
}
SPDX = {
    "apache-2.0": ("apache 2 0",), "bsd": ("bsd 2 clause", "bsd 3 clause"), "cc-by-4.0": ("cc by 4 0",), "cc-by-nc-4.0": ("cc by nc 4 0",),
    "gpl-3.0": ("gpl 3 0",), "mit": ("mit",), "mpl-2.0": ("mpl 2 0",),
}
LEADS = ("under", "under the", "under a", "under an", "under gnu", "under the gnu", "terms of the", "terms of the gnu")
REFERENCES = [Notice(label, f"{lead} {name}", (1, 1), True) for label, names in NAMES.items() for name in names for lead in LEADS] + \
             [Notice(label, f"spdx license identifier {i}", (1, 1), True) for label, ids in SPDX.items() for i in ids]
NOTICES = TEMPLATES + REFERENCES

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what stands between the words of a lower-cased text
BLOCK_END = r"[\n\r]+|(?<=[.!?])[ \t]+"


def lowered(text: Column) -> Column:
    """Lower case so that A-Z alone give a-z: the two other letters whose lower
    case holds an ASCII letter (dotted capital I, Kelvin sign) become another
    letter of a word first. Other letters stay letters of a word."""
    plain = F.replace(F.replace(text, F.lit("İ"), F.lit("ı")), F.lit("K"), F.lit("ĸ"))
    return F.lower(plain)


def _words(text: Column) -> Column:
    """The words of a lower-cased text; an empty string may stand at either end."""
    return F.split(text, BETWEEN, -1)


def _count(words: Column) -> Column:
    ends = (F.element_at(words, 1) == "").cast("long") + (F.element_at(words, -1) == "").cast("long")
    return F.greatest(F.size(words) - ends, F.lit(0)).cast("long")


def needed(notice: Notice) -> int:
    m = len(set(notice.text.split()))
    return -(-m * notice.share[0] // notice.share[1])


def _literal(words: Sequence[str]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def _constant(value, kind: str) -> Column:
    """A nested value as one literal: parsed while the plan is made, not for each row."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def global_order(documents: DataFrame, notices: Sequence[Notice]) -> list[str]:
    """Notice words by the number of documents holding them, rarest first."""
    words = sorted({w for n in notices for w in n.text.split()})
    hits = F.array_intersect(_words(lowered(text_or_empty())), _literal(words))
    counted = dict(documents.select(F.explode(hits).alias("w")).groupBy("w").count().collect())
    return sorted(words, key=lambda w: (counted.get(w, 0), w))


# One notice in the index: label, distinct words in global order, its prefix of them, how many are needed;
# windows are ``span`` words long and begin at every ``step``-th word; text: of one whose words must stand in order.
ENTRY = "label string, words array<string>, prefix array<string>, need int, span int, step int, text string"


def index(notices: Sequence[Notice], order: Sequence[str]) -> tuple[list[dict], dict[str, list[int]]]:
    """(entries, inverted prefix index: word -> places of the entries, from 1)."""
    place = {w: i for i, w in enumerate(order)}
    entries, postings = [], {}
    for n in notices:
        length = len(n.text.split())
        words = sorted(set(n.text.split()), key=place.__getitem__)
        o = needed(n)
        entries.append({"label": n.label, "words": words, "prefix": words[:len(words) - o + 1], "need": o, "span": length if n.in_order else 2 * length,
                        "step": 1 if n.in_order else length, "text": n.text if n.in_order else None})
        for w in entries[-1]["prefix"]:
            postings.setdefault(w, []).append(len(entries))
    return entries, postings


def _share(entry: Column, found: Column) -> Column:
    """Share of the notice in a block, 0 below its threshold; ``found``: notice words of the block, in global order."""
    words, need = entry["words"], entry["need"]
    shared = F.array_intersect(found, words)
    first = F.element_at(shared, 1)
    left_in_block = F.size(found) - F.array_position(found, first) + 1
    left_in_notice = F.size(words) - F.array_position(words, first) + 1
    may = (F.size(found) >= need) & F.arrays_overlap(found, entry["prefix"])
    return F.when(may & (left_in_block >= need) & (left_in_notice >= need) & (F.size(shared) >= need),
                  F.size(shared) / F.size(words).cast("double")).otherwise(0.0)


def _window_shares(entry: Column, words: Column, hits: Column) -> Column:
    """Shares of the notice in the windows that reach one of its prefix words; ``hits``: places of all words of the index."""
    span, step = entry["span"], entry["step"]
    at = F.filter(hits, lambda i: F.array_contains(entry["prefix"], F.element_at(words, i)))
    begun = lambda p: F.sequence(F.greatest(F.lit(0), F.ceil((p - span) / step).cast("int")), F.floor((p - 1) / step).cast("int"))

    def share(k: Column) -> Column:
        window = F.slice(words, k * step + 1, span)
        in_order = F.when(F.array_join(window, " ") == entry["text"], 1.0).otherwise(0.0)
        return F.when(entry["text"].isNotNull(), in_order).otherwise(_share(entry, F.array_intersect(entry["words"], window)))

    return F.transform(F.array_distinct(F.flatten(F.transform(at, begun))), share)


def scan(documents: DataFrame, phrases: Mapping[str, str] = PHRASES, notices: Sequence[Notice] = NOTICES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    ``score`` is 1 where a phrase stands, else the largest share of a notice found.
    """
    order = global_order(documents, notices)
    entries, postings = index(notices, order)
    keys = sorted(postings)
    least = min((needed(n) for n in notices if not n.in_order), default=1)
    watched = sorted({*keys, *(w for p in phrases for w in p.split())})

    low = documents.select("doc_id", lowered(text_or_empty()).alias("low"))
    split = low.select("doc_id", "low", _words(F.col("low")).alias("words"))
    seen = split.select("doc_id", "low", "words", _count(F.col("words")).alias("n_words"), F.array_intersect("words", _literal(watched)).alias("seen"))
    has = lambda ws: F.size(F.array_intersect("seen", _literal(sorted(set(ws))))) == len(set(ws))
    phrase_there = F.lit(False)
    for p in phrases:
        phrase_there = phrase_there | has(p.split())
    hit = F.arrays_overlap("seen", _literal(keys))
    flagged = seen.select(
        "doc_id", "n_words",
        F.when(phrase_there, F.concat(F.lit(" "), F.trim(F.array_join("words", " ")), F.lit(" "))).alias("line"),
        F.when(hit, F.col("low")).alias("low"),
        F.when(hit, F.slice("words", F.when(F.element_at("words", 1) == "", 2).otherwise(1), F.col("n_words").cast("int"))).alias("words"),
        F.when(hit, F.array_intersect("seen", _literal(keys))).alias("seen"))

    found, labels = [], []
    for phrase, label in phrases.items():
        pieces = F.split("line", f" {phrase}(?= )", -1)
        length = len(phrase.split())
        spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
        n = F.size(pieces) - 1
        there = F.col("line").contains(f" {phrase} ")
        found.append((F.when(there, n).otherwise(0), F.when(there, spaces(F.element_at(pieces, 1))),
                      F.when(there, F.col("n_words") - length - (spaces(F.element_at(pieces, -1)) - 1))))
        labels.append(F.when(there, F.lit(label)))

    blocks = F.filter(F.transform(F.split("low", BLOCK_END, -1), lambda b: F.array_intersect(_literal(order), _words(b))), lambda v: F.size(v) >= least)
    posted = lambda w: F.element_at(_constant([postings[k] for k in keys], "array<array<int>>"), F.array_position(_literal(keys), w).cast("int"))
    table = _constant(entries, f"array<struct<{ENTRY.replace(' ', ':').replace(',:', ',')}>>")
    hits = F.filter(F.sequence(F.lit(1), F.size("words")), lambda i: F.array_contains(F.col("seen"), F.element_at("words", i)))

    def best(entry: Column) -> Column:
        in_blocks = F.when(entry["text"].isNull(), F.transform("blocks", lambda b: _share(entry, b)))
        return F.struct(entry["label"].alias("label"), F.greatest(
            F.coalesce(F.array_max(_window_shares(entry, F.col("words"), F.col("hits"))), F.lit(0.0)),
            F.coalesce(F.array_max(in_blocks), F.lit(0.0))).alias("share"))

    scored = (flagged.withColumn("visit", F.transform(F.array_distinct(F.flatten(F.transform("seen", posted))), lambda i: F.element_at(table, i)))
              .withColumn("blocks", F.when(F.col("seen").isNotNull(), blocks)).withColumn("hits", F.when(F.col("seen").isNotNull(), hits))
              .withColumn("own", F.filter(F.transform("visit", best), lambda x: x["share"] > 0)))
    own = F.coalesce(F.transform("own", lambda x: x["label"]), F.array().cast("array<string>"))
    base = F.array_compact(F.array(*labels)) if labels else F.array().cast("array<string>")
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    n_base = sum((f[0] for f in found), F.lit(0)).cast("long")
    return scored.select(
        "doc_id", "n_words", n_base.alias("n_base"),
        F.least(*[f[1] for f in found]).cast("long").alias("first_word"),
        F.greatest(*[f[2] for f in found]).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("own", lambda x: x["share"])), F.lit(0.0))).alias("score"))
