"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a window of consecutive words, half as long again as the template, at every place of the text; line
breaks are spaces.  It matches a template if it holds at least ``threshold`` of the template's distinct words and one of
the phrases that tell the template from its siblings.  Lines are also matched as they are (``matches``), without those
phrases; labels come from windows.

Words are put in one global order, rarest in the corpus first (words of no template last:
they cannot add to an overlap).  Then a template of k words that needs o of them must share one of its first
``k - o + 1`` words with a block (prefix), a block needs o words (length), and from a shared word on both
must have enough words left (position).  What passes is counted exactly, so no matching block is missed.

The corpus frequencies of template words are counted over all blocks first; templates and frequencies are
a fixed small table and are broadcast, the texts are never shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import read
from docloom.llm.registry import query

# Phrases with their labels, as the base scan asks for them.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Well-known license statements, each with the label it stands for.
TEMPLATES = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license"),
    ("lgpl", "redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "this work is licensed under a creative commons attribution international license"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-sa", "cc by sa"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
]
# For templates that share their threshold's words with others, the phrases one of which must stand in a block.
TELLING = {
    TEMPLATES[0][1]: ("gnu general public", "gpl"),
    TEMPLATES[1][1]: ("gnu general public", "gpl"),
    TEMPLATES[2][1]: ("lesser general public", "library general public", "lgpl"),
    TEMPLATES[3][1]: ("affero general public", "agpl"),
    TEMPLATES[4][1]: ("apache",),
    TEMPLATES[7][1]: ("mit",),
    TEMPLATES[9][1]: ("mozilla", "mpl"),
    TEMPLATES[10][1]: ("creative commons", "cc by"),
}
#: Bytes that are no part of a word become spaces, A-Z small letters.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else 32 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TABLE).split() if text else []


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]  # distinct, rarest first
    need: int
    span: int  # words of a window
    telling: tuple[tuple[bytes, ...], ...] = ()


@dataclass
class Templates:
    """Templates in the global word order, with the index of their prefixes."""

    threshold: float
    frequency: Mapping[bytes, int]
    source: list[tuple[str, str]] = field(default_factory=lambda: TEMPLATES)
    telling: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: TELLING)

    def __post_init__(self):
        vocabulary = {w for _, t in self.source for w in words_of(t)}
        order = sorted(vocabulary, key=lambda w: (self.frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.templates, self.prefix = [], {}
        for label, text in self.source:
            ws = tuple(sorted(set(words_of(text)), key=self.rank.__getitem__))
            if not ws:
                continue
            telling = tuple(tuple(words_of(p)) for p in self.telling.get(text, ()))
            t = Template(label, ws, math.ceil(self.threshold * len(ws) - 1e-9), math.ceil(1.5 * len(words_of(text))), telling)
            self.templates.append(t)
            for i, w in enumerate(ws[: len(ws) - t.need + 1]):
                self.prefix.setdefault(w, []).append((len(self.templates) - 1, i))

    def matches(self, block: list[bytes]) -> list[tuple[int, float]]:
        """``(template, containment)`` of all templates the block holds by the threshold."""
        if self.prefix.keys().isdisjoint(block):
            return []
        own = sorted({self.rank[w] for w in block if w in self.rank})
        words = [*self.rank][: max(own) + 1]
        verdict: dict[int, float] = {}
        for j, r in enumerate(own):
            for k, i in self.prefix.get(words[r], ()):
                if k in verdict:
                    continue
                t = self.templates[k]
                # length, then position: this is the first shared word, so all others lie behind it
                if len(own) < t.need or 1 + min(len(t.words) - i - 1, len(own) - j - 1) < t.need:
                    continue
                held = set(own)
                overlap = sum(self.rank[w] in held for w in t.words)
                verdict[k] = overlap / len(t.words) if overlap >= t.need else 0.0
        return sorted((k, c) for k, c in verdict.items() if c)


    def windows(self, found: list[bytes]) -> list[tuple[int, int, float]]:
        """``(first word, template, containment)``: the fullest window of each template, the first of these."""
        out = []
        if not self.prefix.keys().isdisjoint(found):
            places: dict[bytes, list[int]] = {}
            for at, w in enumerate(found):
                if w in self.rank:
                    places.setdefault(w, []).append(at)
            # the whole text as a block: what it does not hold no window holds
            for k, _ in self.matches(list(places)):
                best = self._fullest(found, self.templates[k], places)
                if best:
                    out.append((best[1], k, best[0] / len(self.templates[k].words)))
        return out

    @staticmethod
    def _fullest(found: list[bytes], t: Template, places: Mapping[bytes, list[int]]) -> tuple[int, int] | None:
        ends = None  # of each telling phrase: its place, and the first end from there on
        if t.telling:
            ends = sorted((i, i + len(p)) for p in t.telling for i in range(len(found)) if found[i] == p[0] and tuple(found[i : i + len(p)]) == p)
            if not ends:
                return None
            for i in range(len(ends) - 2, -1, -1):
                ends[i] = ends[i][0], min(ends[i][1], ends[i + 1][1])
        hits = sorted((at, w) for w in t.words for at in places.get(w, ()))
        held: Counter = Counter()
        best, right = None, 0
        # a window that begins at a hit holds as much as any that begins before it; with a phrase it may begin at that too
        begins = sorted({at for at, _ in hits} | {i for i, _ in ends or ()})
        left = tell = 0
        for b in begins:
            while left < len(hits) and hits[left][0] < b:
                if left < right:
                    held[hits[left][1]] -= 1
                    if not held[hits[left][1]]:
                        del held[hits[left][1]]
                left += 1
            right = max(right, left)
            while right < len(hits) and hits[right][0] < b + t.span:
                held[hits[right][1]] += 1
                right += 1
            if len(held) < t.need or best and len(held) <= best[0]:
                continue
            if ends is not None:
                while tell < len(ends) and ends[tell][0] < b:
                    tell += 1
                if tell == len(ends) or ends[tell][1] > b + t.span:
                    continue
            best = len(held), b
        return best


def _frequencies(vocabulary: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for text in b.column(0):
                t = text.as_py()
                if t and not vocabulary.isdisjoint(words_of(t)):
                    for line in t.split("\n"):
                        found.update(vocabulary.intersection(words_of(line)))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(found), pa.binary()), "n": pa.array(list(found.values()), pa.int64())})

    return run


MATCH = "array<struct<block:int,template:int,label:string,containment:double>>"
WINDOW = "array<struct<first:int,template:int,label:string,containment:double>>"
SCHEMA = f"doc_id long, n_words long, n_base long, first_word long, last_word long, base array<string>, matches {MATCH}, windows {WINDOW}"


def phrase_places(found: list[bytes], phrases: Mapping[str, str]) -> tuple[list[int], set[str]]:
    """Word numbers where a phrase begins (once for each phrase), and the labels of those phrases."""
    line = b" " + b" ".join(found) + b" "
    places, labels = [], set()
    for p, label in phrases.items():
        wanted = b" " + p.encode() + b" "
        at = line.find(wanted)
        while at >= 0:
            places.append(line.count(b" ", 0, at + 1) - 1)
            labels.add(label)
            at = line.find(wanted, at + 1)
    return places, labels


def _scan(shared, phrases: Mapping[str, str]):
    window = pa.list_(pa.struct([("first", pa.int32()), ("template", pa.int32()), ("label", pa.string()), ("containment", pa.float64())]))
    match = pa.list_(pa.struct([("block", pa.int32()), ("template", pa.int32()), ("label", pa.string()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = shared.value
        for b in batches:
            n, n_base, first, last, base, matches, windows = [], [], [], [], [], [], []
            for text in b.column(1):
                t = text.as_py() or ""
                found = words_of(t)
                places, labels = phrase_places(found, phrases)
                n.append(len(found))
                n_base.append(len(places))
                first.append(min(places, default=None))
                last.append(max(places, default=None))
                base.append(sorted(labels))
                rows = []
                if not templates.prefix.keys().isdisjoint(found):
                    for i, line in enumerate(t.split("\n")):
                        for k, c in templates.matches(words_of(line)):
                            rows.append({"block": i, "template": k, "label": templates.templates[k].label, "containment": c})
                matches.append(rows)
                windows.append([{"first": i, "template": k, "label": templates.templates[k].label, "containment": c} for i, k, c in templates.windows(found)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(n_base, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                 pa.array(base, pa.list_(pa.string())), pa.array(matches, match), pa.array(windows, window)],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base", "matches", "windows"])

    return run


def scan(docs: DataFrame, threshold: float = 0.8, templates: list[tuple[str, str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES,
         telling: Mapping[str, tuple[str, ...]] = TELLING) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: ``n_words``, the places of phrases, and all template matches.

    ``matches`` holds (block, template, label, containment) of every line that meets the threshold, ``windows``
    (first, template, label, containment) of the fullest window of each template that meets it with a phrase of
    ``telling(template text)``, where that names any; ``first`` is the number of its first word.  Null and
    empty texts have no words and no matches.  Repeated rows and null ids are rows like any other; no rows
    give no rows; further columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    vocabulary = frozenset(w for _, t in templates for w in words_of(t))
    counts = d.select("text").mapInArrow(_frequencies(vocabulary), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = {bytes(r["word"]): r["n"] for r in counts.collect()}  # words of templates only
    shared = docs.sparkSession.sparkContext.broadcast(Templates(threshold, frequency, templates, telling))
    return d.mapInArrow(_scan(shared, phrases), SCHEMA)


@query("op9_license_scan")
def op9_license_scan(spark, sf):
    d = scan(read(spark, sf, "documents"))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("windows", lambda m: m["label"]))))
    best = F.coalesce(F.array_max(F.transform("windows", lambda m: m["containment"])), F.lit(0.0))
    return d.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"))
