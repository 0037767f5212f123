"""License scan: exact set-similarity join of text blocks with templates.

A template matches a block of words if at least ``threshold`` of its
distinct words are in the block. Blocks of a template of L words are the
stretches of 2 L words that start at every multiple of L, so every stretch
of L words lies whole in one of them, wherever lines end.

Words are ordered by their frequency in the corpus (rarest first, counted in
a first pass over all texts). A block that contains a template must hold one
of the template's first |T| - ceil(threshold |T|) + 1 words (prefix filter),
enough words at all (length filter), and enough of the template after the
first common word (positional filter); what passes is counted exactly.

Licenses of a family differ by a word or two, which the threshold alone would
let pass. So a label can have words of which a match must hold one each, and
words that belong to its sisters: blocks are cut at these, and a
piece has to contain the template by itself.

Short phrases are templates of which every word is needed, in its place:
their rarest word leads to the places, which are then compared word by word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, small_batches, text_bytes

THRESHOLD = 0.8

# Phrases whose places are counted, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public notices, as their owners ask to have them placed in files.
TEMPLATES = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ],
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
}

# The Creative Commons family: the elements that go with attribution, and the words for each.
_ELEMENTS = {"nc": ("NonCommercial", {"nc", "noncommercial", "commercial"}), "sa": ("ShareAlike", {"sa", "sharealike"}),
             "nd": ("NoDerivatives", {"nd", "noderivatives", "noderivs"})}
# Of each group a match holds a word (needed), and none of the others (barred).
NEEDED = {"lgpl": [{"lesser", "library"}], "agpl": [{"affero"}]}
BARRED = {"gpl": {"lesser", "affero"}, "lgpl": {"affero"}, "agpl": {"lesser"}}
for _with in ((), ("nc",), ("sa",), ("nd",), ("nc", "sa"), ("nc", "nd")):
    _label = " ".join(["cc by", *_with])
    _names = "".join(f"-{_ELEMENTS[e][0]}" for e in _with)
    TEMPLATES[_label] = [
        f"Licensed under {'-'.join(['CC BY', *(e.upper() for e in _with)])} 4.0",
        f"licensed under a Creative Commons Attribution{_names} 4.0 International License",
    ]
    NEEDED[_label] = [_ELEMENTS[e][1] for e in _with]
    BARRED[_label] = set().union(*(words for e, (_, words) in _ELEMENTS.items() if e not in _with))

# ASCII letters to lower case; every other ASCII sign but digits ends a word.
_TABLE = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, in blocks cut between words."""
    pos = 0
    while pos < len(text):
        end = min(pos + BLOCK_BYTES, len(text))
        while end < len(text) and _TABLE[text[end]] != 0x20:
            end += 1
        yield text[pos:end].translate(_TABLE).split()
        pos = end


class Templates:
    """Templates and phrases as word numbers, with the prefixes of a word order."""

    def __init__(self, templates: dict[str, list[str]], phrases: dict[str, str], threshold: float,
                 needed: dict[str, list[set[str]]], barred: dict[str, set[str]]):
        split = lambda t: [w for ws in words_of(t.encode()) for w in ws]
        self.notices = [(label, split(t)) for label, ts in sorted(templates.items()) for t in ts]
        self.notices = [(label, ws) for label, ws in self.notices if ws]
        self.phrases = [(label, split(p)) for p, label in sorted(phrases.items())]
        self.threshold = threshold
        self.needed = {label: [{w.encode() for w in g} for g in groups] for label, groups in needed.items()}
        self.barred = {label: {w.encode() for w in g} for label, g in barred.items()}
        words = {w for _, ws in self.notices + self.phrases for w in ws}
        words |= set().union(*self.barred.values(), *(g for groups in self.needed.values() for g in groups))
        self.number = {w: i + 1 for i, w in enumerate(sorted(words))}

    def order(self, frequency: dict[bytes, int]) -> Templates:
        """Sets the global order: rarest words first, ties by the word."""
        ranked = sorted(self.number, key=lambda w: (frequency.get(w, 0), w))
        rank = {w: i for i, w in enumerate(ranked)}
        n = len(self.number) + 1
        self.sets = []  # label, length in words, words in the global order, how many are needed
        self.marks = []  # groups of words to hold one of each, and which words cut a block
        self.leads = np.zeros((len(self.notices), n), dtype=bool)  # is a prefix word of the template
        self.any_lead = np.zeros(n, dtype=bool)
        for k, (label, ws) in enumerate(self.notices):
            own = np.array([self.number[w] for w in sorted(set(ws), key=rank.get)])
            need = max(1, math.ceil(self.threshold * len(own) - 1e-9))
            self.leads[k, own[: len(own) - need + 1]] = True
            self.sets.append((label, len(ws), own, need))
            cut = np.zeros(n, dtype=bool)
            cut[[self.number[w] for w in self.barred.get(label, ())]] = True
            self.marks.append(([[self.number[w] for w in g] for g in self.needed.get(label, ())], cut if cut.any() else None))
        self.any_lead = self.leads.any(axis=0)
        self.places = []  # label, word numbers, offset of the rarest word
        for label, ws in self.phrases:
            rarest = min(range(len(ws)), key=lambda i: rank[ws[i]])
            self.places.append((label, [self.number[w] for w in ws], rarest))
            self.any_lead[self.number[ws[rarest]]] = True
        return self

    def scan(self, ids: np.ndarray) -> tuple[int, int | None, int | None, set[str], set[str], float]:
        """(places, first, last, labels by phrase, labels by notice, best containment) of a text."""
        lead = np.flatnonzero(self.any_lead[ids])
        base, starts, found, best = set(), [], set(), 0.0
        if not len(lead):
            return 0, None, None, base, found, best
        at_lead = ids[lead]
        for label, ws, rarest in self.places:
            start = lead[at_lead == ws[rarest]] - rarest
            start = start[(start >= 0) & (start + len(ws) <= len(ids))]
            for k, w in enumerate(ws):
                start = start[ids[start + k] == w]
            if len(start):
                base.add(label)
                starts.append(start)
        for k, (label, length, own, need) in enumerate(self.sets):
            groups, barred = self.marks[k]
            hit = lead[self.leads[k][at_lead]]
            blocks = np.unique(hit // length)
            for b in np.unique(np.concatenate([blocks, blocks[blocks > 0] - 1])):
                block = ids[b * length: (b + 2) * length]
                cuts = [] if barred is None else np.flatnonzero(barred[block])
                for part in np.split(block, cuts) if len(cuts) else [block]:
                    if len(cuts) and len(part) and barred[part[0]]:
                        part = part[1:]
                    if len(part) < need:  # length filter: too few words for the overlap
                        continue
                    there = np.zeros(len(self.number) + 1, dtype=bool)
                    there[part] = True
                    common = there[own]
                    first = int(common.argmax())
                    if not common[first] or len(own) - first < need:  # positional filter
                        continue
                    got = int(common.sum())
                    if got >= need and all(there[g].any() for g in groups):
                        found.add(label)
                        best = max(best, got / len(own))
        if starts:
            s = np.concatenate(starts)
            return len(s), int(s.min()), int(s.max()), base, found, 1.0
        return 0, None, None, base, found, best


def _numbered(templates: Templates, text: bytes | None) -> np.ndarray:
    get = templates.number.get
    parts = [np.fromiter(map(get, ws, repeat(0)), dtype=np.int32, count=len(ws)) for ws in words_of(text or b"")]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)


def frequencies(texts: DataFrame, templates: Templates) -> dict[bytes, int]:
    """How often each word of the templates stands in the whole corpus (one
    row a word reaches the driver)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(templates.number) + 1, dtype=np.int64)
        for whole in batches:
            for b in small_batches(whole):
                for t in text_bytes(b, "t"):
                    total += np.bincount(_numbered(templates, t), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["word", "n"])

    rows = texts.mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    by_number = {i: w for w, i in templates.number.items()}
    return {by_number[r["word"]]: r["n"] for r in rows if r["word"]}


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, list[str]] | None = None, phrases: dict[str, str] | None = None,
                  threshold: float = THRESHOLD, needed: dict[str, list[set[str]]] | None = None,
                  barred: dict[str, set[str]] | None = None) -> DataFrame:
    """License notices in every document.

    Returns one row per row of ``docs``: doc_id, n_words, n_base (places of
    a phrase), first_word and last_word (their smallest and largest start,
    words from 0; null without a place), base_labels (by phrase), labels (by
    phrase or notice; both distinct, sorted, comma-joined, empty if none)
    and score: 1 with a phrase, else the best containment of a notice that
    matches, else 0.

    A null text counts as empty; repeated rows and null ids each get a row;
    an empty table gives an empty result; other columns are not read. The
    templates are a parameter and go to every task; ``needed`` (per label,
    groups of words a match holds one of each) and ``barred`` (words that cut
    its blocks) are those of the built-in templates unless given.
    """
    base = Templates(
        TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases, threshold,
        NEEDED if needed is None else needed, BARRED if barred is None else barred)
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    ordered = base.order(frequencies(src.select("t"), base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in small_batches(whole):
                rows = []
                for t in text_bytes(b, "t"):
                    ids = _numbered(ordered, t)
                    places, first, last, by_phrase, by_notice, score = ordered.scan(ids)
                    rows.append((len(ids), places, first, last, ",".join(sorted(by_phrase)),
                                 ",".join(sorted(by_phrase | by_notice)), score))
                cols = list(zip(*rows)) or [()] * 7
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    return src.mapInArrow(
        run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
             "base_labels string, labels string, score double")
