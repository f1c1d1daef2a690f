"""Operator 6, license scans: MinHash bands retrieve templates, shingles verify them.

Texts are cut into words ([0-9a-z] and non-ASCII letters after lower-casing A-Z) and
overlapping windows: for each size class of templates, windows of twice the class's span
at every span, so that a notice of up to a span's words lies whole in some window.
A window's set are its five-word shingles that occur in any template of the class; windows
with fewer than four fifths of the smallest one's can hold none and are not looked at further.

Retrieval: ``BANDS`` bands of one min-hash each.  If a template's shingles have the
Jaccard similarity j with a window's set, it is retrieved with probability
1 - (1 - j) ** BANDS: 0.9999986 at j = 0.1 with 128 bands, and above 1 - 10 ** -12 at 0.2.
Verification: a template is found in a text if some window holds at least 0.8 of its
distinct shingles, counted exactly.

Settling (``licenses``): templates of different licenses that were verified on the same
words compete, since they may differ in one deciding word.  Each verified template is
placed at its tightest runs of words.  Of two that need the same words the one with the
larger share of its own shingles, those that the other lacks, is found; then the one with
the larger containment.  A template wholly inside another gives way if more than half of
the other's own shingles are there.  If neither has any of its own shingles and their
containment is the same, the text names another license than both, and neither is found.
``scan`` gives the verified templates as they are.

``licenses`` also reads SPDX lines (``SPDX-License-Identifier: MIT OR GPL-2.0-only``): they
name licenses exactly, in the catalogue or not, and are no windows, so they have no match.
Ids are taken as written, less "-only", "-or-later" and "+"; exceptions after WITH are left out.

The catalogue is a small parameter (``MAX_TEMPLATES``), so its bands go to the tasks;
texts stay where they are read and nothing is shuffled.

Defined cases: null, empty and short texts (under five words) have no shingle and no
license; templates under five words are refused; repeated rows each get their result;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewash.llm.common import buffers, frees, sliced
from tidewash.llm.words import ALNUM, mix, shingles, word_hashes

SHINGLE = 5
BANDS = 128
#: Least share of a template's shingles, as a fraction.
NUM, DEN = 4, 5
MAX_TEMPLATES = 10_000
#: Words that a notice may span, against its template's words.
SLACK = 1.25

#: License ids and some short notices; ``license_texts`` has the whole catalogue.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
                   " compliance with the License. You may obtain a copy of the License at"
                   " http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"
                     " provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
                " General Public License as published by the Free Software Foundation, either version 3 of the License,"
                " or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
            " associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

_SEEDS = np.random.default_rng(99).integers(1, 1 << 62, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_hashes(tokens: np.ndarray) -> np.ndarray:
    """BANDS min-hashes of a set of shingles."""
    return mix(tokens[None, :] ^ _SEEDS[:, None]).min(axis=1)


class Place(NamedTuple):
    """A template in a text: its first and last shingle's place, all of them, and its containment."""

    template: int
    first: int
    last: int
    at: np.ndarray
    containment: float


class Catalogue:
    """Templates by size class, their bands and all their shingles."""

    def __init__(self, templates: list[tuple[str, str]]) -> None:
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"at most {MAX_TEMPLATES} templates")
        self.ids = [name for name, _ in templates]
        self.sets, self.words, self.classes = [], [], defaultdict(list)
        self.bands: dict[int, dict[tuple[int, int], list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, (name, text) in enumerate(templates):
            data = np.frombuffer(text.encode(), np.uint8)
            hashes, _, _, bounds = word_hashes(data, np.array([0, len(data)]), ALNUM)
            if len(hashes) < SHINGLE:
                raise ValueError(f"template of {name} has fewer than {SHINGLE} words")
            tokens = np.unique(shingles(hashes, bounds, SHINGLE)[0])
            self.sets.append(tokens)
            self.words.append(len(hashes))
            span = 8  # size classes: 8, 16, 32, ... words
            while span < SLACK * len(hashes):
                span *= 2
            self.classes[span].append(k)
            for band, h in enumerate(min_hashes(tokens)):
                self.bands[span][band, int(h)].append(k)
        self.bands = {span: dict(x) for span, x in self.bands.items()}
        self.classes = dict(self.classes)
        self.span = {k: span for span, x in self.classes.items() for k in x}
        self.own: dict[tuple[int, int], np.ndarray] = {}
        self.known = {span: np.unique(np.concatenate([self.sets[k] for k in x])) for span, x in self.classes.items()}
        # Windows with fewer places of shingles hold no template of the class.
        self.least = {span: min(-(-NUM * len(self.sets[k]) // DEN) for k in x) for span, x in self.classes.items()}

    def scan(self, tokens: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(template, first word, words, containment) of the matching windows of a text,
        given its shingles in order."""
        out = []
        for span, bands in self.bands.items() if len(tokens) else ():
            known = self.known[span]
            where = np.flatnonzero(known[np.minimum(np.searchsorted(known, tokens), len(known) - 1)] == tokens)
            # Window w holds the shingles that start in words [w * span, (w + 2) * span - SHINGLE].
            for w in sorted({int(x) // span - d for x in where for d in (0, 1)} - {-1}):
                first, last = w * span, (w + 2) * span - SHINGLE + 1
                inside = where[np.searchsorted(where, first):np.searchsorted(where, last)]
                if len(inside) < self.least[span]:
                    continue
                mine = np.unique(tokens[inside])
                near = {k for band, h in enumerate(min_hashes(mine)) for k in bands.get((band, int(h)), ())}
                for k in sorted(near):
                    common = len(np.intersect1d(mine, self.sets[k], assume_unique=True))
                    if DEN * common >= NUM * len(self.sets[k]):
                        out.append((k, first, min(2 * span, len(tokens) + SHINGLE - 1 - first), common / len(self.sets[k])))
        return out

    def lacking(self, a: int, b: int) -> np.ndarray:
        """Shingles of template ``a`` that ``b`` lacks."""
        if (a, b) not in self.own:
            self.own[a, b] = np.setdiff1d(self.sets[a], self.sets[b], assume_unique=True)
        return self.own[a, b]

    def places(self, k: int, tokens: np.ndarray) -> list[Place]:
        """The disjoint tightest runs of a text that hold a template: as long as its words and
        the slack at most, then, of the rest, as long as a window."""
        at = np.flatnonzero(np.isin(tokens, self.sets[k])).tolist()
        mine = tokens[at].tolist()
        need = NUM * len(self.sets[k])
        runs = []
        for wide, most in enumerate((int(SLACK * self.words[k]), 2 * self.span[k])):
            count: dict[int, int] = defaultdict(int)
            left, distinct = 0, 0
            for right, token in enumerate(mine):
                distinct += not count[token]
                count[token] += 1
                while at[right] - at[left] > most - SHINGLE or count[mine[left]] > 1:
                    count[mine[left]] -= 1
                    distinct -= not count[mine[left]]
                    left += 1
                if DEN * distinct >= need:
                    runs.append((wide, -distinct, at[right] - at[left], at[left], left, right))
        out: list[Place] = []
        first: list[int] = []  # of the taken runs, in order, and their ends
        last: list[int] = []
        for _, n, _, start, i, j in sorted(runs):
            x = bisect.bisect_left(last, start)
            if x < len(first) and first[x] <= at[j]:
                continue
            first.insert(x, start)
            last.insert(x, at[j])
            out.append(Place(k, start, at[j], np.array(at[i:j + 1]), -n / len(self.sets[k])))
        return out

    def _beats(self, a: Place, b: Place, tokens: np.ndarray) -> bool:
        """``b`` needs words of ``a``, and ``a`` has the better claim to them or the same empty one."""
        rest = np.setdiff1d(b.at, a.at, assume_unique=True)
        if len(rest) == len(b.at) or DEN * len(np.unique(tokens[rest])) >= NUM * len(self.sets[b.template]):
            return False

        def claim(x: Place, y: Place) -> tuple[Fraction, float]:
            own = self.lacking(x.template, y.template)
            there = len(np.intersect1d(tokens[x.at], own))
            return Fraction(there, len(own)) if len(own) else Fraction(1, 2), x.containment

        mine, other = claim(a, b), claim(b, a)
        return mine > other or mine == other and not mine[0]

    def settle(self, tokens: np.ndarray, hits: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
        """The ``hits`` of a text whose templates stand against those of other licenses."""
        found = sorted({k for k, *_ in hits})
        if len({self.ids[k] for k in found}) < 2:
            return hits
        places = sorted((p for k in found for p in self.places(k, tokens)), key=lambda p: (p.first, p.last, p.template))
        beaten_by: dict[int, set[int]] = {i: set() for i in range(len(places))}
        open_ones: list[int] = []
        for i, p in enumerate(places):
            open_ones = [j for j in open_ones if places[j].last >= p.first]
            for j in open_ones:
                if self.ids[places[j].template] != self.ids[p.template]:
                    if self._beats(places[j], p, tokens):
                        beaten_by[i].add(j)
                    if self._beats(p, places[j], tokens):
                        beaten_by[j].add(i)
            open_ones.append(i)
        stand: set[int] = set()
        left = set(beaten_by)
        # Only what stands beats; what is left in the end are equal empty claims.
        while new := {i for i in left if not beaten_by[i] & left}:
            stand |= new
            left = {i for i in left - new if not beaten_by[i] & new}
        runs = defaultdict(list)
        for i in stand:
            runs[places[i].template].append((places[i].first, places[i].last))
        return [h for h in hits if any(a < h[1] + h[2] and b >= h[1] for a, b in runs[h[0]])]


@frees
def _scanned(batches: Iterator[pa.RecordBatch], catalogue: Catalogue, settled: bool) -> Iterator[pa.RecordBatch]:
    match = pa.struct([("license", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()),
                       ("n_words", pa.int64()), ("containment", pa.float64())])
    for batch in sliced(batches, "text"):
        hashes, _, _, bounds = word_hashes(*buffers(batch.column("text")), ALNUM)
        sh, sb = shingles(hashes, bounds, SHINGLE)
        words = np.diff(bounds)
        found = []
        for i, n in enumerate(words):
            tokens = sh[sb[i]:sb[i + 1]]
            hits = catalogue.scan(tokens) if n >= SHINGLE else []
            hits = catalogue.settle(tokens, hits) if settled else hits
            found.append([{"license": catalogue.ids[k], "template": k, "first_word": a, "n_words": b, "containment": c}
                          for k, a, b, c in hits])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(words, pa.int64()), batch.column("spdx"), pa.array(found, pa.list_(match))],
            ["id", "n_words", "spdx", "matches"])


_ID = r"[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?"


def spdx_ids(text: Column) -> Column:
    """License ids of a text's SPDX lines, in order: ids joined by AND, OR or WITH, up to the
    first word that does not fit; what follows WITH is an exception, no license.

    A line is cut into words and judged word by word, so its length does not matter."""
    behind = F.slice(F.split(text, r"(?i)SPDX-License-Identifier:", -1), F.lit(2), F.lit(1 << 30))
    lines = F.transform(behind, lambda p: F.regexp_extract(p, r"^[ \t]*([^\r\n]*)", 1))

    def bound(c: Column, f) -> Column:
        """``f`` of a value that is computed once."""
        return F.get(F.transform(F.array(c), f), F.lit(0))

    def fits(words: Column) -> Column:
        """2: fits whole, 1: an id with something behind it, which ends the line, 0: does not fit."""
        return F.transform(words, lambda w, j: F.when(
            j % 2 == 1, F.when(F.upper(w).isin("AND", "OR", "WITH"), 2).otherwise(0)).otherwise(
            F.when(w.rlike(rf"^\(*{_ID}\)*$"), 2).when(w.rlike(rf"^\(*{_ID}"), 1).otherwise(0)))

    def until(fit: Column) -> Column:
        size, bad, last = F.size(fit).cast("long"), F.array_position(fit, 0), F.array_position(fit, 1)
        return F.least(F.when(bad > 0, bad - 1).otherwise(size), F.when(last > 0, last).otherwise(size))

    def named(words: Column, end: Column) -> Column:
        ids = F.transform(words, lambda w, j: F.when(
            (j < end) & (j % 2 == 0) & (F.coalesce(F.upper(F.get(words, j - F.lit(1))), F.lit("")) != "WITH"),
            F.regexp_extract(w, rf"^\(*({_ID})", 1)))
        return F.filter(ids, lambda x: x.isNotNull())

    def of_line(line: Column) -> Column:
        return bound(F.split(line, r"[ \t]+"), lambda words: bound(until(fits(words)), lambda end: named(words, end)))

    return F.transform(F.flatten(F.transform(lines, of_line)), lambda x: F.regexp_replace(x, r"(?i)(-only|-or-later|\+)$", ""))


def _found(docs: DataFrame, id_col: str, text_col: str, templates: list[tuple[str, str]] | None, settled: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Catalogue(TEMPLATES if templates is None else templates))
    text = F.col(text_col).cast("string")
    named = F.coalesce(spdx_ids(text), F.array().cast("array<string>")) if settled else F.array().cast("array<string>")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), named.alias("spdx"))
    found = rows.mapInArrow(
        lambda b: _scanned(b, shared.value, settled),
        "id long, n_words long, spdx array<string>, matches array<struct<license:string,template:int,first_word:bigint,"
        "n_words:bigint,containment:double>>")
    return found.select("id", "n_words", F.array_sort(F.array_distinct(F.concat("matches.license", "spdx"))).alias("licenses"),
                        "matches")


def scan(docs: DataFrame, id_col: str, text_col: str, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per input row: id, n_words, licenses (sorted ids found) and matches (license,
    template number, window's first word and words, containment)."""
    return _found(docs, id_col, text_col, templates, settled=False)


def licenses(docs: DataFrame, id_col: str, text_col: str, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """As ``scan``, with competing templates settled and SPDX lines read: the licenses that a text names."""
    return _found(docs, id_col, text_col, templates, settled=True)
