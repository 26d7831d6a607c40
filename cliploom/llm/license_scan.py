"""Licence notices in documents: winnowed fingerprints and rare words pick candidates, banded alignment settles them.

Fingerprints of the templates (the least gram hash of each run of two grams of three words) form an inverted index from
hash to template and place; a template of three words, too short to share a run, is looked up by its one gram. A match may
share no gram (words changed or put in between), so templates are indexed by words as well: of a template that may lack e
words, the e + 1 longest words, one of which each match has. Around such a word the diagonals stay that have, within the
band, the words that the coverage asks for; so every alignment within a band about one diagonal is found. Neighbouring
diagonals are one candidate; there the template is aligned with the document's words within a band around them, and
the match is reported if its words cover enough of the template; then what lies before and after it is aligned
likewise. A chain of diagonals longer than the template is taken in parts, each with the band around it. Between two
documents nothing is compared, so there is no shuffle.

Words are runs of ASCII letters (lower-cased), digits and bytes above 127. A null or empty text has no matches; repeated rows each get their row, a null doc_id comes back null; an
empty table gives none; a text longer than a slab is one slab; of equal matches the shortest, then the first stands; extra columns, whatever their names, are ignored. A template of one or two words is refused. The templates are the stated query set and go to every task; their size is checked.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .columns import U, Words, memo, slabs, text_buffer
from .decontaminate import words_of
from .frames import slim

GRAM, RUN = 3, 2
#: Words looked at in one go around hits of rare words.
WINDOWS = 1 << 20
MAX_TEMPLATE_BYTES = 32 << 20

#: Short notices by licence.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "GPL-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
}

MATCHES = "array<struct<license:string,coverage:double,matched:int,start:int,end:int>>"


def all_grams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the grams of each row."""
    g, ok = w.grams(GRAM)
    at = np.flatnonzero(ok)
    return at, g[at]


def winnowed(w: Words, at: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which grams are least, or the last of equals, in some run of RUN grams of their row."""
    keep = np.zeros(len(at), bool)
    if len(at) > 1:
        i = np.flatnonzero((at[1:] == at[:-1] + 1) & (w.row[at[1:]] == w.row[at[:-1]]))
        keep[i + (h[i + 1] <= h[i])] = True
    return keep


class Index:
    """Sorted hashes with the template and place of each."""

    def __init__(self, h: np.ndarray, template: np.ndarray, place: np.ndarray):
        order = np.argsort(h, kind="stable")
        self.hash, self.template, self.place = h[order], template[order], place[order]

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in h, entries) of all agreements."""
        i, j = np.searchsorted(self.hash, h), np.searchsorted(self.hash, h, "right")
        each = j - i
        hit = np.flatnonzero(each)
        n = each[hit]
        return np.repeat(hit, n), np.repeat(i[hit], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


class Templates:
    """Winnowed index of the templates, one of all grams of those too short to share a run, and one of the longest words of each."""

    def __init__(self, texts: dict[str, str], coverage: float, band: int):
        self.names = sorted(texts)
        buf, offs = text_buffer(pa.array([texts[k].encode() for k in self.names], pa.large_binary()))
        w = words_of(buf, offs)
        self.words = [w.hash[s:e].tolist() for s, e in zip(w.first, w.first[1:], strict=False)]
        at, h = all_grams(w)
        row = w.row[at]
        kept, short = winnowed(w, at, h), w.count[row] < GRAM + RUN - 1
        self.long, self.short = (Index(h[m], row[m], (at - w.first[row])[m]) for m in (kept & ~short, short))

        self.need = [max(1, math.ceil(coverage * len(x))) for x in self.words]
        self.slack = [max(2, int(band * len(x) / 100)) for x in self.words]
        size = w.end - w.start
        rare = [s + np.argsort(-size[s:e], kind="stable")[: max(0, e - s - n + 1)] for s, e, n in zip(w.first, w.first[1:], self.need, strict=False)]
        at = np.concatenate(rare) if rare else np.zeros(0, np.int64)
        self.rare = Index(w.hash[at], w.row[at], at - w.first[w.row[at]])

    def hits(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, template, diagonal) of each fingerprint in common and of each diagonal with words enough near it."""
        at, h = all_grams(w)
        kept = np.flatnonzero(winnowed(w, at, h))
        i, entry = self.long.hits(h[kept])
        j, more = self.short.hits(h)
        place, template, start = np.r_[at[kept][i], at[j]], np.r_[self.long.template[entry], self.short.template[more]], np.r_[self.long.place[entry], self.short.place[more]]
        row = np.searchsorted(w.first, place, "right") - 1
        out = [(row, template, place - w.first[row] - start)]
        place, entry = self.rare.hits(w.hash)
        for k in np.unique(self.rare.template[entry]).tolist():
            mine = self.rare.template[entry] == k
            out += self.near(w, k, place[mine], self.rare.place[entry[mine]])
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def near(self, w: Words, k: int, place: np.ndarray, start: np.ndarray):
        """(row, template, diagonal) of the diagonals of template k that have enough of its words within the band, from hits of its rare words."""
        words, need, slack = Index(np.array(self.words[k], U), np.zeros(len(self.words[k]), np.int64), np.arange(len(self.words[k]))), self.need[k], self.slack[k]
        n, row = len(self.words[k]), np.searchsorted(w.first, place, "right") - 1
        lo, hi = np.maximum(place - start - 2 * slack, w.first[row]), np.minimum(place - start + n + 2 * slack, w.first[row + 1])
        step, keep = max(1, WINDOWS // (n + 4 * slack)), []
        for i in range(0, len(place), step):  # words of the template in the window of each hit, in whatever order
            at = lo[i : i + step, None] + np.arange(n + 4 * slack)
            x = w.hash[np.minimum(at, len(w.hash) - 1)]
            found = words.hash[np.minimum(np.searchsorted(words.hash, x), n - 1)] == x
            keep.append((found & (at < hi[i : i + step, None])).sum(1) >= need)
        keep = np.flatnonzero(np.concatenate(keep))
        row, d = row[keep], (place - start - w.first[row])[keep]
        order = np.lexsort((d, row))
        row, d = row[order], d[order]
        for g in np.split(np.arange(len(d)), np.flatnonzero((np.diff(row) > 0) | (np.diff(d) > 2 * slack + 1)) + 1) if len(d) else ():
            r, low, high = int(row[g[0]]), int(d[g[0]]) - slack, int(d[g[-1]]) + slack
            base = int(w.first[r])
            a, b = max(0, low - slack), min(int(w.count[r]), high + slack + n)
            i, entry = words.hits(w.hash[base + a : base + b])
            pos, at = words.place[entry], i + a - words.place[entry]
            o = np.lexsort((at, pos))
            pos, at = pos[o], at[o]
            begin, end = at - slack, at + slack + 1  # diagonals that have this word within the band, each once a template word
            again = np.flatnonzero(pos[1:] == pos[:-1]) + 1
            begin[again] = np.maximum(begin[again], end[again - 1])
            begin, end = np.clip(begin, low, high + 1) - low, np.clip(end, low, high + 1) - low
            have = np.cumsum(np.bincount(begin, minlength=high - low + 2) - np.bincount(end, minlength=high - low + 2))[:-1]
            good = np.flatnonzero(have >= need) + low
            yield np.full(len(good), r), np.full(len(good), k), good


#: More than any place in a document: words matched are counted above it.
ONE = 1 << 40


def align(template: list[int], doc: np.ndarray, lo: int, low_diagonal: int, high_diagonal: int) -> tuple[int, int, int]:
    """(words matched, first, end) of the alignment of most matched words, then of the shortest span, within a band.

    doc[j] stands at place lo + j; row i of the band holds places i + low_diagonal to i + high_diagonal. A cell holds the most words
    matched up to it, and of those alignments the last start; a row of cells is one step.
    """
    width = high_diagonal - low_diagonal + 1
    place = np.arange(width) + low_diagonal
    padded = np.zeros(len(template) + width, U)
    known = np.zeros(len(padded), bool)  # cell b of row i is place i + b of these
    a, z = max(low_diagonal, lo), min(low_diagonal + len(padded), lo + len(doc))
    if a < z:
        padded[a - low_diagonal : z - low_diagonal] = doc[a - lo : z - lo]
        known[a - low_diagonal : z - low_diagonal] = True
    last = np.zeros(width + 1, np.int64)
    best, found = 0, (0, 0, 0)
    for i, word in enumerate(template):
        row = np.zeros(width + 1, np.int64)
        row[:-1] = last[1:]  # template word skipped: same place, one diagonal up
        hit = np.flatnonzero((padded[i : i + width] == word) & known[i : i + width])
        if len(hit):
            new = np.where(last[hit] >= ONE, last[hit], place[hit] + i) + ONE
            row[hit] = np.maximum(row[hit], new)
            span = place[hit] + i + 1 - new % ONE
            score = new // ONE * ONE - span
            k = int(np.argmax(score))
            if score[k] > best:
                best, found = int(score[k]), (int(new[k] // ONE), int(new[k] % ONE), int(place[hit[k]] + i + 1))
        np.maximum.accumulate(row[:-1], out=row[:-1])  # document words skipped
        last = row
    return found


def matches(w: Words, r: int, template: np.ndarray, diagonal: np.ndarray, t: Templates) -> list[dict]:
    """Matches in one row: hits are (template, diagonal)."""
    out = []
    for k in np.unique(template).tolist():
        words, need, slack = t.words[k], t.need[k], t.slack[k]
        d = np.unique(diagonal[template == k])
        cut = np.flatnonzero(np.diff(d) > slack) + 1
        found = []
        for group in (part for chain in np.split(d, cut) for part in np.split(chain, np.flatnonzero(np.diff((chain - chain[0]) // len(words))) + 1)):
            low, high = int(group[0]) - slack, int(group[-1]) + slack
            base = int(w.first[r])
            todo = [(max(0, low), min(int(w.count[r]), high + len(words)))]
            while todo:
                lo, hi = todo.pop()
                if hi - lo >= need:
                    n, s, e = align(words, w.hash[base + lo : base + hi], lo, low, high)
                    if n >= need:
                        found.append((n, s, e))
                        todo += [(lo, s), (e, hi)]
        found.sort(key=lambda x: (-x[0], x[2] - x[1], x[1]))
        taken: list[tuple[int, int]] = []
        for n, s, e in found:
            if all(e <= a or s >= b for a, b in taken):
                taken.append((s, e))
                out.append({"license": t.names[k], "coverage": n / len(words), "matched": n, "start": s, "end": e})
    return sorted(out, key=lambda m: (m["start"], m["end"], m["license"]))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = 0.8, band: int = 15, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_matches, licenses (names, sorted) and matches (licence, share and number of template words matched, first and end word) of each row.

    coverage: least share of a template's words. band: words of drift each way per hundred template words, 2 at least.
    """
    texts = NOTICES if templates is None else templates
    size = sum(len(x.encode()) for x in texts.values())
    if size > MAX_TEMPLATE_BYTES:
        raise ValueError(f"templates are {size} bytes; scan them in parts of at most {MAX_TEMPLATE_BYTES}")
    for k, x in texts.items():
        if words_of(*text_buffer(pa.array([x.encode()], pa.large_binary()))).count[0] < GRAM:
            raise ValueError(f"template {k} has fewer than {GRAM} words")
    sent, name = docs.sparkSession.sparkContext.broadcast(dict(texts)), uuid.uuid4().hex

    def run(batches):
        t = memo(f"templates {name}", lambda: Templates(sent.value, coverage, band))
        for b in batches:
            buf, offs = text_buffer(b.column(1))
            for x, y in slabs(offs):
                w = words_of(buf[offs[x] : offs[y]], offs[x : y + 1] - offs[x])
                found: list[list[dict]] = [[] for _ in range(y - x)]
                row, template, diagonal = t.hits(w)
                order = np.argsort(row, kind="stable")
                row, template, diagonal = row[order], template[order], diagonal[order]
                for r in np.unique(row).tolist():
                    i, j = np.searchsorted(row, [r, r + 1])
                    found[r] = matches(w, r, template[i:j], diagonal[i:j], t)
                names = [sorted({m["license"] for m in f}) for f in found]
                kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("matched", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x), pa.array(w.count, pa.int64()), pa.array([len(f) for f in found], pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(found, kind)], ["doc_id", "n_words", "n_matches", "licenses", "matches"])

    return slim(docs, id_col, text_col).mapInArrow(run, f"doc_id long, n_words long, n_matches long, licenses array<string>, matches {MATCHES}")
