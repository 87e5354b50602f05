"""License scans by patience alignment.

A text and a template are token sequences (lower case, letters and digits). Tokens unique to both are anchors; the
longest increasing subsequence of their places is kept, and the gaps between kept anchors are aligned the same way,
after equal beginnings and ends of a gap are matched. Coverage is the share of the template's tokens that the
alignment matches. Tokens that no template has can't match, so only the others are kept, with their places.

The whole text is scanned, and every copy of a notice is reported. Repeated copies spoil uniqueness, so alignments are
made between copies' borders: a stretch of the text, of any length, is looked at if it holds `least` of the template's
tokens in their order, which is told exactly by a bit-parallel longest common subsequence (an upper bound of what an
alignment can match). The shortest such stretch that ends first is aligned by itself and with all that lies between the
copy before and the next such stretch, up to some lengths of the stretch or the template on either side (so that time
grows with the text), and the better alignment counts. If no stretch gives a copy, the text is aligned
as a whole. So comments between the words of a notice, or any number of notices one after another, cost no coverage.

The templates are a parameter (a few notices, carried in the closure). Null and empty texts match nothing; a text of any
length is cut in tokens one MB at a time. Repeated rows are scanned alike. Of licenses covered equally the first template
is named. An empty table has no rows. Extra columns are left out; a null id stays null.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import stretches, texts_of, tidy

#: Short notices as they are commonly printed.
TEMPLATES = {
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT-short": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-clauses": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
}
#: How far beyond a stretch an alignment looks, in lengths of the stretch or the template.
REACH = 4
TOKEN = re.compile(rb"[a-z0-9]+")
_GAP = re.compile(rb"[^A-Za-z0-9]")


def tokens_of(text: bytes) -> list[bytes]:
    return TOKEN.findall(text.lower())


def rising(places: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence, by piles."""
    tops, at, back = [], [], []
    for k, x in enumerate(places):
        pile = bisect_left(tops, x)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(x)
            at.append(k)
        else:
            tops[pile], at[pile] = x, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places (in a, in b), rising in both."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            found.append((m, n))
        if i >= m or j >= n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        place = {x: k for k, x in enumerate(b[j:n], j) if in_b[x] == 1 and in_a.get(x) == 1}
        anchors = [(k, place[x]) for k, x in enumerate(a[i:m], i) if x in place]
        kept = [anchors[k] for k in rising([y for _, y in anchors])]
        if not kept:
            continue
        found.extend(kept)
        ends = [(i - 1, j - 1), *kept, (m, n)]
        todo.extend((p + 1, r, q + 1, s) for (p, q), (r, s) in zip(ends, ends[1:], strict=False))
    return sorted(found)


def known_tokens(text: bytes, known: set[bytes], piece: int = 1 << 20) -> tuple[list[int], list[bytes]]:
    """The text's tokens that are in known, and their places among all tokens. Pieces are cut where a token ends."""
    places, found, base, at = [], [], 0, 0
    while at < len(text):
        end = at + piece
        if end < len(text) and (gap := _GAP.search(text, end)):
            end = gap.start()
        elif end < len(text):
            end = len(text)
        tokens = tokens_of(text[at:end])
        for k, x in enumerate(tokens):
            if x in known:
                places.append(base + k)
                found.append(x)
        base, at = base + len(tokens), end
    return places, found


class Template:
    """A notice: its tokens, how often it has each, and the places of each as bits, from its beginning and from its end."""

    def __init__(self, name: str, tokens: list[bytes], least: float):
        self.name, self.tokens, self.need, self.enough = name, tokens, Counter(tokens), least * len(tokens)
        self.ahead: dict[bytes, int] = {}
        self.back: dict[bytes, int] = {}
        for k, x in enumerate(tokens):
            self.ahead[x] = self.ahead.get(x, 0) | 1 << k
            self.back[x] = self.back.get(x, 0) | 1 << len(tokens) - 1 - k
        self.full = (1 << len(tokens)) - 1

    def reaches(self, tokens: list[bytes], order: range, masks: dict[bytes, int]) -> int | None:
        """The first place, in this order, up to which tokens hold enough of the template in its order."""
        row, full, size, enough = self.full, self.full, len(self.tokens), self.enough
        for k in order:
            both = row & masks[tokens[k]]
            row = (row + both | row - both) & full
            if size - row.bit_count() >= enough:
                return k
        return None

    def stretch(self, tokens: list[bytes], at: int) -> tuple[int, int] | None:
        """First and last place of the shortest stretch that holds enough, of those that end first."""
        end = self.reaches(tokens, range(at, len(tokens)), self.ahead)
        if end is None:
            return None
        return self.reaches(tokens, range(end, at - 1, -1), self.back), end

    def copies(self, tokens: list[bytes]) -> list[tuple[float, int, int]]:
        """(coverage, first and last matched place) of each copy in tokens, all of which the template has."""
        out, at, done = [], 0, 0
        found = self.stretch(tokens, at)
        while found:
            start, end = found
            after = self.stretch(tokens, end + 1)
            reach = REACH * max(len(self.tokens), end + 1 - start)
            spans = ((start, end + 1), (max(done, start - reach), min(after[0] if after else len(tokens), end + 1 + reach)))
            match, low = max(((patience(tokens[a:b], self.tokens), a) for a, b in spans), key=lambda x: len(x[0]))
            if len(match) >= self.enough:
                out.append((len(match) / len(self.tokens), low + match[0][0], low + match[-1][0]))
                done = low + match[-1][0] + 1
                at = max(done, end + 1)
                found = after if after and after[0] >= at else self.stretch(tokens, at)
            else:
                found = self.stretch(tokens, start + 1)
        if not out and len(match := patience(tokens, self.tokens)) >= self.enough:
            out.append((len(match) / len(self.tokens), match[0][0], match[-1][0]))
        return out


class Scanner:
    def __init__(self, templates: dict[str, str], least: float):
        self.templates = [Template(name, tokens, least) for name, t in templates.items() if (tokens := tokens_of(t.encode()))]
        self.known = {x for t in self.templates for x in t.need}

    def scan(self, text: bytes) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first and last matched token of the text) of each copy that is covered enough."""
        places, found = known_tokens(text, self.known)
        have, out = Counter(found), []
        for t in self.templates:
            if sum(min(n, have[x]) for x, n in t.need.items()) < t.enough:
                continue
            own = [k for k, x in enumerate(found) if x in t.need]
            out += [(t.name, covered, places[own[a]], places[own[b]]) for covered, a, b in t.copies([found[k] for k in own])]
        return out


SPANS = "array<struct<license:string,coverage:double,first_token:int,last_token:int>>"
_SPANS = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first_token", pa.int32()), ("last_token", pa.int32())]))


def scanned(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_licenses int, license string, coverage double, spans): how many templates, the best covered one, and all copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        keys = ("license", "coverage", "first_token", "last_token")
        for batch in batches:
            texts = batch.column(1)
            rows = [scanner.scan(t) for a, b in stretches(texts, 2 << 20) for t in texts_of(texts.slice(a, b - a))]
            best = [max(r, key=lambda x: x[1]) if r else (None, 0.0) for r in rows]  # the first of equals
            spans = pa.array([[dict(zip(keys, x, strict=True)) for x in r] for r in rows], _SPANS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len({x[0] for x in r}) for r in rows], pa.int32()), pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.float64()), spans], [id_col, "n_licenses", "license", "coverage", "spans"])

    return docs.select(id_col, text_col).mapInArrow(tidy(run), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_licenses int, license string, coverage double, spans {SPANS}")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with all copies of the notices whose tokens are aligned with it to 0.8 or more."""
    return scanned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
