"""License scan by patience alignment of texts with license templates.

Words that occur once in the stretch and once in the template are anchors; the
longest increasing run of anchors is fixed and the gaps are aligned in the same
way. The share of template words aligned is the coverage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from math import ceil

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.words import small_batches

COVERAGE = 0.8
#: Public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-3.0": "licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC0-1.0": "dedicated to the public domain under CC0 1.0 Universal",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "Apache-2.0-text": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
}
_WORD = regex.compile(r"[^\W_]+(?:\.\d+)*")
_SIGN = {
    name: [w.casefold() for w in _WORD.findall(text)] for name, text in TEMPLATES.items()
}
_WANTED = frozenset(w for sign in _SIGN.values() for w in sign)


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned index pairs of two word lists, ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            out.append((k, m))
        once, own = Counter(a[i:k]), Counter(b[j:m])
        at = {w: q for q, w in enumerate(b[j:m], j) if own[w] == 1 and once.get(w) == 1}
        pairs = [(p, at[a[p]]) for p in range(i, k) if a[p] in at]
        chain = _increasing(pairs)
        if not chain:
            continue
        edges = [(i - 1, j - 1), *chain, (k, m)]
        out += chain
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False) if p + 1 < r and q + 1 < s]
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest chain ascending in both places, by piles."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for n, (_, q) in enumerate(pairs):
        pile = bisect_left(tops, q)
        back.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(q)
            ends.append(n)
        else:
            tops[pile], ends[pile] = q, n
    chain, n = [], ends[-1] if ends else -1
    while n >= 0:
        chain.append(pairs[n])
        n = back[n]
    return chain[::-1]


def scan_text(text: str) -> list[tuple[str, float, int, int]]:
    """(template, coverage, first word, last word) of every notice in a text.

    A template is aligned with the stretches around the places of its rarest
    words, so many of them that a notice can't lack them all.
    """
    words = [w.casefold() for w in _WORD.findall(text)]
    where: dict[str, list[int]] = {}
    for n, w in enumerate(words):
        if w in _WANTED:
            where.setdefault(w, []).append(n)
    found = []
    for name, sign in _SIGN.items():
        need = _need(sign)
        if sum(w in where for w in sign) < need:
            continue
        # len(sign) - need words of the template may be missing, so one of so many and one more must be there
        keys = sorted(set(sign), key=lambda w: (len(where.get(w, ())), w))[: len(sign) - need + 1]
        last = -1
        for p in sorted(q for w in keys for q in where.get(w, ())):
            if p <= last:
                continue
            got = _notices(words, max(last + 1, p - 2 * len(sign)), min(len(words), p + 2 * len(sign)), sign)
            if got:
                last = got[-1][2]
                found += [(name, *g) for g in got]
    return found


def _need(sign: list[str]) -> int:
    """The least number of aligned words that is ``COVERAGE`` of a template."""
    return ceil(round(COVERAGE * len(sign), 9))


def _notices(words: list[str], start: int, stop: int, sign: list[str]) -> list[tuple[float, int, int]]:
    """(coverage, first word, last word) of the notices of one template from ``start`` to ``stop``."""
    pairs = _tightest(words[start:stop], sign)
    if not pairs:
        return []
    first, last = start + pairs[0][0], start + pairs[-1][0]
    before, after = _notices(words, start, first, sign), _notices(words, last + 1, stop, sign)
    return [*before, (len(pairs) / len(sign), first, last), *after]


def _tightest(part: list[str], sign: list[str]) -> list[tuple[int, int]]:
    """The best alignment within any run about as long as the template, if it is a notice."""
    need, span, best = _need(sign), len(sign) + max(2, len(sign) // 4), []
    inside = [w in sign for w in part]
    upto = [0, *accumulate(inside)]
    for s in range(len(part) - need + 1):
        # no more words can be aligned than the run has of the template
        if inside[s] and upto[min(s + span, len(part))] - upto[s] >= max(need, len(best) + 1):
            pairs = patience(part[s : s + span], sign)
            if len(pairs) >= max(need, len(best) + 1):
                best = [(s + p, q) for p, q in pairs]
    return best


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for text in b["text"]:
            found = scan_text(text) if text else []
            # most coverage, then the longer template, then the name
            top = max(found, key=lambda f: (f[1], len(_SIGN[f[0]]), f[0]), default=(None, 0.0, None, None))
            every = [dict(zip(("license", "coverage", "first_word", "last_word"), f, strict=True)) for f in sorted(found, key=lambda f: (f[2], f[3], f[0]))]
            rows.append((*top, len(found), every))
        got = pd.DataFrame(rows, columns=["license", "coverage", "first_word", "last_word", "n_notices", "notices"], index=b.index)
        got = got.astype({"first_word": "Int64", "last_word": "Int64"})
        yield pd.concat([b[["doc_id"]], got], axis=1)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, license, coverage, first_word, last_word, n_notices, notices of every row of docs.

    The first columns hold the best notice, ``notices`` all of them by place.
    Defined cases: null, empty and notice-free texts get a null license and
    coverage 0; repeated rows and null ids are kept; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, license string, coverage double, first_word long, last_word long, n_notices int, notices array<struct<license: string, coverage: double, first_word: long, last_word: long>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(_scan, schema)
