"""License scans by conditional compression.

A notice with at most k edited words keeps one of k + 1 parts of its template
word for word, so the places of these parts name every candidate window: the
template's length and k words of margin around them, however long the text.
Each window is compressed alone and with the template as zstandard raw
dictionary; the bytes saved rank the windows of a text, so they decide which
template takes a place that several claim.  In that order the exact wording
differences (the word alignment of the template inside the window) confirm
them; no window is given up for its rank.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Wording of common public notices; <...> stands for any words.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."],
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, version 2.0."],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work.", "Dedicated to the public domain under CC0 1.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-NonCommercial 4.0 International License."],
    "all-rights-reserved": ["All rights reserved."],
}
MOST_EDITS = 0.1          # share of a template's words that may differ
_WORD = re.compile(r"[^\W_]+(?:[.\-'][^\W_]+)*")

_SCHEMA = ("doc_id long, license string, template int, start long, length long, reduction double, edits int, "
           "template_words int, differences array<string>, kind string")
_NAMES = ["doc_id", "license", "template", "start", "length", "reduction", "edits", "template_words", "differences",
          "kind"]


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    spans = [m.span() for m in _WORD.finditer(text)]
    return [text[a:b].lower() for a, b in spans], spans


def align(template: list[str], words: list[str]) -> tuple[int, int, int, list[str]]:
    """Best place of ``template`` inside ``words``: (edits, first, end, differences).

    Word edit distance with free ends in ``words``; of equal places the first end.
    """
    m, n = len(template), len(words)
    cost = np.zeros((m + 1, n + 1), np.int32)
    cost[:, 0] = np.arange(m + 1)
    ids = {w: i for i, w in enumerate(dict.fromkeys(template))}
    t, w = np.array([ids[x] for x in template]), np.array([ids.get(x, -1) for x in words])
    steps = np.arange(n + 1)
    for i in range(1, m + 1):
        row = np.empty(n + 1, np.int32)
        row[0] = i
        row[1:] = np.minimum(cost[i - 1, :-1] + (w != t[i - 1]), cost[i - 1, 1:] + 1)
        cost[i] = np.minimum.accumulate(row - steps) + steps
    end = int(np.argmin(cost[m]))
    i, j, told = m, end, []
    while i > 0:
        if j > 0 and cost[i, j] == cost[i - 1, j - 1] + (template[i - 1] != words[j - 1]):
            if template[i - 1] != words[j - 1]:
                told.append(f"{template[i - 1]} -> {words[j - 1]}")
            i, j = i - 1, j - 1
        elif cost[i, j] == cost[i - 1, j] + 1:
            told.append(f"- {template[i - 1]}")
            i -= 1
        else:
            told.append(f"+ {words[j - 1]}")
            j -= 1
    return int(cost[m, end]), j, end, told[::-1]


def parts(template: list[str]) -> list[tuple[int, int, int]]:
    """(first, end, place of the longest word) of parts of which every notice within the edits holds one unchanged."""
    n = int(MOST_EDITS * len(template)) + 1
    cuts = [len(template) * j // n for j in range(n + 1)]
    return [(a, b, max(range(a, b), key=lambda x: len(template[x]))) for a, b in zip(cuts, cuts[1:]) if b > a]


def signs(templates: dict[str, list[str]]) -> list[str]:
    """Words of which every text with a notice holds one (as a part of a word), the longest of each part."""
    words = [words_of(text)[0] for texts in templates.values() for text in texts]
    found = {w[x] for w in words for _, _, x in parts(w)}
    return sorted(w for w in found if not any(v in w for v in found - {w}))


class Scanner:
    """Templates as dictionaries; finds confirmed notices of one text."""

    def __init__(self, templates: dict[str, list[str]]):
        import zstandard
        # one set of parameters: a reduction is the dictionary's alone
        params = zstandard.ZstdCompressionParameters.from_level(
            3, source_size=1 << 12, write_checksum=False, write_content_size=False, write_dict_id=False)
        self.plain = zstandard.ZstdCompressor(compression_params=params)
        self.known = []
        self.parts: dict[str, list[tuple[int, int, int, int]]] = {}
        for name, texts in templates.items():
            for k, text in enumerate(texts):
                words = words_of(text)[0]
                raw = " ".join(words).encode()
                if not words:
                    continue
                made = zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(
                    raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
                for first, end, x in parts(words):
                    self.parts.setdefault(words[x], []).append((len(self.known), first, end, x))
                own = len(self.plain.compress(raw)) - len(made.compress(raw))
                self.known.append((name, k, words, made, max(own, 1)))

    def seeds(self, words: list[str]) -> list[tuple[int, int, int, int]]:
        """(template, place of the template's first word, first, end) of every part that occurs word for word."""
        out = []
        for at, word in enumerate(words):
            for i, first, end, x in self.parts.get(word, ()):
                a = at - x + first
                if a >= 0 and words[a:at - x + end] == self.known[i][2][first:end]:
                    out.append((i, at - x, a, at - x + end))
        return out

    def saved(self, i: int, words: list[str]) -> int:
        """Bytes that template ``i`` as dictionary saves on the compressed words."""
        raw = " ".join(words).encode()
        return len(self.plain.compress(raw)) - len(self.known[i][3].compress(raw))

    def reduction(self, i: int, words: list[str]) -> float:
        return self.saved(i, words) / self.known[i][4]

    def scan(self, text: str | None) -> list[tuple]:
        """(license, template, start, length, reduction, edits, words, differences, kind) by place.

        Every notice is found: of all windows the one that its template shrinks
        most is tried first, and taken if the alignment confirms it; a window
        that it cuts is compressed anew in what it leaves, until none is left.
        """
        words, spans = words_of(text or "")
        free: list[int] = []      # ends of taken places, in order; `taken` holds their firsts
        taken: list[int] = []
        seen: dict = {}
        heap: list[tuple] = []

        def offer(seed: tuple[int, int, int, int], lo: int, hi: int) -> None:
            i, place, _, _ = seed
            m = len(self.known[i][2])
            margin = int(MOST_EDITS * m)
            a, b = max(lo, place - margin), min(hi, place + m + margin)
            if (i, a, b) not in seen:
                seen[i, a, b] = self.saved(i, words[a:b])
            heapq.heappush(heap, (-seen[i, a, b], a, b, i, seed))

        for seed in self.seeds(words):
            offer(seed, 0, len(words))
        out, told = [], {}
        while heap:
            _, a, b, i, seed = heapq.heappop(heap)
            k = bisect_right(taken, seed[2])
            lo, hi = free[k - 1] if k else 0, taken[k] if k < len(taken) else len(words)
            if seed[2] < lo or seed[3] > hi:
                continue                      # the unchanged part itself is taken
            if a < lo or b > hi:
                offer(seed, lo, hi)
                continue
            name, number, template, _, _ = self.known[i]
            if (i, a, b) not in told:
                told[i, a, b] = align(template, words[a:b])
            edits, first, end, differences = told[i, a, b]
            if edits > int(MOST_EDITS * len(template)):
                continue
            first, end = a + first, a + end
            taken.insert(k, first)
            free.insert(k, end)
            out.append((name, number, spans[first][0], spans[end - 1][1] - spans[first][0],
                        self.reduction(i, words[first:end]), edits, len(template), differences,
                        "exact" if not edits else "changed"))
        return sorted(out, key=lambda r: (r[2], r[0]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per confirmed notice: ``doc_id, license, template, start, length, reduction, edits, template_words,
    differences, kind`` (start and length in code points of the text).

    Texts without a word of any template's parts are passed over by a built-in filter.  Null
    and empty texts hold no notice; a null id is carried; repeated rows give
    repeated notices; an empty table gives no rows.
    """
    templates = templates or TEMPLATES
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = signs(templates)
    rows = rows.filter("text IS NOT NULL")
    if all(w.isascii() for w in found):
        rows = rows.filter(F.col("text").rlike("(?iu)" + "|".join(map(re.escape, found))))
    types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(),
             pa.list_(pa.string()), pa.string()]

    def run(batches):
        s = Scanner(templates)
        for b in batches:
            found = [(d, *r) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for r in s.scan(t)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=_NAMES)
    return rows.mapInArrow(run, _SCHEMA)
