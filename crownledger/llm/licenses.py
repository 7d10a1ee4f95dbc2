"""License scans by conditional compression.

A candidate block is compressed once alone and once per template with the template as a raw zstandard dictionary. The
template that saves most bytes explains most of the block, so templates are tried in that order, and the first whose wording confirms
is the notice: a share of its words must be there in order, and the words that the block lacks, or has instead, are reported.
The order decides between templates of which one is a part of another; it drops none, for the walk goes on until one confirms.

Candidate blocks are the words around each anchor, as many on either side as the longest template has. The anchors come from
the templates: of each the longest words, one more than a notice may lack, so that no notice is without any. Texts
without anchors are passed over by one look at their words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from math import ceil

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from crownledger.llm.text import as_bytes, kind_of, schema

SIMILARITY = 0.8  # share of the template's words that must be there, in order
LEVEL = 3

#: fixed values: the wording of common notices
TEMPLATES = {
    "MIT-short": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "Apache-short": "Licensed under the Apache License, Version 2.0.",
    "Apache": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "CC-short": "Licensed under CC BY-NC 4.0.",
    "CC": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Rights-reserved": "Copyright. All rights reserved.",
}

WORD = re.compile(rb"[0-9A-Za-z]+(?:[.-][0-9A-Za-z]+)*")
#: Bytes that are no part of a plain word become spaces, A-Z become a-z.
LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if chr(c).isascii() and chr(c).isalnum() else 0x20 for c in range(256))


@dataclass(frozen=True)
class Notice:
    """A confirmed notice: its place in bytes, the bytes saved, the share of the template's words, and the differences."""

    license: str
    start: int
    end: int
    saved: int
    similarity: float
    differences: tuple[str, ...]


class Template:
    def __init__(self, name: str, text: str):
        self.name, data = name, text.encode()
        self.words = [w.lower() for w in WORD.findall(data)]
        self.bag = Counter(self.words)
        self.size = len(self.words)
        self.packer = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False
        )


    def anchors(self, similarity: float) -> list[bytes]:
        """The longest plain words of the template, one more than a notice may lack: each notice has one of them."""
        lacking = self.size - ceil(similarity * self.size - 1e-9)
        return sorted((w for w in self.bag if w.isalnum()), key=lambda w: (-len(w), w))[: lacking + 1]


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES, similarity: float = SIMILARITY):
        self.templates = [Template(*t) for t in templates.items()]
        self.similarity = similarity
        self.reach = max((t.size for t in self.templates), default=0)
        self.anchors = {w for t in self.templates for w in t.anchors(similarity)}
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    def notices(self, text: bytes) -> list[Notice]:
        """The notices of a text by place; they do not overlap."""
        if self.anchors.isdisjoint(text.translate(LETTERS).split()):
            return []
        words = list(WORD.finditer(text))
        anchors = [i for i, w in enumerate(words) if not self.anchors.isdisjoint(w[0].translate(LETTERS).split())]
        found: list[Notice] = []
        done = 0  # words before are parts of notices or have been compared
        for at in anchors:
            while at >= done:
                low = max(done, at - self.reach)
                own, last = self._in_block(text, words[low : at + self.reach])
                if not own:
                    break
                found += own
                done = low + last
        return found

    def savings(self, block: bytes) -> list[int]:
        """Bytes that each template saves when the block is compressed with it."""
        alone = len(self.plain.compress(block))
        return [alone - len(t.packer.compress(block)) for t in self.templates]

    def _in_block(self, text: bytes, words: list[re.Match[bytes]]) -> tuple[list[Notice], int]:
        """The notice of a block that explains most of it, those before it, and the number of words up to its end."""
        if not words:
            return [], 0
        saved = self.savings(text[words[0].start() : words[-1].end()])
        own = [w[0].lower() for w in words]
        bag = Counter(own)
        for i in sorted(range(len(saved)), key=lambda i: (-saved[i], i)):
            template = self.templates[i]
            common = sum(min(n, bag[w]) for w, n in template.bag.items())
            match = self._confirmed(template, own) if common >= self.similarity * template.size else None
            if match:
                first, last, equal, differences = match
                place = words[first].start(), words[last - 1].end()
                notice = Notice(template.name, *place, saved[i], equal / template.size, differences)
                return [*self._in_block(text, words[:first])[0], notice], last
        return [], 0

    def _confirmed(self, template: Template, own: list[bytes]) -> tuple[int, int, int, tuple[str, ...]] | None:
        """The place of the template's best occurrence among the words, if enough of it is there."""
        n = len(template.words)
        runs = SequenceMatcher(None, own, template.words, autojunk=False)
        longest = runs.find_longest_match()
        if not longest.size:
            return None
        low, high = max(0, longest.a - longest.b - n // 4), min(len(own), longest.a + n - longest.b + n // 4)
        codes = SequenceMatcher(None, own[low:high], template.words, autojunk=False).get_opcodes()
        same = [c for c in codes if c[0] == "equal"]
        equal = sum(c[2] - c[1] for c in same)
        if equal < self.similarity * n:
            return None
        first, last, differences = low + same[0][1], low + same[-1][2], []
        for kind, a, b, c, d in codes:
            a, b = low + a, low + b
            if b <= first:  # before the first common word, as many words as the template has there
                a = max(a, b - (d - c))
                first = a if d > c else first
            elif a >= last:
                b = min(b, a + (d - c))
                last = b if d > c else last
            if kind != "equal":
                differences += [f"-{w.decode()}" for w in template.words[c:d]] + [f"+{w.decode()}" for w in own[a:b] if d > c or first <= a < b <= last]
        return first, last, equal, tuple(differences)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, license, start, end, saved, similarity, differences) per notice; places in code points.

    Null and empty texts hold none; a notice that stands twice gives two rows, and so do repeated rows.
    """
    rows = docs.select("doc_id", as_bytes().alias("text"))
    out = schema(
        doc_id=kind_of(rows, "doc_id"), license="string", start="long", end="long", saved="long", similarity="double", differences="string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            at, columns = [], []
            for i, value in enumerate(batch.column(1)):
                text = value.as_py()
                for n in scanner.notices(text):
                    start = len(text[: n.start].decode("utf-8", "replace"))
                    end = start + len(text[n.start : n.end].decode("utf-8", "replace"))
                    at.append(i)
                    columns.append((n.license, start, end, n.saved, n.similarity, " ".join(n.differences)))
            if at:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *map(pa.array, zip(*columns, strict=True))], out.names)

    return rows.mapInArrow(run, out)


def op5_licenses(docs: DataFrame) -> DataFrame:
    """All notices of all texts, as :func:`scan` gives them.

    Null and empty texts hold none; a repeated row repeats its notices; a null id is kept; an empty table gives no rows.
    """
    return scan(docs)
