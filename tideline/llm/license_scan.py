"""License scan: MinHash bands over overlapping windows, verified by shingle containment.

Texts and templates are read as five-word shingles (words are ``\\w+``, lower-cased).  A template
of fewer words is one sequence of its own length, looked up exactly.  A longer template of s shingles is in the size class of blocks of L
shingles, L the power of two (``MIN_BLOCK`` at least) that is not below s.  Windows are two
neighbouring blocks, so every stretch of up to L shingles lies whole in a window.  A window's
MinHash has ``BANDS`` bands of one row: it retrieves the templates of its class that share a
minimum with it.

A window that holds the share c of a template has Jaccard similarity of at least

    j = c s / (2 L + (1 - c) s)

to it, and is missed with probability (1 - j)^BANDS.  With BANDS = 128 this is under 1e-4 for a
single-shingle template at c = 1 (j = 1/9 or more), and under 1e-9 for a template of its class's
least size, s = L/2 + 1, at c = 0.8 (j > 0.19).  Retrieved templates are verified: at least
``containment`` of the template's distinct shingles must be in the window, within one document.

Scale: one scan, no shuffle; the templates (checked to be under ``MAX_TEMPLATE_BYTES``) are
broadcast.  A slice of texts is hashed as one stream; windows over two documents only cost a check.

Edge cases: null and empty texts give no rows; repeated rows give repeated rows; a template that
occurs several times in a document gives one row, of the best window (the first on a tie); empty
tables give none; other columns are ignored.
"""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.llm.common import Shared, mix64, text_slices, texts
from tideline.sources.tables import read_table

WORD = re.compile(r"\w+")
SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 128
MIN_BLOCK = 4
MAX_TEMPLATE_BYTES = 16 << 20
MAX_CACHED_WORDS = 120_000

# Notices of common licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
            "to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

# SPDX identifiers; the first, any other or none; "GPL-2.0" is the start of "GPL-2.0-only" and "GPL-2.0-or-later".
SPDX = ["", "0BSD", "AGPL-3.0", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0",
        "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib"]

#: Sequences that have no licence's sentence: reserved rights, copyright lines, SPDX tags.
NOTICES = [("All-rights-reserved", "All rights reserved."), ("Copyright", "Copyright (c)"), *(("Copyright", f"Copyright {y}") for y in range(1970, 2050)),
           *((x or "SPDX", f"SPDX-License-Identifier: {x}") for x in SPDX)]


def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of the whole licences in the folder ``licenses``."""
    return [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]


#: What the scan looks for.
ALL_TEMPLATES = [*TEMPLATES, *NOTICES, *full_texts()]


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > MAX_CACHED_WORDS:
            self.clear()
        self[word] = x = xxhash.xxh64_intdigest(word.encode())
        return x


def word_hashes(words: list[str], known: _Words) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(a: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """The hash of every shingle of k words (given by their hashes), in order; none for fewer words."""
    if len(a) < k:
        return np.zeros(0, np.uint64)
    n = len(a) - k + 1
    h = a[:n]
    for i in range(1, k):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + a[i:n + i]
    return mix64(h)


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], containment: float = CONTAINMENT, bands: int = BANDS):
        rng = np.random.default_rng(5)
        self.flip = rng.integers(0, 1 << 32, bands, dtype=np.uint32)
        self.odd = rng.integers(0, 1 << 31, bands, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.containment, self.known, self.sets, self.names = containment, _Words(), [], []
        self.classes: dict[int, list[int]] = {}
        self.short: dict[int, dict[int, list[int]]] = {}  # words: {hash: templates}
        for t, (name, text) in enumerate(templates):
            a = word_hashes(WORD.findall(text.lower()), self.known)
            s = np.unique(shingle_hashes(a, min(SHINGLE, max(1, len(a)))))
            if len(a) >= SHINGLE:
                block = MIN_BLOCK
                while block < len(s):
                    block *= 2
                self.classes.setdefault(block, []).append(t)
            elif len(a):
                self.short.setdefault(len(a), {}).setdefault(int(s[0]), []).append(t)
            self.sets.append(s)
            self.names.append(name)
        low = [self._low(s) for s in self.sets]
        self.least = np.array([[self._hash(x, b).min(initial=0xFFFFFFFF) for x in low] for b in range(bands)], np.uint32).reshape(bands, len(low))

    @staticmethod
    def _low(x: np.ndarray) -> np.ndarray:
        return (x >> np.uint64(32)).astype(np.uint32)

    def _hash(self, x: np.ndarray, band: int) -> np.ndarray:
        return (x ^ self.flip[band]) * self.odd[band]

    def candidates(self, stream: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, first shingle, shingles) of the windows retrieved."""
        if not len(stream) or not self.classes:
            return []
        largest = max(self.classes)
        size = -(-len(stream) // (2 * largest)) * 2 * largest + largest
        x, found = self._low(stream), {}
        for band in range(len(self.flip)):
            least = np.full(size, 0xFFFFFFFF, np.uint32)
            least[:len(x)] = self._hash(x, band)
            block = 1
            while block <= largest:
                if block in self.classes:
                    window = np.minimum(least[:-1], least[1:])
                    for t in self.classes[block]:
                        if len(hit := np.flatnonzero(window == self.least[band, t])):
                            found.setdefault((t, block), []).append(hit)
                if len(least) % 2:
                    least = np.r_[least, np.uint32(0xFFFFFFFF)]
                least = np.minimum(least[0::2], least[1::2])
                block *= 2
        return [(t, int(w) * block, 2 * block) for (t, block), hits in found.items() for w in np.unique(np.concatenate(hits))]

    def scan(self, batch: list[str]) -> list[tuple[int, int, int, float]]:
        """(row, template, first word, containment), one for each row and template that it contains."""
        words = [word_hashes(WORD.findall(t.lower()), self.known) for t in batch]
        streams = [shingle_hashes(a) for a in words]
        ends = np.cumsum([len(s) for s in streams])
        stream, best = np.concatenate(streams), {}
        for t, first, n in self.candidates(stream):
            row = int(np.searchsorted(ends, first, "right"))
            while row < len(batch) and (begin := int(ends[row]) - len(streams[row])) < first + n:
                a = max(first, begin)
                part = stream[a:min(first + n, int(ends[row]))]
                inside = np.isin(part, self.sets[t])
                share = len(np.unique(part[inside])) / len(self.sets[t])
                if share >= self.containment:
                    best[row, t] = min(best.get((row, t), (0.0, 0)), (-share, a - begin + int(np.argmax(inside))))
                row += 1
        all_words, word_ends = np.concatenate(words), np.cumsum([len(a) for a in words])
        for k, templates in self.short.items():
            h = shingle_hashes(all_words, k)
            for at in np.flatnonzero(np.isin(h, np.array(list(templates), np.uint64))).tolist():
                row = int(np.searchsorted(word_ends, at, "right"))
                if at + k <= word_ends[row]:
                    for t in templates[int(h[at])]:
                        place = (-1.0, at - int(word_ends[row]) + len(words[row]))
                        best[row, t] = min(best.get((row, t), place), place)
        return [(row, t, at, -share) for (row, t), (share, at) in sorted(best.items())]


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = ALL_TEMPLATES, doc_id: str = "doc_id", text: str = "text",
                  containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, license, template, start_word, containment): a row per document and template found."""
    if sum(len(t) for _, t in templates) > MAX_TEMPLATE_BYTES:
        raise ValueError("templates are broadcast; scan with parts of them")
    shared = Shared(docs.sparkSession, Scanner(templates, containment))
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("license", T.StringType()), T.StructField("template", T.IntegerType()),
                           T.StructField("start_word", T.LongType()), T.StructField("containment", T.DoubleType())])
    names = schema.fieldNames()

    def task(batches):
        scanner = shared.value
        for batch in text_slices(batches, "t"):
            if hits := scanner.scan(texts(batch, "t")):
                row, t, at, share = zip(*hits)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row, pa.int64())), pa.array([scanner.names[i] for i in t]), pa.array(t, pa.int32()),
                                                  pa.array(at, pa.int64()), pa.array(share, pa.float64())], names=names)

    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).mapInArrow(task, schema)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document."""
    return scan_licenses(read_table(spark, sf_dir, "documents"))
