"""License notices, found by conditional compression.

Candidate blocks are the words around license vocabulary. A block is compressed by itself and once with each
template as a raw zstandard dictionary: the more a template says about the block, the smaller it gets. The
templates are ranked by that reduction, and those that help are compared word by word: the template is
aligned with the part of the block it fits best, and confirmed if at most a tenth of its words differ.
Templates under ten words so must occur exactly, but for case and punctuation. What lies before and after a
confirmed notice is searched again, so a block may hold several.

A text is read whole; a block is bounded by cutting long ones with an overlap of the longest template.
NULL and empty texts, and those without license vocabulary, give no rows. Repeated rows are reported as often
as they occur; other columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The usual wording of public license notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
]
VOCABULARY = r"(?i)licen[sc]|copyright|redistribution|permission|warrant|public domain|creative commons|rights reserved|rights to this work"

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(VOCABULARY.replace(" ", r"[\x20\x09-\x0D]+"))
_MARK_WORD = re.compile("licen[sc]|copyright|redistribution|permission|warrant|domain|commons|rights")
_BARE = re.compile(r"^[^0-9a-zA-Z]+|[^0-9a-zA-Z]+$")
_LONGEST = max(len(text.split()) for _, text in TEMPLATES)
#: Words of a block at most; a longer one is cut into overlapping parts.
_BLOCK = 4 * _LONGEST


def _bare(word: str) -> str:
    return _BARE.sub("", word).lower()


@cache
def _compressors() -> tuple[zstandard.ZstdCompressor, list[tuple[str, list[str], zstandard.ZstdCompressor]]]:
    """A plain compressor; per template its license, words and compressor."""
    plain, out = zstandard.ZstdCompressor(level=3), []
    for name, text in TEMPLATES:
        words = [b for b in map(_bare, text.split()) if b]
        data = " ".join(words).encode()
        known = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        out.append((name, words, zstandard.ZstdCompressor(level=3, dict_data=known)))
    return plain, out


def _align(template: list[str], block: list[str]) -> tuple[int, int, int]:
    """Fewest word edits that make the template a run of the block, and where that run is."""
    n = len(block)
    cost, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    steps = np.arange(n + 1)
    words = np.array(block)
    for i, word in enumerate(template, 1):
        change = cost[:-1] + (words != word)
        new = np.concatenate(([i], np.minimum(change, cost[1:] + 1)))
        begin = np.concatenate(([0], np.where(change <= cost[1:] + 1, origin[:-1], origin[1:])))
        # Words of the block that the template lacks.
        reach = np.minimum.accumulate(new - steps)
        last = np.maximum.accumulate(np.where(new - steps == reach, steps, 0))
        cost, origin = reach + steps, begin[last]
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


def _search(block: list[str], first: int) -> Iterator[tuple[int, int, str, int, float]]:
    """Notices in a block: first and last word, license, differing words, reduction."""
    if not block:
        return
    plain, templates = _compressors()
    marks = [i for i, word in enumerate(block) if _MARK_WORD.search(word)]
    ranked, alone = [], cache(lambda data: len(plain.compress(data)))
    for number, (_, words, compressor) in enumerate(templates):
        # As many words on both sides of a mark as the template can reach; long runs of marks share a piece.
        reach, pieces = len(words) + len(words) // 10, []
        for mark in marks:
            low, high = max(0, mark - reach), mark + reach + 1
            if pieces and low - pieces[-1][0] < reach:
                pieces[-1][1] = high
            else:
                pieces.append([low, high])
        texts = [" ".join(block[low:high]).encode() for low, high in pieces]
        share = max(((alone(data) - len(compressor.compress(data))) / alone(data) for data in texts), default=0)
        if share > 0:
            ranked.append((-share, number))
    best = None
    for share, number in sorted(ranked):
        name, words, _ = templates[number]
        differing, begin, end = _align(words, block)
        if 10 * differing <= len(words) and end > begin:
            # Of the confirmed, the longest wording says most.
            key = (len(words) - 2 * differing, -begin)
            if best is None or key > best[0]:
                best = key, begin, end, name, differing, -share
    if best is not None:
        _, begin, end, name, differing, share = best
        yield first + begin, first + end - 1, name, differing, share
        yield from _search(block[:begin], first)
        yield from _search(block[end:], first + end)


def notices(text: str | None) -> list[tuple[int, int, str, int, float]]:
    """License notices of a text: start and end in code points, license, differing words, reduction."""
    if not text or not _MARK.search(text):
        return []
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    starts = [w[0] for w in words]
    blocks: list[list[int]] = []
    for mark in _MARK.finditer(text):
        at = int(np.searchsorted(starts, mark.start(), "right")) - 1
        low, high = max(0, at - _LONGEST), min(len(words), at + _LONGEST + 1)
        if blocks and low <= blocks[-1][1]:
            blocks[-1][1] = high
        else:
            blocks.append([low, high])
    found = {}
    for low, high in blocks:
        while True:
            part = min(high, low + _BLOCK)
            kept = [(i, b) for i in range(low, part) if (b := _bare(text[words[i][0] : words[i][1]]))]
            for begin, end, name, differing, share in _search([b for _, b in kept], 0):
                span = words[kept[begin][0]][0], words[kept[end][0]][1]
                found.setdefault(span, (name, differing, share))
            if part == high:
                break
            low = part - 2 * _LONGEST
    return [(*span, *found[span]) for span in sorted(found)]


def scan(docs: DataFrame) -> DataFrame:
    """License notices of ``docs`` (doc_id, text): doc_id, start, end, license, differing, reduction."""
    schema = T.StructType([docs.schema["doc_id"]] + [
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("license", T.StringType()),
        T.StructField("differing", T.LongType()), T.StructField("reduction", T.DoubleType()),
    ])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(doc, *found) for doc, text in zip(batch["doc_id"], batch["text"]) for found in notices(text)]
            if rows:
                yield pd.DataFrame(rows, columns=schema.names)

    # Most texts have none of the vocabulary and never leave the JVM.
    marked = docs.where(F.col("text").rlike(_MARK.pattern)).select("doc_id", "text")
    return marked.mapInPandas(run, schema)
