"""License scans by conditional compression.

A block of text that says what a license template says compresses to little more than
nothing if the compressor has the template as its dictionary. Candidate blocks (lines
with a word that licenses use, alone and joined with the non-empty lines around them, as
notices are wrapped) are compressed with each template as a raw zstandard
dictionary and without one, and every template that makes it small enough is confirmed by
the exact differences in wording: few enough of its words may be missing or changed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

# The wording of notices, by name of the license.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:",
    ),
    "LGPL-3.0": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "All-Rights-Reserved": (
        "All rights reserved.",
    ),
}
# White space between two words of a cue may be the end of a line.
CUE = (r"(?i)licen[sc]e|copyright|spdx|permission\s+is\s+hereby|redistribut|creative\s+commons|\bCC.BY\b"
       r"|all\s+rights\s+reserved|permission\s+to\s+use|public\s+domain|unencumbered")
MAX_DIFFERENT = 0.2
MIN_SAVED = 0.4

# Wordings that count only as a whole sentence, as further words give them another sense.
WHOLE = {"All-Rights-Reserved": re.compile(r"(?i)all\s+rights\s+reserved\s*(?:[^\w\s]|\n|$)")}
# Words in front of a notice, or added to it, that deny it.
DENIALS = frozenset("not no never nor neither isn't aren't wasn't cannot".split())

_NUMBER = re.compile(r"v?\d+(?:\.\d+)*")
_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")
_HYPHEN = re.compile(r"[^\W_]-\s*$")
_COLUMNS = pa.schema([
    ("doc_id", pa.int64()), ("block_no", pa.int64()), ("license", pa.string()), ("wording", pa.int32()),
    ("plain_bytes", pa.int64()), ("with_template_bytes", pa.int64()), ("saved", pa.float64()),
    ("n_equal", pa.int64()), ("n_missing", pa.int64()), ("n_added", pa.int64()),
    ("confirmed", pa.bool_()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("block", pa.string())])


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@lru_cache(maxsize=1)
def _compressors():
    """A compressor without a dictionary, and one per wording."""
    import zstandard

    def compressor(template: str | None):
        if template is None:
            return zstandard.ZstdCompressor(level=19, write_content_size=False)
        raw = zstandard.ZstdCompressionDict(template.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(level=19, dict_data=raw, write_content_size=False, write_dict_id=False)

    wordings = [
        (name, number, words_of(text), compressor(" ".join(words_of(text))))
        for name, texts in TEMPLATES.items() for number, text in enumerate(texts)]
    return compressor(None), wordings


def _laid(template: list[str], found: list[str]) -> tuple[int, int, int, int]:
    """(words equal, missing, added, first word) of the part of ``found`` that differs
    least from the template; it begins and ends with words of it."""
    runs = [r for r in SequenceMatcher(None, template, found, autojunk=False).get_matching_blocks() if r.size]
    best = (0, len(template), 0, 0)
    # Single words that the template shares with another notice far away are left out.
    for i, first in enumerate(runs):
        equal = 0
        for run in runs[i:]:
            equal += run.size
            row = (equal, len(template) - equal, run.b + run.size - first.b - equal, first.b)
            if row[1] + row[2] < best[1] + best[2]:
                best = row
    return best


def _says_the_same(name: str, template: list[str], found: list[str], start: int, end: int, block: str) -> bool:
    """Whether the words that may not differ agree: numbers, as of versions, denials, and the
    end of a sentence."""
    part = found[start:end]
    numbers = [sorted(w.lstrip("v") for w in words if _NUMBER.fullmatch(w)) for words in (template, part)]
    denied = DENIALS.intersection(found[max(start - 2, 0):start]) or DENIALS.intersection(part) - set(template)
    return numbers[0] == numbers[1] and not denied and (name not in WHOLE or bool(WHOLE[name].search(block)))


def matches(block: str) -> list[tuple]:
    """(license, wording, bytes, bytes with template, share saved, words equal, missing from
    the template, added within, confirmed, first word, words) of every license that some
    wording confirms, those that differ least first; of the wording that saves most if
    none is confirmed. Empty if the block has no word.

    The part of the block that is laid over the template begins and ends with words of
    it; text before and after counts neither as missing nor as changed. No word counts
    for two licenses.
    """
    found = words_of(block)
    if not found:
        return []
    alone, wordings = _compressors()
    line = " ".join(found).encode()
    plain, frame = len(alone.compress(line)), len(alone.compress(b""))
    rows = []
    for name, number, template, compressor in wordings:
        smaller = len(compressor.compress(line))
        saved = (plain - smaller) / plain
        equal, missing, added, first = _laid(template, found)
        # Neither the words around a notice nor the frame of the compressor, which is most
        # of a short one, decide: what its own words save is taken.
        part = " ".join(found[first:first + equal + added]).encode()
        own = len(alone.compress(part))
        confirmed = missing + added <= MAX_DIFFERENT * len(template) and (
            own - len(compressor.compress(part)) >= MIN_SAVED * (own - frame)) and _says_the_same(
            name, template, found, first, first + equal + added, block)
        rows.append((name, number, plain, smaller, saved, equal, missing, added, confirmed, first, equal + added))
    out: list[tuple] = []
    taken: list[tuple[int, int]] = []
    for row in sorted((r for r in rows if r[8]), key=lambda r: (r[6] + r[7], -r[5])):
        start, end = row[9], row[9] + row[10]
        if all(end <= a or b <= start for a, b in taken):
            taken.append((start, end))
            if row[0] not in [r[0] for r in out]:
                out.append(row)
    return out or [max(rows, key=lambda r: r[4])]


def match(block: str) -> tuple | None:
    """The first of :func:`matches`; None if the block has no word."""
    return next(iter(matches(block)), None)


def _reach() -> int:
    """Words looked at on either side of a line: what the longest template may take."""
    return int(max(len(words_of(t)) for texts in TEMPLATES.values() for t in texts) * (1 + MAX_DIFFERENT)) + 1


def _around(lines: list[str], at: int, step: int, reach: int) -> list[str]:
    """The next ``reach`` words of the non-empty lines after (step 1) or before (-1) line ``at``."""
    words: list[str] = []
    at += step
    while 0 <= at < len(lines) and lines[at].strip() and len(words) < reach:
        here = words_of(lines[at])
        if here and _HYPHEN.search(lines[at]):
            here[-1] += "-"
        words = words + here if step == 1 else here + words
        at += step
    return words[:reach] if step == 1 else words[-reach:]


def _in_line(block: str, before: list[str], after: list[str]) -> list[tuple[tuple, str]]:
    """(match, text) of every license confirmed in a line, or in the line and its
    neighbours if some of its words are in the line; else of the best wording."""
    alone = matches(block)
    if not before and not after:
        return [(row, block) for row in alone]
    size, start = len(words_of(block)), len(before)
    # A word with a hyphen may be cut at it.
    joined = re.sub(r"(?<=\w)-\s+(?=\w)", "-", " ".join([*before, block, *after]))
    sure = [row for row in alone if row[8]]
    wrapped = [
        row for row in matches(joined)
        # Some words in the line and some outside, none of them another license's.
        if row[8] and row[9] < start + size and row[9] + row[10] > start
        and (row[9] < start or row[9] + row[10] > start + size)
        and row[0] not in [r[0] for r in sure]
        and all(row[9] + row[10] <= start + r[9] or start + r[9] + r[10] <= row[9] for r in sure)]
    return [(row, block) for row in sure or ([] if wrapped else alone)] + [(row, joined) for row in wrapped]


def cue_lines(text: str, cue: str = CUE) -> list[tuple[int, str, list[str], list[str]]]:
    """(number from 0, line, words before, words after) of the lines in which a cue begins."""
    lines, reach = text.split("\n"), _reach()
    ends = list(accumulate(len(line) + 1 for line in lines))
    found = sorted({bisect_right(ends, m.start()) for m in re.finditer(cue, text)})
    return [(at, lines[at], _around(lines, at, -1, reach), _around(lines, at, 1, reach)) for at in found]


def _scanner(cue: str):
    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (row["doc_id"], at, *found, text) for row in batch.to_pylist()
                for at, line, before, after in cue_lines(row["text"], cue)
                for found, text in _in_line(line, before, after)]
            columns = zip(*rows) if rows else [[]] * len(_COLUMNS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, _COLUMNS)], schema=_COLUMNS)

    return scanned


def scan(documents: DataFrame, cue: str = CUE) -> DataFrame:
    """One row per line with a cue and license that a wording confirms in it or across it
    and its neighbours, with the figures, the words it takes and the text they are counted
    in; where none is confirmed, one row with the wording that saves most.

    NULL and empty texts have no block; repeated rows give repeated rows.
    """
    texts = documents.filter(F.col("text").rlike(cue)).select(F.col("doc_id").cast("bigint"), "text")
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Candidates are few and may come from few files; they are dealt out anew.
    return texts.repartition(partitions).mapInArrow(_scanner(cue), from_arrow_schema(_COLUMNS))


def confirmed_licenses(documents: DataFrame) -> DataFrame:
    return scan(documents).filter("confirmed")
