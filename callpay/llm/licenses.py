"""License scans by conditional compression.

A candidate block is a window of words around a word that licences use, as long as the template it is held against
and placed so that both have that word at the same place. Words are runs of letters or numbers, so a window runs over line
ends, comment marks and quotes. A block is compressed on its own and again with the template's wording as a raw
zstandard dictionary; the bytes that the dictionary saves rank the templates. In that order they are confirmed by
their exact wording: the words that differ are listed, and the block counts as that licence if hardly any do and none
of them is a version or one of the words that tell licences apart. Words before and after the block are no
difference, unless they deny it or allow later versions.

Only documents with such a word reach Python, in batches of bounded size, whole.

Cases: NULL and empty texts have no blocks; a text without cue gives one row with no block, and so does one whose cues no
template has; repeated rows repeat their result; a block at the start or end of a text is as long as the text
allows; an empty table gives no rows. Other columns do not pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpay.llm.shared import arrow_rows, stored

#: Public wordings of licence notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License, or"
        " (at your option) any later version."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at"
        " your option) any later version."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this"
        " list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above"
        " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution."
    ),
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this"
        " list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above"
        " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its"
        " contributors may be used to endorse or promote products derived from this software without specific prior"
        " written permission."
    ),
}
#: Words, in this order, that a licence notice has.
CUES = (
    ("licensed",), ("licenced",), ("license",), ("licence",), ("sublicense",), ("permission", "is", "hereby"),
    ("permission", "to", "use"), ("is", "hereby", "granted"), ("redistribute",), ("redistribution",), ("redistributions",),
    ("public", "domain"), ("cc0",), ("cc", "by"), ("mozilla", "public"),
)
#: The same as a pattern, for documents that have one.
CUE = "(?i)(?<![a-z])(?:" + "|".join("[^a-z0-9]+".join(c) for c in CUES) + ")(?![a-z0-9])"
#: Words that tell licences apart; a difference in one of them is a difference in kind.
TELLING = {"mit", "apache", "gnu", "lesser", "affero", "mozilla", "bsd", "cc", "by", "nc", "sa", "nd", "cc0", "not", "general"}
MAX_DIFFERENCE = 0.15
#: Texts that are handed to Python together.
TEXT_ROWS = 200
#: Directly before a block they deny it.
DENIALS = {"not", "never", "no", "nor", "isn", "aren", "without"}
_WORD = re.compile(r"[A-Za-z]+[0-9]*|[0-9]+(?:\.[0-9]+)*")


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def cue_places(found: Sequence[str]) -> list[tuple[int, tuple[str, ...]]]:
    """(place, cue) of every cue among words."""
    return [
        (i, cue) for i, w in enumerate(found) for cue in _BEGINS.get(w, ()) if tuple(found[i : i + len(cue)]) == cue
    ]


_BEGINS = {c[0]: [d for d in CUES if d[0] == c[0]] for c in CUES}


@cache
def _template(name: str) -> tuple[list[str], Counter]:
    found = words(TEMPLATES[name])
    return found, Counter(found)


@cache
def _anchors(cue: tuple[str, ...]) -> list[tuple[str, int]]:
    """Templates with that cue, and the place where they first have it."""
    placed = ((name, [i for i, c in cue_places(words(TEMPLATES[name])) if c == cue]) for name in TEMPLATES)
    return [(name, at[0]) for name, at in placed if at]


@cache
def _compressor(name: str | None) -> zstandard.ZstdCompressor:
    if name is None:
        return zstandard.ZstdCompressor(level=3)
    raw = " ".join(_template(name)[0]).encode()
    wording = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=3, dict_data=wording)


def sizes(block: Sequence[str], name: str) -> tuple[int, int]:
    """Compressed size of a block alone, and with the template as dictionary."""
    raw = " ".join(block).encode()
    return len(_compressor(None).compress(raw)), len(_compressor(name).compress(raw))


def limit(name: str) -> int:
    """Words in which a block may differ from a template."""
    return int(MAX_DIFFERENCE * len(_template(name)[0]))


def differences(found: Sequence[str], start: int, name: str) -> tuple[int, bool, int, int]:
    """(words that differ, whether one tells licences apart, first and next word) of the block near ``start``.

    The block may be longer than the template by the words it may differ in, at both ends; what it has before
    its first and after its last counterpart is not part of it.
    """
    a, bag = _template(name)
    low, high = max(0, start - limit(name)), min(len(found), start + len(a) + limit(name))
    b = found[low:high]
    missing = sum((bag - Counter(b)).values())
    if missing > limit(name):  # no order of these words comes closer
        return missing, False, start, min(len(found), start + len(a))
    changed, telling, first, after = 0, False, low, high
    for kind, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if kind == "equal":
            continue
        if j == len(a):  # what follows the block
            m = min(m, k + j - i)
            after = low + m
        if i == 0:  # what precedes it
            k = max(k, m - (j - i))
            first = low + k
        changed += max(j - i, m - k)
        telling = telling or any(x in TELLING or x[0].isdigit() for x in (*a[i:j], *b[k:m]))
    return changed, telling, first, after


def _qualified(found: Sequence[str], first: int, after: int) -> bool:
    """Do the words around a block deny it, or allow later versions?"""
    following = found[after : after + 6]
    return bool(DENIALS & set(found[max(0, first - 2) : first])) or (following[:1] == ["or"] and "later" in following)


def scan(text: str) -> list[tuple[int, str, float, int, bool]]:
    """Per candidate block: start, best template, its saving, words that differ, confirmed."""
    matches = list(_WORD.finditer(text))
    found = [m.group().lower() for m in matches]
    blocks, covered, tried = [], 0, 0
    for at, cue in cue_places(found):
        if at < covered:
            continue
        ranked = []
        for name, offset in _anchors(cue):
            start = max(0, at - offset)
            alone, given = sizes(found[start : at - offset + len(_template(name)[0])], name)
            ranked.append((alone - given, 1 - given / alone, name, start))
        ranked.sort(key=lambda r: (-r[0], r[2]))
        for _, share, name, start in ranked:
            n, telling, first, after = differences(found, start, name)
            if not telling and n <= limit(name) and not _qualified(found, first, after):
                blocks.append((matches[first].start(), name, share, n, True))
                covered = after
                break
        else:
            if ranked and at >= tried:
                _, share, name, start = ranked[0]
                n, _, first, after = differences(found, start, name)
                blocks.append((matches[first].start(), name, share, max(n, 1), False))
                tried = max(after, at + 1)
    return blocks


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per candidate block: doc_id, block, start, license, saving, n_differences, confirmed; one row with NULLs without."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                blocks = scan(text.as_py()) or [(None, None, None, None, False)]
                rows += [(doc_id, i, *b) for i, b in enumerate(blocks)]
            names = ["doc_id", "block", "start", "license", "saving", "n_differences", "confirmed"]
            types = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.bool_()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = f"doc_id {kind}, block int, start bigint, license string, saving double, n_differences bigint, confirmed boolean"
    rows = docs.select("doc_id", "text")
    has_cue = F.coalesce(F.col("text").rlike(CUE), F.lit(False))
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        scanned = stored(rows.where(has_cue).mapInArrow(search, schema), "license-blocks")
    none = rows.where(~has_cue).select(
        "doc_id",
        F.lit(0).alias("block"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("start", "bigint"), ("license", "string"), ("saving", "double"), ("n_differences", "bigint"))],
        F.lit(False).alias("confirmed"),
    )
    return scanned.unionByName(none)
