"""License notices found by conditional compression.

Words around a trigger form a candidate block, across line breaks and comment marks. A block is compressed with each
template as zstandard raw dictionary; the bytes the template saves, as a share of its own size, rank the templates, however
long the block is. A winner is confirmed by the exact differences in wording: its words and the block's are
aligned, and it counts only when few of its words are missing and every number (a license version) and every word that
tells licenses apart agrees. What is left of the block on both sides is judged again, so neighbouring notices are all found.
Candidates stay small, so each batch of texts is scanned where it lies.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with "
        "the distribution.")
_BSD_NAMES = (" Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission.")


def _gnu(name: str, version: str) -> list[str]:
    title = f"GNU {name} Public License"
    return [f"This work is licensed under the {title}, version {version}.", f"Licensed under the {title}, version {version}.",
            f"This program is free software: you can redistribute it and/or modify it under the terms of the {title} as "
            f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later "
            "version."]


def _commons(short: str, long: str) -> list[str]:
    return [f"Licensed under CC {short} 4.0.", f"Licensed under a Creative Commons {long} 4.0 International License."]


# Usual notices of public licenses, {identifier: notices}; the SPDX form of each is added below.
NOTICES = {
    "AGPL-3.0": _gnu("Affero General", "3"),
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at"],
    "BSD-2-Clause": ["Use of this source code is governed by the BSD 2-Clause License.", _BSD],
    "BSD-3-Clause": ["Use of this source code is governed by the BSD 3-Clause License.", _BSD + _BSD_NAMES],
    "CC-BY-4.0": _commons("BY", "Attribution"),
    "CC-BY-NC-4.0": _commons("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-NC-ND-4.0": _commons("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _commons("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0": _commons("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-SA-4.0": _commons("BY-SA", "Attribution-ShareAlike"),
    "CC0-1.0": ["Released under CC0 1.0.", "Dedicated to the public domain under CC0 1.0 Universal."],
    "GPL-2.0": _gnu("General", "2"),
    "GPL-3.0": _gnu("General", "3"),
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.1": _gnu("Lesser General", "2.1"),
    "LGPL-3.0": _gnu("Lesser General", "3"),
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a "
            "copy of this software and associated documentation files.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "all-rights-reserved": ["All rights reserved."],
}
for _name in NOTICES:
    if _name != "all-rights-reserved":
        NOTICES[_name].append(f"SPDX-License-Identifier: {_name}")
TRIGGER = re.compile(
    r"licen[sc]|rights[\W_]+reserved|public[\W_]+domain|\bCC0\b|\bCC[\W_]+BY\b|\bMPL\b|\bunencumbered\b|SPDX"
    r"|(?P<long>permission[\W_]+is[\W_]+hereby|permission[\W_]+to[\W_]+use|redistribution[\W_]+and[\W_]+use)", re.IGNORECASE)
WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
#: Comment marks that are made of letters.
MARK = re.compile(r"(?m)^[ \t]*(?:dnl|rem)\b", re.IGNORECASE)
AROUND, LONGEST, LEAST_WORDS_KEPT, LEAST_SAVED = 28, 180, 0.75, 0.4
#: An unconfirmed block is compared with so many of the best-ranked templates.
BEST = 4
#: Words that tell licenses apart besides numbers: none of them may be too many, nor one of these or those be missing.
KINDS = set("affero lesser library nc nd sa noncommercial noderivatives noderivs sharealike".split())
NAMES = KINDS | set("agpl apache bsd by cc cc0 gpl isc lgpl mit mozilla mpl unlicense unencumbered rights reserved".split())
FOUND = ("doc_id long, at int, n_words int, license string, saved double, missing array<string>, extra array<string>, "
         "confirmed boolean")


class Templates:
    def __init__(self, notices: dict[str, list[str]], level: int = 3):
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False)
        self.known = []
        for name, texts in sorted(notices.items()):
            for text in texts:
                own = [w.lower() for w in WORD.findall(text)]
                raw = " ".join(own).encode()
                self.known.append((name, own, Counter(own), len(raw), zstandard.ZstdCompressor(
                    level=level, write_content_size=False,
                    dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT))))

    def ranked(self, words: list[str]) -> list[tuple[float, str, list[str], Counter]]:
        """(bytes saved as a share of its size, name, words, their counts) of every template, the best first, ties by name."""
        raw = " ".join(words).encode()
        alone = len(self.plain.compress(raw))
        return sorted((((alone - len(c.compress(raw))) / size, name, own, counts) for name, own, counts, size, c in self.known),
                      key=lambda x: (-x[0], x[1], x[2]))

    def judge(self, words: list[str]) -> tuple[str | None, float, list[str], list[str], int, int, bool]:
        """Name, saving, missing and extra words, the matched span of words, and whether it is confirmed.

        All templates that the block has enough words of are aligned, and the best-ranked ones whatever it has. Of those
        confirmed, the one with the most words wins, where each difference counts against it.
        """
        best, here = None, Counter(words)
        for place, (saved, name, own, counts) in enumerate(self.ranked(words)):
            enough = (counts & here).total() >= LEAST_WORDS_KEPT * len(own)
            if not enough and (place >= BEST or saved < LEAST_SAVED):
                continue
            found = aligned(own, words)
            if not found:
                continue
            missing, extra, start, end = found
            few = max(1, len(own) // 4)
            numbers = any(re.search(r"\d", w) for w in own) or len(own) < 20  # long wordings may have numbered clauses
            sure = (len(own) - len(missing) >= LEAST_WORDS_KEPT * len(own) and len(extra) <= few
                    and not NAMES & set(missing) and not KINDS & set(extra)
                    and not any(re.search(r"\d", w) for w in [*missing, *(extra if numbers else [])]))
            if not sure and saved < LEAST_SAVED:
                continue
            apart = len(missing) + len(extra)
            rank = (not sure, apart - (len(own) - len(missing)) * sure, -len(own), -saved)
            if best is None or rank < best[0]:
                best = (rank, (name, saved, missing, extra, start, end, sure))
        return best[1] if best else (None, 0.0, [], [], 0, len(words), False)

    def notices(self, words: list[str]) -> Iterator[tuple]:
        """What ``judge`` tells of a block, then of what is left on both sides of a confirmed notice."""
        todo = [(0, words)]
        while todo:
            at, part = todo.pop()
            name, saved, missing, extra, start, end, sure = self.judge(part)
            if sure or len(part) == len(words) or TRIGGER.search(" ".join(part)):
                yield name, saved, missing, extra, at + start, at + end, sure
            if sure:
                todo += [(at + a, part[a:b]) for a, b in ((end, len(part)), (0, start)) if b - a > 1]


def aligned(own: list[str], words: list[str]) -> tuple[list[str], list[str], int, int] | None:
    """Missing and extra words and the span, by the alignment around the longest common stretch."""
    anchor = difflib.SequenceMatcher(None, own, words, autojunk=False).find_longest_match()
    if not anchor.size:
        return None
    slack = max(1, len(own) // 4)
    low = max(0, anchor.b - anchor.a - slack)
    part = words[low:anchor.b + len(own) - anchor.a + slack]
    blocks = [b for b in difflib.SequenceMatcher(None, own, part, autojunk=False).get_matching_blocks() if b.size]
    # a stray word at an end that takes in more other words than it adds is no part of the notice
    while len(blocks) > 1 and blocks[1].b - blocks[0].b - blocks[0].size > blocks[0].size:
        del blocks[0]
    while len(blocks) > 1 and blocks[-1].b - blocks[-2].b - blocks[-2].size > blocks[-1].size:
        del blocks[-1]
    hit = {i for b in blocks for i in range(b.a, b.a + b.size)}
    used = {i for b in blocks for i in range(b.b, b.b + b.size)}
    start, end = blocks[0].b, blocks[-1].b + blocks[-1].size
    return ([w for i, w in enumerate(own) if i not in hit], [part[i] for i in range(start, end) if i not in used],
            low + start, low + end)


def blocks_of(text: str) -> Iterator[tuple[list[int], list[str]]]:
    """(numbers of the words, lower-cased words) of the stretches around triggers, whole text, none twice."""
    marks = {m.end() for m in MARK.finditer(text)}
    bare = MARK.sub(lambda m: " " * len(m[0]), text) if marks else text
    hits = [(m.start(), LONGEST if m["long"] else AROUND) for m in TRIGGER.finditer(bare)]
    if not hits:
        return
    places = [(m.start(), m.end(), m[0].lower(), i) for i, m in enumerate(WORD.finditer(text)) if m.end() not in marks]
    if not places:
        return
    spans, k = [], 0
    for hit, ahead in hits:
        while k + 1 < len(places) and places[k][1] <= hit:
            k += 1
        low, high = max(0, k - AROUND), min(len(places) - 1, k + ahead)
        if spans and low <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
        else:
            spans.append((low, high))
    for low, high in spans:
        yield [i for *_, i in places[low:high + 1]], [w for _, _, w, _ in places[low:high + 1]]


def scan(docs: DataFrame, notices: dict[str, list[str]] = NOTICES) -> DataFrame:
    """One row per notice in the candidate blocks of ``docs`` (doc_id, text; others are not read): where it matched (word
    number, number of words), the best license, what it saves, the exact differences in wording, and whether it is confirmed.

    Blocks that no template helps to compress have a null license. Null and empty texts and texts without a trigger
    give no row; repeated rows give repeated rows.
    """
    def run(frames):
        templates, judged = Templates(notices), {}
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame.column("doc_id").to_pylist(), frame.column("text").to_pylist(), strict=True):
                for at, words in blocks_of(text or ""):
                    key = tuple(words)
                    if key not in judged:
                        if len(judged) > 10_000:
                            judged.clear()
                        judged[key] = list(templates.notices(words))
                    for name, saved, missing, extra, start, end, sure in judged[key]:
                        rows.append((doc_id, at[start], at[end - 1] - at[start] + 1, name, saved, missing, extra, sure))
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            texts = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
                pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), texts, texts, pa.bool_()), strict=True)],
                ["doc_id", "at", "n_words", "license", "saved", "missing", "extra", "confirmed"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, FOUND)
