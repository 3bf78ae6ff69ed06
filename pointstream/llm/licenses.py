"""License notices by conditional compression.

Candidate blocks are the words around cue words, as many on both sides as the longest notice has, however
they are wrapped.  A notice that lacks its only cue word has no candidate.  Each block is compressed with zstandard, once plainly and once with each template as raw dictionary; templates are ranked by how much
smaller that makes the block.  All are confirmed by wording, whatever they save: the template's words are
aligned with the block's, and what is missing, added or changed in between decides."""

from __future__ import annotations

import difflib
import re
from collections import deque

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import Generations, batch, parts, relaxing, texts

#: Notices in their own wording, by SPDX-like name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "Apache-2.0-short": "Licensed under the Apache License 2.0",
    "MIT": "Released under the MIT License",
    "MIT-licensed": "Licensed under the MIT License",
    "MIT-text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL": "licensed under the GNU Lesser General Public License",
    "AGPL-3.0": "licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "all-rights-reserved": "All rights reserved",
}
#: Words near which notices are looked for, in any case and with anything that is no word between them.
CUES = re.compile(r"licen[sc]|copyright|all[\W_]+rights[\W_]+reserved|redistribut|permission[\W_]+(?:is|to)|free[\W_]+software|creative[\W_]+commons|\bcc[\W_]+(?:by|0)|public[\W_]+domain|waived[\W_]+all", re.IGNORECASE)
WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
#: Characters compressed at once; longer candidates are compressed in pieces that overlap by half.
BLOCK = 4096
#: A notice may lack, add or change one word in ten, rounded down: templates of under ten words match word by word only,
#: as one other word would make 'Released under the BSD License' a notice of MIT.  Their common variants are templates.
DIFFERENT = 0.1
#: Words that a notice, or a cue and a notice, can span.
REACH = max(int((1 + DIFFERENT) * len(WORD.findall(t))) for t in TEMPLATES.values()) + 3


class Scanner:
    """Finds notices in texts; results for equal blocks are kept."""

    def __init__(self, templates: dict[str, str] = TEMPLATES, different: float = DIFFERENT):
        self.different = different
        self.words = {k: [w.lower() for w in WORD.findall(t)] for k, t in templates.items()}
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.given = {}
        for k, t in templates.items():
            raw = zstandard.ZstdCompressionDict(_normal(t).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=3)
            self.given[k] = zstandard.ZstdCompressor(dict_data=raw, write_content_size=False, write_dict_id=False)
        self.kept = Generations(50_000)

    def ranked(self, block: str) -> list[tuple[int, str]]:
        """(bytes saved, template), the most first."""
        raw = _normal(block).encode()
        size = len(self.plain.compress(raw))
        return sorted(((size - len(c.compress(raw)), k) for k, c in self.given.items()), key=lambda r: (-r[0], r[1]))

    def notices(self, block: str) -> list[tuple[int, int, str, int, int, int]]:
        """(start, end, license, bytes saved, words missing or changed, words added) of confirmed notices."""
        short = len(block) <= BLOCK
        if short:
            try:
                return self.kept[block]
            except KeyError:
                pass
        spans = [m.span() for m in WORD.finditer(block)]
        words = [block[a:b].lower() for a, b in spans]
        found, step = [], BLOCK // 2
        pieces = [{k: saved for saved, k in self.ranked(block[x : x + BLOCK])} for x in range(0, max(1, len(block) - step), step)]
        for name in pieces[0]:  # the saving ranks only: coding noise can outweigh a short notice
            for first, last, missing, added in self.confirmed(self.words[name], words):
                start = spans[first][0]
                found.append((start, spans[last][1], name, pieces[min(start // step, len(pieces) - 1)][name], missing, added))
        # longer notices hide what lies inside them; of equally long ones the wording decides, then what they save
        found.sort(key=lambda r: (r[0] - r[1], r[4] + r[5], -r[3], r[2]))
        out: list[tuple[int, int, str, int, int, int]] = []
        for r in found:
            if all(r[1] <= o[0] or r[0] >= o[1] for o in out):
                out.append(r)
        out.sort()
        if short:
            self.kept[block] = out
        return out

    def confirmed(self, template: list[str], words: list[str]) -> list[tuple[int, int, int, int]]:
        """(first, last word, missing, added) of each place where the template stands, but for few words."""
        n, found, at = len(template), [], 0
        allowed = int(self.different * n)
        while at < len(words):
            if words[at : at + n] == template:
                found.append((at, at + n - 1, 0, 0))
                at += n
            elif allowed and words[at] in template[: allowed + 1] and (hit := self.aligned(template, words[at : at + n + allowed], allowed)):
                found.append((at, at + hit[0], *hit[1:]))
                at += hit[0] + 1
            else:
                at += 1
        return found

    def aligned(self, template: list[str], words: list[str], allowed: int):
        match = difflib.SequenceMatcher(None, template, words, autojunk=False)
        pairs = [(a + k, b + k) for a, b, n in match.get_matching_blocks() for k in range(n)]
        if not pairs or pairs[0][1]:
            return None
        last = pairs[-1][1]
        missing, added = len(template) - len(pairs), last + 1 - len(pairs)
        return (last, missing, added) if max(missing, added) <= allowed else None


def _normal(text: str) -> str:
    return " ".join(text.lower().split())


def candidates(text: str) -> list[tuple[int, str]]:
    """(start, block): the words up to ``REACH`` before and after cues; what overlaps is one block."""
    cues = (m.start() for m in CUES.finditer(text))
    cue = next(cues, None)
    if cue is None:
        return []
    found: list[list[int]] = []
    before, left = deque(maxlen=REACH), 0
    for m in WORD.finditer(text):
        start, end = m.span()
        while cue is not None and cue < end:
            if not left and not (found and before and before[0] < found[-1][1]):
                found.append([before[0] if before else start, end])
            left, cue = REACH + 1, next(cues, None)
        before.append(start)
        if left:
            found[-1][1] = end
            left -= 1
        elif cue is None:
            break
    return [(a, text[a:b]) for a, b in found]


OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("bytes_saved", pa.int64()), ("words_missing", pa.int64()), ("words_added", pa.int64()), ("exact", pa.bool_())])
_scanner: list[Scanner] = []


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, license, bytes_saved, words_missing, words_added, exact): a row for each confirmed
    notice; start and end count code points.  Documents without one, null texts among them, have no rows.
    Repeated rows have the rows of each, a row without an id keeps its null, and an empty table gives none."""

    def run(batches):
        if not _scanner:
            _scanner.append(Scanner())
        model = _scanner[0]
        for ids, some in parts(batches):
            model.kept.turn()
            rows = []
            for doc, text in zip(ids, some):
                seen = set()
                for at, block in candidates(text):
                    for a, b, name, saved, missing, added in model.notices(block):
                        if (at + a, name) not in seen:
                            seen.add((at + a, name))
                            rows.append((doc, at + a, at + b, name, saved, missing, added, not missing + added))
            if rows:
                yield batch(OUT, **dict(zip(OUT.names, zip(*rows))))

    return texts(docs).mapInArrow(relaxing(run), "doc_id long, start long, end long, license string, bytes_saved long, words_missing long, words_added long, exact boolean")
