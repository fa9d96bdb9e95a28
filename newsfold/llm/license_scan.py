"""Licence notices in texts by the Dice coefficient of word bigrams.

A text's units are its lines, its paragraphs (runs of lines that are not blank) and itself, and then windows of words of
the size of each template, wherever they lie: those count that no matching unit of the same licence overlaps. Units and templates are
normalised to lower-case words of letters and digits. Two sets of m and n bigrams reach a coefficient of 2 * min / (m
+ n) at most, so a unit is held only against templates whose size is within these bounds, and a unit with too few words
for any template is not even split into bigrams. A window is tried only where a text has enough of a template's bigrams
close together. Templates whose coefficients are nearly equal are told apart by ``TELLING`` words.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from newsfold.llm.blocks import blocks

LEAST = 0.8
#: Coefficients that differ by less are settled by the words that tell licences apart.
NEAR = 0.2
TELLING = frozenset(
    "1 2 3 4 affero apache attribution bsd clause cc gnu lesser library mit mozilla nc nd neither noncommercial noderivatives sa sharealike".split()
)

#: Notices and texts as their licences word them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions:",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the "
        "name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-SA-4.0": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-ND-4.0": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "CC-BY-ND-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

_WORD = re.compile(r"[^\W_]+")
FOUND = "doc_id bigint, license string, dice double, n_notices bigint"


def word_list(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Scanner:
    """Templates by size, and the best of them for a unit."""

    def __init__(self, templates: dict[str, list[str]], least: float):
        self.least, self.low, self.high = least, least / (2 - least), (2 - least) / least
        sets = [
            (frozenset(zip(words, words[1:])), name, TELLING.intersection(words), len(words) - 1)
            for name, texts in templates.items()
            for words in map(word_list, texts)
        ]
        self.templates = sorted(sets, key=lambda one: (len(one[0]), one[1]))
        self.sizes = [len(grams) for grams, *_ in self.templates]
        self.holders = defaultdict(list)
        for number, (grams, *_) in enumerate(self.templates):
            for gram in grams:
                self.holders[gram].append(number)

    def settled(self, matches: list[tuple], words: list[str]) -> tuple:
        """Of matches ``(dice, name, template, ...)`` near the highest the one whose telling words are the unit's; then the first by name."""
        top, told = max(match[0] for match in matches), TELLING.intersection(words)
        near = [match for match in matches if match[0] > top - NEAR]
        return min(near, key=lambda match: (len(told ^ self.templates[match[2]][2]), -match[0], match[1], match[2]))

    def best(self, words: list[str]) -> tuple[float, str] | None:
        """The highest coefficient and its licence, near ties settled by telling words; of equal ones the first by name."""
        if len(words) - 1 < self.low * self.sizes[0] - 1e-9:
            return None
        grams = set(zip(words, words[1:]))
        first = bisect.bisect_left(self.sizes, len(grams) * self.low - 1e-9)
        last = bisect.bisect_right(self.sizes, len(grams) * self.high + 1e-9)
        found = []
        for number in range(first, last):
            template, name, *_ = self.templates[number]
            dice = 2 * len(grams & template) / (len(grams) + len(template))
            if dice >= self.least:
                found.append((dice, name, number))
        return self.settled(found, words)[:2] if found else None

    def windows(self, words: list[str]) -> list[tuple[float, str, int, int]]:
        """``(dice, licence, first word, end)`` of the best windows that don't overlap."""
        grams = list(zip(words, words[1:]))
        places = defaultdict(list)
        for at, gram in enumerate(grams):
            if gram in self.holders:
                for number in self.holders[gram]:
                    places[number].append(at)
        found = []
        for number, at in places.items():
            template, name, _, length = self.templates[number]
            need, span = math.ceil(self.low * len(template) - 1e-9), int(self.high * length + 1e-9)
            own = []
            for i in range(len(at) - need + 1):
                if at[i + need - 1] - at[i] >= span:
                    continue
                seen, hits, top = set(), 0, None
                # A best window starts and ends with a bigram of the template.
                for place in range(at[i], min(at[i] + span, at[-1] + 1)):
                    gram = grams[place]
                    if gram in seen:
                        continue
                    seen.add(gram)
                    if gram in template:
                        hits += 1
                        dice = 2 * hits / (len(seen) + len(template))
                        if dice >= self.least and (top is None or dice > top[0]):
                            top = dice, name, number, at[i], place + 2
                if top:
                    own.append(top)
            # Of one template's overlapping windows the best one stays.
            taken = []
            for one in sorted(own, key=lambda one: (-one[0], one[3])):
                after = bisect.bisect_left(taken, one[3:5])
                if (not after or taken[after - 1][1] <= one[3]) and (after == len(taken) or taken[after][0] >= one[4]):
                    taken.insert(after, one[3:5])
                    found.append(one)
        out = []
        found.sort(key=lambda one: one[3])
        while found:
            end, count = found[0][4], 1
            while count < len(found) and found[count][3] < end:
                end, count = max(end, found[count][4]), count + 1
            group, found = found[:count], found[count:]
            while group:
                top = min(group, key=lambda one: (-one[0], one[1], one[3]))
                rivals = {}
                for one in group:
                    if one[3] < top[4] and one[4] > top[3] and (one[2] not in rivals or one[0] > rivals[one[2]][0]):
                        rivals[one[2]] = one
                start, stop = (pick(edge) for pick, edge in ((min, (one[3] for one in rivals.values())), (max, (one[4] for one in rivals.values()))))
                dice, name, _, first, last = self.settled(list(rivals.values()), words[start:stop])
                out.append((dice, name, first, last))
                group = [one for one in group if all(one[3] >= b or one[4] <= a for a, b in ((first, last), (top[3], top[4])))]
        return out

    def notices(self, text: str) -> list[tuple[float, str]]:
        """The matches of all units, and of windows that no matching unit of the same licence, or with as high a coefficient, overlaps."""
        out, covered = [], []
        words = word_list(text)
        for unit, start in placed_units(text):
            if match := self.best(unit):
                out.append(match)
                covered.append((*match, start, start + len(unit)))
        for dice, name, first, end in self.windows(words):
            if not any(first < b and a < end and (name == other or dice <= known) for known, other, a, b in covered):
                out.append((dice, name))
        return out


def placed_units(text: str) -> Iterator[tuple[list[str], int]]:
    """The words of lines, of paragraphs with several lines, and of the text if it has several paragraphs, with the number of the first word."""
    lines = [word_list(line) if line.strip() else None for line in text.split("\n")]
    paragraphs, at = [], 0
    for blank, group in itertools.groupby(lines, key=lambda line: line is None):
        if not blank:
            paragraph, begin = list(group), at
            for line in paragraph:
                yield line, at
                at += len(line)
            paragraphs.append(list(itertools.chain.from_iterable(paragraph)))
            if len(paragraph) > 1:
                yield paragraphs[-1], begin
    if len(paragraphs) > 1:
        yield list(itertools.chain.from_iterable(paragraphs)), 0


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``doc_id, license, dice, n_notices`` of every row: the best match of its units and windows and how many of them match at all.

    Without a match, and for null and empty texts, licence and coefficient are null and the number 0. Of equal
    coefficients the first licence by name counts. Repeated rows are scanned each; other columns are ignored. One
    narrow stage.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        for rows, _, _ in blocks(batches, "text"):
            out = []
            for doc, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                found, notices = None, 0
                for match in scanner.notices(text or ""):
                    notices += 1
                    if found is None or (-match[0], match[1]) < (-found[0], found[1]):
                        found = match
                out.append((doc, found and found[1], found and found[0], notices))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.string(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "license", "dice", "n_notices"])

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(search, FOUND)
