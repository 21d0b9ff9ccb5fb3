"""License scan: Dice coefficient over word bigrams between text and licence templates.

Windows of words anywhere in the text are compared, besides lines, paragraphs (lines up to a
blank one) and the whole text. A window begins and ends with a bigram of its template and has no
more bigrams than the size bounds allow; of places that overlap the best one counts. Both sides are
reduced to their words, A-Z lower-cased; a segment matches the template with the highest
coefficient of LEAST_DICE or more, of equal ones the first listed. Sets of a and b bigrams
cannot reach a coefficient t unless t / (2 - t) <= b / a <= (2 - t) / t, so templates are kept
by size and only those within the bounds are compared; a segment outside the bounds of all
templates is not looked at, however long the text is.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import prepare, table
from jobloom.llm.decontaminate import words_of

LEAST_DICE = 0.8

# Notices and licence texts by SPDX id, without names and years.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the
terms of the GNU General Public License as published by the Free Software Foundation, either
version 3 of the License, or (at your option) any later version. This program is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details."""),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met: 1. Redistributions of
source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution."""),
]


@dataclass
class Match:
    licence: str
    dice: float
    order: int
    begin: int = 0
    end: int = 0


class Templates:
    """Licence templates by the size of their bigram sets."""

    def __init__(self, templates=TEMPLATES, least: float = LEAST_DICE):
        self.least = least
        rows = []
        for order, (licence, text) in enumerate(templates):
            words = words_of(text)
            rows.append((len(set(zip(words, words[1:]))), order, licence, set(zip(words, words[1:]))))
        self.rows = sorted(rows, key=lambda r: r[:2])
        self.sizes = [r[0] for r in self.rows]
        self.all = set().union(*(r[3] for r in rows))
        # Places of the template bigrams in ``held``: templates x bigrams.
        self.place = {b: i for i, b in enumerate(sorted(self.all))}
        self.held = np.array([[b in r[3] for b in self.place] for r in self.rows], bool)
        self.longest = max(self.sizes, default=0) * (2 - least) / least

    def best(self, words: list[str]) -> Match | None:
        """The best template for the words of one segment."""
        bigrams = set(zip(words, words[1:]))
        size = len(bigrams)
        if not size or bigrams.isdisjoint(self.all):
            return None
        ratio = self.least / (2 - self.least)
        low = bisect_left(self.sizes, size * ratio * (1 - 1e-12))
        high = bisect_right(self.sizes, size / ratio * (1 + 1e-12))
        found = None
        for n, order, licence, template in self.rows[low:high]:
            dice = 2 * len(bigrams & template) / (size + n)
            if dice >= self.least and (
                found is None or (-dice, order) < (-found.dice, found.order)
            ):
                found = Match(licence, dice, order)
        return found

    def windows(self, words: list[str]) -> list[Match]:
        """For each template and each of its bigrams in the text that may begin a window: the
        best one."""
        bigrams = list(zip(words, words[1:]))
        places = np.array([self.place.get(b, -1) for b in bigrams], np.int64)
        at = np.flatnonzero(places >= 0)
        found = []
        if not len(at):
            return found
        ratio = self.least / (2 - self.least)
        for (n, order, licence, template), held in zip(self.rows, self.held, strict=True):
            if not n:
                continue
            own = at[held[places[at]]]
            need, most = math.ceil(n * ratio * (1 - 1e-12)), int(n / ratio * (1 + 1e-12))
            if len(own) < need:
                continue
            near = own[need - 1 :] - own[: len(own) - need + 1] < most
            for begin in own[: len(near)][near].tolist():
                seen, common, best = set(), 0, None
                for p, bigram in enumerate(bigrams[begin : begin + most], begin):
                    if bigram in seen:
                        continue
                    seen.add(bigram)
                    if bigram in template:
                        common += 1
                        dice = 2 * common / (len(seen) + n)
                        if dice >= self.least and (best is None or dice > best.dice):
                            best = Match(licence, dice, order, begin, p + 2)
                if best:
                    found.append(best)
        return found

    def scan(self, text: str | None) -> list[Match]:
        """Matches that do not overlap, the best first: of windows, lines, paragraphs and the
        whole text."""
        lines = [words_of(line) for line in (text or "").split("\n")]
        words = [w for line in lines for w in line]
        if self.all.isdisjoint(zip(words, words[1:])):
            return []
        ends = list(accumulate(map(len, lines)))
        segments = {(end - len(line), end) for line, end in zip(lines, ends, strict=True)}
        blank = [0, *(end for line, end in zip(lines, ends, strict=True) if not line), len(words)]
        segments.update(zip(blank, blank[1:]))
        segments.add((0, len(words)))
        found = self.windows(words)
        # A set of few bigrams may come from many words, so only its words' number of kinds
        # bounds it from below: long segments of few kinds are looked at as well.
        for begin, end in segments:
            part = words[begin:end]
            if len(part) - 1 <= self.longest or len(set(part)) <= self.longest + 1:
                match = self.best(part)
                if match:
                    found.append(Match(match.licence, match.dice, match.order, begin, end))
        kept, taken = [], bytearray(len(words))
        for m in sorted(found, key=lambda m: (-m.dice, m.order, m.end - m.begin, m.begin)):
            if not any(taken[m.begin : m.end]):
                taken[m.begin : m.end] = b"\x01" * (m.end - m.begin)
                kept.append(m)
        return kept


def scan_documents(docs: DataFrame, templates=TEMPLATES, least: float = LEAST_DICE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_segments, licences, licence, dice.

    n_segments counts matching places that do not overlap, licences lists their ids in order, once each;
    licence and dice are those of the best one (null without a match). ``docs`` needs doc_id
    and text; other columns are not read. Null, empty and one-word texts match nothing.
    Repeated rows give repeated rows; an empty table gives none.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(Templates(templates, least))

    @F.arrow_udf(
        T.StructType(
            [
                T.StructField("n_segments", T.LongType()),
                T.StructField("licences", T.StringType()),
                T.StructField("licence", T.StringType()),
                T.StructField("dice", T.DoubleType()),
            ]
        )
    )
    def found(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            matches = shared.value.scan(text)
            best = min(matches, key=lambda m: (-m.dice, m.order), default=None)
            rows.append(
                {
                    "n_segments": len(matches),
                    "licences": ",".join(sorted({m.licence for m in matches})),
                    "licence": best.licence if best else None,
                    "dice": best.dice if best else None,
                }
            )
        kind = pa.struct(
            [
                ("n_segments", pa.int64()), ("licences", pa.string()),
                ("licence", pa.string()), ("dice", pa.float64()),
            ]
        )
        return pa.array(rows, kind)

    return docs.select("doc_id", found("text").alias("found")).select("doc_id", "found.*")


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents"))
