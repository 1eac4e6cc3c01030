"""Licence scans with DataFrame functions only.

A unit is a line of a text, a paragraph of several lines (what blank lines divide), or the whole text.  It is normalised (A-Z lower-cased, all but a-z and 0-9
turned into single blanks) and compared with licence templates by the Dice coefficient of their sets of
word bigrams, 2 |A and B| / (|A| + |B|).  A template of m bigrams can only reach the threshold t against
a unit of between m t / (2 - t) and m (2 - t) / t bigrams, so a unit meets just the templates whose bounds
hold its size, found by an equality join on that size with a small broadcast table.

To reach t a unit has to hold at least m t / (2 - t) of the template's bigrams, so of any few more than the
rest at least one.  Such few bigrams are a short template's *keys*: units without both words of any key are
passed over before they are normalised.  A longer template has as many bigrams around a few of its words as are
more than the rest, so a unit without any of these words is passed over.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, read_table

THRESHOLD = 0.8

#: Notices by which works name their licence.
NOTICES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "All-Rights-Reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-Notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-Grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: Paragraphs of licences and of the headers they ask for, as they stand in files.
PARAGRAPHS = {
    "Apache-2.0-Header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "Apache-2.0-Terms": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-Disclaimer": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "GPL-2.0-Header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-Header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-Disclaimer": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC-Permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT-Disclaimer": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "MIT-Notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-Permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "MPL-2.0-Header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense-Grant": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib-Disclaimer": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
}
#: Identifiers that stand in tags of source files.
TAGGED = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
TAGS = {f"Tag-{name}": f"SPDX-License-Identifier: {name}" for name in TAGGED}
TEMPLATES = NOTICES | PARAGRAPHS | TAGS
FEW = 4  # keys of a template that are looked for as pairs of words
BLANK = r"\n(?:[^A-Za-z0-9\n]*\n)+"  # one or more lines without an ASCII letter or digit: empty, or comment marks alone


def template_bigrams(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(m: int, threshold: float) -> range:
    """Sizes of a set that can reach ``threshold`` against one of ``m``."""
    least = next(n for n in range(1, m + 1) if 2 * n / (n + m) >= threshold)
    most = math.floor(m * (2 - threshold) / threshold + 1e-9)
    return range(least, most + 1)


LETTERS = "etaoinshrdlcumwfgypbvkjxqz"  # from common to rare


def key_pairs(templates: dict[str, str], threshold: float) -> list[tuple[str, ...]]:
    """Keys, each a word or two, of which every unit that matches some template holds one with all its words:
    bigrams of short templates, as many as it takes, the rarest by their letters first; of longer ones,
    words that stand in so many bigrams, long words first."""
    rare = lambda b: sum(LETTERS.find(c) + 1 for c in b)
    out: set[tuple[str, ...]] = set()
    for own in map(template_bigrams, templates.values()):
        if not own:
            continue
        needed = len(own) - size_bounds(len(own), threshold)[0] + 1
        if needed <= FEW:
            out.update(tuple(sorted(b.split(), key=lambda w: (-len(w), w))) for b in sorted(own, key=lambda b: (-rare(b), b))[:needed])
            continue
        left = [tuple(b.split()) for b in own]
        while len(own) - len(left) < needed:
            gain = {w: sum(w in b for b in left) * max(0.1, len(w) - 3) for b in left for w in b}
            best = max(sorted(gain), key=gain.get)
            out.add((best,))
            left = [b for b in left if best not in b]
    return sorted(out)


def holds_key(text: Column, keys: list[tuple[str, ...]]) -> Column:
    """Whether a text may hold a key, as it has its words; ``lower`` also maps a few other letters to ASCII,
    which only lets more through."""
    has = lambda t: reduce(or_, [reduce(and_, [F.contains(t, F.lit(w)) for w in k]) for k in keys], F.lit(False))
    return F.exists(F.array(F.lower(text)), has)


def candidates(spark: SparkSession, templates: dict[str, str], threshold: float) -> DataFrame:
    """For each size the templates that a unit of that size may match: a row a size, so its size is
    bounded by the longest template."""
    by_size: dict[int, list[tuple[str, list[str]]]] = {}
    for name, text in sorted(templates.items()):
        own = template_bigrams(text)
        for n in size_bounds(len(own), threshold) if own else ():
            by_size.setdefault(n, []).append((name, own))
    return spark.createDataFrame(sorted(by_size.items()), "size int, templates array<struct<name: string, bigrams: array<string>>>")


def bigrams(words: Column) -> Column:
    """The distinct word bigrams of a list of two words or more."""
    n = F.size(words) - 1
    return F.array_distinct(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b)))


def units_of(text: Column) -> Column:
    """(unit, line, text) of each line, of each paragraph of several lines, and of a whole text of several."""
    lines, parts = F.split(text, "\n", -1), F.split(text, BLANK, -1)
    as_ = lambda unit: lambda t, i: F.struct(F.lit(unit).alias("unit"), (i + 1).cast("long").alias("line"), t.alias("text"))
    none = F.array().cast("array<struct<unit: string, line: bigint, text: string>>")
    whole = F.when(F.size(lines) > 1, F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).cast("long").alias("line"), text.alias("text")))).otherwise(none)
    paragraphs = F.when(F.size(parts) > 1, F.filter(F.transform(parts, as_("paragraph")), lambda u: F.contains(u["text"], F.lit("\n")))).otherwise(none)
    return F.concat(F.transform(lines, as_("line")), paragraphs, whole)


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each unit that matches: its id, unit (line, paragraph or text), line (the number of the line
    or paragraph from 1; 0 for the whole text), licence (the best template, ties by name) and dice.

    Null and empty texts and units of fewer than two words match nothing; repeated rows repeat their rows; a
    null id is kept; other columns are left out, whatever their names; an empty table gives an empty one; texts
    of any length are taken whole.  Paragraphs are divided by lines without letters and digits, so also by lines of
    comment marks alone.  A notice inside a longer line or paragraph is not found by itself.
    """
    table = candidates(docs.sparkSession, templates or TEMPLATES, threshold)
    least = min((size_bounds(len(b), threshold)[0] for b in map(template_bigrams, (templates or TEMPLATES).values()) if b), default=1)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keys = key_pairs(templates or TEMPLATES, threshold)
    rows = docs.filter(holds_key(text, keys)).select(F.col(f"`{id_col}`").alias("id"), F.explode(units_of(text)).alias("u")).select("id", "u.*")
    rows = rows.filter(holds_key(F.col("text"), keys))
    normal = F.trim(F.regexp_replace(ascii_lower(F.col("text")), "[^a-z0-9]+", " "))
    # a unit of n words has n - 1 bigrams at most
    worded = rows.select("id", "unit", "line", normal.alias("normal")).filter(F.length("normal") - F.length(F.translate("normal", " ", "")) >= least)
    split = worded.select("id", "unit", "line", F.split("normal", " ").alias("words"))
    sized = split.select("id", "unit", "line", bigrams(F.col("words")).alias("own")).withColumn("size", F.size("own"))
    met = sized.join(F.broadcast(table), "size")
    dice = lambda t: 2.0 * F.size(F.array_intersect(F.col("own"), t["bigrams"])) / (F.col("size") + F.size(t["bigrams"]))
    best = F.array_min(F.transform("templates", lambda t: F.struct((-dice(t)).alias("less"), t["name"].alias("name"))))
    found = met.select("id", "unit", "line", best.alias("best")).filter(F.col("best.less") <= -threshold)
    return found.select(F.col("id").alias(id_col), "unit", "line", F.col("best.name").alias("licence"), (-F.col("best.less")).alias("dice"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every whole text of ``documents``."""
    return scan_licences(read_table(spark, sf_dir, "documents"))


def _sql() -> str:
    known = ",\n".join(f"('{name}', {template_bigrams(text)})" for name, text in TEMPLATES.items())
    return f"""
WITH templates(name, b) AS (VALUES {known}),
texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l, string_split_regex(coalesce(text, ''), '{BLANK}') AS p, coalesce(text, '') AS t FROM documents),
units AS (SELECT doc_id, 'text' AS unit, 0 AS line, t AS u FROM texts WHERE len(l) > 1
          UNION ALL SELECT doc_id, 'line', unnest(range(1, len(l) + 1)), unnest(l) FROM texts
          UNION ALL SELECT * FROM (SELECT doc_id, 'paragraph', unnest(range(1, len(p) + 1)), unnest(p) AS u FROM texts WHERE len(p) > 1) WHERE contains(u, chr(10))),
words AS (SELECT doc_id, unit, line, string_split(trim(regexp_replace(translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM units),
pairs AS (SELECT doc_id, unit, line, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS own FROM words WHERE len(w) > 1),
scored AS (SELECT doc_id, unit, line, name, 2.0::DOUBLE * len(list_intersect(own, b)) / (len(own) + len(b)) AS dice FROM pairs, templates),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, unit, line ORDER BY dice DESC, name) AS r FROM scored WHERE dice >= {THRESHOLD})
SELECT doc_id, unit, line::BIGINT AS line, name AS licence, dice FROM ranked WHERE r = 1
"""


OP7_SQL = _sql()
