"""License scans: sentences, lines, paragraphs and whole texts against licence templates, by Dice coefficient over word bigrams.

Texts are normalised to lower-cased runs of letters and digits. The likeness of two sets A and B of word bigrams is
2 |A & B| / (|A| + |B|); it can reach a threshold t only if t / (2 - t) <= |A| / |B| <= (2 - t) / t. So a part's number
of distinct bigrams leaves few candidate templates, and of those only the ones that share a bigram are counted.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: So that rounding doesn't shut out a size that reaches the threshold exactly.
_SLACK = 1 + 1e-9

# Wordings of licences, their notices and the terms that are commonly quoted.
TEMPLATES: list[tuple[str, str, str]] = [
    ("MIT", "released", "Released under the MIT License."),
    ("MIT", "licensed", "Licensed under the MIT License."),
    ("MIT", "project", "This project is licensed under the terms of the MIT License."),
    ("MIT", "grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "warranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "warranty", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("ISC", "licensed", "Licensed under the ISC License."),
    ("Apache-2.0", "licensed", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "warranty", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD", "redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD", "binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD", "warranty", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "licensed", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "licensed", "Licensed under the BSD 2-Clause License."),
    ("GPL-3.0", "work", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "work", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "header", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL", "warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("LGPL-3.0", "work", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "work", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Zlib", "grant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("Unlicense", "domain", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "licensed", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "work", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "licensed", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "work", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "licensed", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "work", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "waiver", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Proprietary", "reserved", "Copyright. All rights reserved."),
]

#: Whole licences by their clauses, in order.
WHOLE = {
    "MIT": [("MIT", "grant"), ("MIT", "notice"), ("MIT", "warranty")],
    "ISC": [("ISC", "grant"), ("ISC", "warranty")],
    "BSD-2-Clause": [("BSD", "redistribution"), ("BSD", "source"), ("BSD", "binary"), ("BSD", "warranty")],
    "BSD-3-Clause": [("BSD", "redistribution"), ("BSD", "source"), ("BSD", "binary"), ("BSD-3-Clause", "endorse"), ("BSD", "warranty")],
}
TEMPLATES += [(licence, "text", " ".join(text for key in clauses for *of, text in TEMPLATES if tuple(of) == key)) for licence, clauses in WHOLE.items()]

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[.!?]+[ \t]+")
_BLANK = re.compile(r"\n(?:[ \t\r\f\v]*\n)+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Scanner:
    """The templates' bigrams, by size and by bigram."""

    def __init__(self, templates: list[tuple[str, str, str]], threshold: float):
        self.threshold = threshold
        self.names = [(licence, name) for licence, name, _ in templates]
        grams = [set(pairwise(words(text))) for _, _, text in templates]
        self.sizes = [len(g) for g in grams]
        self.holds: dict[tuple[str, str], list[int]] = {}
        for i, g in enumerate(grams):
            for gram in g:
                self.holds.setdefault(gram, []).append(i)
        self.known = frozenset(self.holds)
        ratio = (2 - threshold) / threshold * _SLACK
        self.bounds = [(n / ratio, n * ratio) for n in self.sizes]
        self.least, self.most = min(b for b, _ in self.bounds), max(b for _, b in self.bounds)

    def part(self, seq: list[str]) -> list[tuple[float, int]]:
        """(Dice coefficient, template) of the templates that reach the threshold against one part's words."""
        if len(seq) - 1 < self.least:
            return []
        grams = set(pairwise(seq))
        size = len(grams)
        if not self.least <= size <= self.most or not (shared := grams & self.known):
            return []
        hits = Counter(i for g in shared for i in self.holds[g] if self.bounds[i][0] <= size <= self.bounds[i][1])
        scores = ((2 * n / (size + self.sizes[i]), i) for i, n in hits.items())
        return [(score, i) for score, i in scores if score >= self.threshold]

    def text(self, text: str) -> list[tuple[str, str, float, int]]:
        """(licence, best template, its score, number of parts that match) for each licence that a text names."""
        best: dict[str, tuple[float, str]] = {}
        count: Counter[str] = Counter()
        for seq in parts(text):
            found = self.part(seq)
            count.update({self.names[i][0] for _, i in found})
            for score, i in found:
                licence, name = self.names[i]
                old = best.get(licence, (0.0, ""))
                if score > old[0] or score == old[0] and name < old[1]:
                    best[licence] = (score, name)
        return [(licence, name, score, count[licence]) for licence, (score, name) in sorted(best.items())]


def parts(text: str):
    """The words of each line, of each sentence of a line that has several, of each paragraph that has more than one line,
    and of a text of more than one paragraph."""
    paragraphs = _BLANK.split(text)
    whole: list[str] = []
    for paragraph in paragraphs:
        lines = [words(line) for line in paragraph.split("\n")]
        yield from lines
        for line in paragraph.split("\n"):
            if len(sentences := [seq for seq in map(words, _SENTENCE.split(line)) if seq]) > 1:
                yield from sentences
        together = [w for line in lines for w in line]
        if len(lines) > 1:
            yield together
        whole += together
    if len(paragraphs) > 1:
        yield whole


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: list[tuple[str, str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, template, score, n_parts) for each row of ``docs`` and each licence that a part of it matches.

    ``template`` is the most alike wording, the first by name of equals; ``n_parts`` counts the sentences, lines, paragraphs and
    whole text that reach ``threshold``. Null and empty texts and parts of fewer than two words match nothing; repeated
    rows come out repeated; other columns are ignored; an empty table gives no rows. Whole texts are read, one at a time.
    """
    scanner = Scanner(templates or TEMPLATES, threshold)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")

    def run(batches):
        for batch in batches:
            at, out = [], []
            for i, body in enumerate(batch.column("text").to_pylist()):
                for found in scanner.text(body):
                    at.append(i)
                    out.append(found)
            cols = list(zip(*out)) or [()] * 4
            types = (pa.string(), pa.string(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, types))], ["id", "license", "template", "score", "n_parts"])

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, license string, template string, score double, n_parts long").withColumnRenamed("id", doc_id)


def sql() -> str:
    """DuckDB SQL for ``scan`` over the table documents with the default parameters."""
    quoted = ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in row) + ")" for row in TEMPLATES)
    words_of = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    grams = "list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))"
    ratio = (2 - THRESHOLD) / THRESHOLD * _SLACK
    return f"""
WITH templates AS (SELECT license, template, {grams} AS tg FROM (SELECT license, template, {words_of.format('wording')} AS ws FROM (VALUES {quoted}) t(license, template, wording))),
paragraphs AS (SELECT doc_id, ps, unnest(ps) AS p, generate_subscripts(ps, 1) AS k FROM (SELECT doc_id, regexp_split_to_array(text, '\\n(?:[ \\t\\r\\f\\x0b]*\\n)+') AS ps FROM documents WHERE text IS NOT NULL)),
lines AS (SELECT doc_id, 'l' || k || '-' || generate_subscripts(ls, 1) AS part, unnest(ls) AS body FROM (SELECT doc_id, k, string_split(p, chr(10)) AS ls FROM paragraphs)),
sentences AS (SELECT doc_id, part, list_filter(regexp_split_to_array(body, '[.!?]+[ \\t]+'), lambda s: regexp_matches(s, '[\\p{{L}}\\p{{N}}]')) AS ss FROM lines),
parts AS (
  SELECT * FROM lines
  UNION ALL SELECT doc_id, part || '-' || generate_subscripts(ss, 1), unnest(ss) FROM sentences WHERE len(ss) > 1
  UNION ALL SELECT doc_id, 'p' || k, p FROM paragraphs WHERE contains(p, chr(10))
  UNION ALL SELECT doc_id, 'w', text FROM documents WHERE regexp_matches(text, '\\n(?:[ \\t\\r\\f\\x0b]*\\n)+')),
grams AS (SELECT doc_id, part, g FROM (SELECT doc_id, part, {grams} AS g FROM (SELECT doc_id, part, {words_of.format('body')} AS ws FROM parts)) WHERE len(g) > 0),
scored AS (
  SELECT doc_id, part, license, template, 2.0 * len(list_intersect(g, tg)) / (len(g) + len(tg)) AS score
  FROM grams JOIN templates ON len(g) BETWEEN len(tg) / {ratio} AND len(tg) * {ratio}),
kept AS (SELECT * FROM scored WHERE score >= {THRESHOLD}),
best AS (SELECT doc_id, license, template, score FROM kept QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY score DESC, template) = 1)
SELECT doc_id, license, template, score, n_parts FROM best JOIN (SELECT doc_id, license, CAST(count(DISTINCT part) AS BIGINT) AS n_parts FROM kept GROUP BY doc_id, license) USING (doc_id, license)
"""
