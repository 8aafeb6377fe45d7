"""License scan with a positional rare-token index.

Each licence template is a text - a notice of a line, or a whole licence - with
mandatory key phrases.  Of the
words of its key phrases, the ``rare`` ones with the highest inverse document
frequency in the scanned corpus are its index postings (word, position).  A
file's words are looked up in this index; the positions found for the rare
words of one template, each shifted by the word's place in the template, are
intersected, which leaves the places where the rare words stand at their
relative positions.  A place counts when all mandatory phrases stand there
word for word; how much of the whole template does is its score.

As the rare words are words of mandatory phrases, no verified place can lack
them: the index only spares work.  Everything is column expressions.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from scorewright.llm.common import LOWER, UPPER, lower_ascii

# what separates words, after A-Z have become a-z
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_LOWER = str.maketrans(UPPER, LOWER)


@dataclass(frozen=True)
class Template:
    """A licence text as lower-case words, and the phrases it must show."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def mandatory(self) -> list[tuple[int, str]]:
        """(place, word) of the key phrases' words, by place."""
        words, places = self.words, {}
        for phrase in self.phrases:
            part = phrase.split()
            at = next(i for i in range(len(words)) if words[i:i + len(part)] == part)
            places.update({at + k: w for k, w in enumerate(part)})
        return sorted(places.items())


# fixed values: the phrases and labels of the base scan
BASE = (
    Template("cc-by", "cc by", ("cc by",)),
    Template("gpl", "general public license", ("general public license",)),
    Template("reserved", "all rights reserved", ("all rights reserved",)),
)

def template(label: str, text: str, *phrases: str) -> Template:
    """A template of a licence text as it is published: its words are taken
    as the scan takes those of a file.  The phrases are words of the text."""
    def plain(raw: str) -> str:
        return " ".join(w for w in re.split(SEPARATORS, raw.translate(_LOWER)) if w)

    return Template(label, plain(text), tuple(plain(p) for p in phrases))


# fixed values: notices of a line or two, by which files name their licence
NOTICES = (
    template("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license", "version 2 0"),
    template("mit", "released under the MIT License", "mit license"),
    template("gpl-3.0", "this work is licensed under the GNU General Public License, version 3",
             "gnu general public license", "version 3"),
    template("gpl-2.0", "this work is licensed under the GNU General Public License, version 2",
             "gnu general public license", "version 2"),
    template("lgpl", "licensed under the GNU Lesser General Public License", "gnu lesser general public license"),
    template("agpl", "licensed under the GNU Affero General Public License", "gnu affero general public license"),
    template("cc-by-nc", "licensed under CC BY-NC 4.0", "cc by nc"),
    template("cc-by-sa", "licensed under CC BY-SA 4.0", "cc by sa"),
    template("cc-by-nd", "licensed under CC BY-ND 4.0", "cc by nd"),
    template("cc0", "dedicated to the public domain under CC0 1.0", "public domain", "cc0"),
    template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license"),
    template("epl", "made available under the terms of the Eclipse Public License", "eclipse public license"),
)

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
    WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
    COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
    ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by
    the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is
    distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy of
    the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>."""

# fixed values: whole licence texts and the notices that licences ask files to
# carry.  Where a name is to be filled in, a text begins after or ends before it.
WHOLE_TEXTS = (
    template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
        to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
        whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the Software. """ + _AS_IS,
             "permission is hereby granted free of charge"),
    template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
        "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
        DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
        OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
             "permission to use copy modify", "distribute this software for any purpose"),
    template("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
             "redistribution and use in source and binary forms", "with or without modification"),
    template("bsd-3-clause", """may be used to endorse or promote products derived from this software without specific prior written
        permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
        ARE DISCLAIMED.""",
             "endorse or promote products derived from this software"),
    template("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
        purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
        not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
        original software. 3. This notice may not be removed or altered from any source distribution.""",
             "altered source versions must be plainly marked as such"),
    template("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
             "free and unencumbered software released into the public domain"),
    template("bsl-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
        and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
        and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the
        Software is furnished to do so, all subject to the following:""",
             "any person or organization obtaining a copy of the software"),
    template("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
             "you may not use this file except in compliance with the license", "apache org licenses license 2 0"),
    template("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
             "source code form is subject to the terms of the mozilla public license"),
    template("gpl-3.0", _GNU.format(name="General Public License", version="3"),
             "gnu general public license as published by the free software foundation", "version 3 of the license"),
    template("gpl-2.0", _GNU.format(name="General Public License", version="2"),
             "gnu general public license as published by the free software foundation", "version 2 of the license"),
    template("lgpl", _GNU.format(name="Lesser General Public License", version="3"),
             "gnu lesser general public license as published by the free software foundation"),
    template("agpl", _GNU.format(name="Affero General Public License", version="3"),
             "gnu affero general public license as published by the free software foundation"),
)
TEMPLATES = NOTICES + WHOLE_TEXTS


def document_frequency(words: DataFrame, vocabulary: list[str]) -> tuple[dict[str, int], int]:
    """In how many rows each vocabulary word occurs, over all rows; the
    result is as small as the vocabulary."""
    found = F.array_intersect(F.col("words"), F.array(*(F.lit(w) for w in vocabulary)))
    counts = words.select(F.explode(F.concat(found, F.array(F.lit(" ")))).alias("word")).groupBy("word").count()
    seen = {r["word"]: r["count"] for r in counts.collect()}
    return seen, seen.pop(" ", 0)


def rare_words(template: Template, seen: dict[str, int], n_rows: int, rare: int) -> list[tuple[int, str]]:
    """The template's index postings: the places of its ``rare`` mandatory
    words with the highest IDF (ties: earlier place)."""
    def idf(word: str) -> float:
        return math.log((1 + n_rows) / (1 + seen.get(word, 0)))

    first: dict[str, int] = {}
    for at, word in template.mandatory():
        first.setdefault(word, at)
    ranked = sorted(first.items(), key=lambda x: (-idf(x[0]), x[1]))
    return [(at, word) for word, at in ranked[:rare]]


def _word_at(words: Column, place: Column) -> Column:
    """The word at a 0-based place; null outside the text."""
    return F.get(words, place)


def _places(hits: Column, postings: list[tuple[int, str]]) -> Column:
    """Starts at which the rare words stand at their relative places: the
    intersection of their shifted position lists."""
    def shifted(at: int, word: str) -> Column:
        return F.transform(F.filter(hits, lambda h: h["word"] == word), lambda h: h["at"] - F.lit(at))

    lists = [shifted(at, word) for at, word in postings]
    out = lists[0]
    for other in lists[1:]:
        out = F.array_intersect(out, other)
    return out


def _verified(words: Column, starts: Column, template: Template) -> Column:
    """The starts where every mandatory word stands at its place."""
    def holds(start: Column) -> Column:
        cond = F.lit(True)
        for at, word in template.mandatory():
            cond = cond & F.coalesce(_word_at(words, start + F.lit(at)) == word, F.lit(False))
        return cond

    return F.filter(starts, holds)


def _share(words: Column, starts: Column, template: Template) -> Column:
    """For each start, the share of the template's words at their place."""
    text = F.split(F.lit(" ".join(template.words)), " ")

    def share(start: Column) -> Column:
        same = F.filter(text, lambda word, at: F.coalesce(_word_at(words, start + at) == word, F.lit(False)))
        return F.size(same) / F.lit(float(len(template.words)))

    return F.transform(starts, share)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, base: tuple[Template, ...] = BASE,
         rare: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score`` for every row.

    ``n_base``, ``first_word`` and ``last_word`` count all places of the base
    phrases; ``labels`` adds the templates found; ``score`` is the largest
    share of a found template that stands word for word (1 for a base
    phrase, 0 where nothing is found).  Null and empty texts have no words
    and no labels (empty strings, null first and last word); repeated rows
    and null ids keep their rows; an empty input gives an empty result.
    """
    everything = tuple(base) + tuple(templates)
    vocabulary = sorted({w for t in everything for _, w in t.mandatory()})
    words = docs.select(
        F.col(id_col).alias("doc_id"),
        F.array_remove(F.split(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), SEPARATORS), "").alias("words"))
    seen, n_rows = document_frequency(words, vocabulary)
    index = [(t, rare_words(t, seen, n_rows, rare)) for t in everything]
    indexed = F.array(*(F.lit(w) for w in sorted({w for _, p in index for _, w in p})))
    w = F.col("words")
    marked = words.withColumn("hits", F.when(F.arrays_overlap(w, indexed), F.filter(
        F.transform(w, lambda x, i: F.struct(x.alias("word"), i.alias("at"))),
        lambda h: F.array_contains(indexed, h["word"]))))
    hits = F.col("hits")
    starts = marked.withColumns({f"s{k}": F.when(hits.isNotNull(), _verified(w, _places(hits, p), t))
                                 for k, (t, p) in enumerate(index)})
    n_base = len(base)
    none = F.array().cast("array<int>")
    all_base = F.concat(*(F.coalesce(F.col(f"s{k}"), none) for k in range(n_base)))
    found, shares = [], []
    for k, (t, _) in enumerate(index):
        s = F.coalesce(F.col(f"s{k}"), none)
        share = F.when(F.size(s) > 0, F.array_max(_share(w, s, t)))
        shares.append(share.alias(f"h{k}"))
        found.append(F.when(F.col(f"h{k}").isNotNull(), F.lit(t.label)))
    wide = starts.select("doc_id", F.size(w).cast("long").alias("n_words"), all_base.alias("places"), *shares)

    def joined(labels: list[Column]) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",")

    best = F.lit(0.0)
    for k in range(len(index)):
        best = F.greatest(best, F.coalesce(F.col(f"h{k}"), F.lit(0.0)))
    return wide.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        joined(found[:n_base]).alias("base_labels"), joined(found).alias("labels"),
        F.round(best, 6).alias("score"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def twin_sql(templates: tuple[Template, ...] = TEMPLATES, base: tuple[Template, ...] = BASE) -> str:
    """The scan in SQL, by plain comparison of every word with every
    mandatory word of that spelling (no index)."""
    rows, texts = [], []
    for k, t in enumerate(tuple(base) + tuple(templates)):
        must = t.mandatory()
        texts.append(f"({k}, {_quoted(t.label)}, {str(k < len(base)).lower()}, {len(must)}, "
                     f"[{', '.join(map(_quoted, t.words))}])")
        rows += [f"({k}, {at}, {_quoted(word)})" for at, word in must]
    return f"""
WITH tpl(t, label, is_base, n_must, txt) AS (VALUES {', '.join(texts)}),
key(t, place, word) AS (VALUES {', '.join(rows)}),
d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
w AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS pos FROM d),
hit AS (SELECT r, t, pos - place AS start, count(*) AS same FROM w JOIN key USING (word) GROUP BY ALL),
ok AS (SELECT r, label, is_base, start,
         len(list_filter(range(len(txt)), lambda i: start + i >= 0 AND words[start + i + 1] = txt[i + 1]))::DOUBLE
           / len(txt) AS share
       FROM hit JOIN tpl USING (t) JOIN d USING (r) WHERE same = n_must),
per AS (SELECT r, count(*) FILTER (WHERE is_base) AS n_base, min(start) FILTER (WHERE is_base) AS first_word,
          max(start) FILTER (WHERE is_base) AS last_word,
          string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE is_base) AS base_labels,
          string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM ok GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(coalesce(score, 0.0), 6)::DOUBLE AS score
FROM d LEFT JOIN per USING (r)"""
