"""Licence scan: passages of a text against licence templates by Dice coefficient over word bigrams.

A document's passages are its whole text, its paragraphs (parted by blank lines) and its lines, so a
notice is found alone, as a block or inside other text.  A passage is lower-cased, everything but
letters and digits becomes one space, and its set of word bigrams A is compared with a template's
set B: 2|A n B| / (|A| + |B|).  A pair can only reach the threshold t if
|B| * t / (2 - t) <= |A| <= |B| * (2 - t) / t, so templates outside these bounds aren't compared.
A passage carries the licence of its best template only: notices of one family differ in a word or two and
all reach the threshold.  Templates that are equally good are all listed.

A match shares at least |B| * t / (2 - t) bigrams with its template, so the bigrams of the whole text tell at once
which templates it can hold; texts that can hold none, nearly all, are done without passages.

Where no passage matches, a notice may still stand in a longer line or paragraph (hard-wrapped before
code, in mid-line, line breaks collapsed).  So what the matching passages leave of the text is searched
by windows of words: they start and end with a bigram of a template, are no longer than its bounds
allow, and are scored alike.  Of windows that share words the best one counts (ties: the longest, then the first).

Everything is done inside the document's row (no shuffle, no explode); the templates are a literal.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public licence notices.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without '
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without '
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
            'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
            "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
            "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
            "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
            "DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
                     "holder nor the names of its contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                 "your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
                 "(at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                 "your option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
                        "License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work."),
]

#: A word that no template has; stands for a passage that has matched.
MATCHED = "\ua66e"
PARAGRAPHS = r"\n[ \t\r]*\n"
NOT_WORD = r"[^\p{L}\p{N}]+"


def _template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    words = _template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _templates(templates: list[tuple[str, str]], threshold: float) -> Column:
    def one(i: int, licence: str, text: str) -> Column:
        grams = template_bigrams(text)
        # bigrams of a window at most: the upper bound, and as many repeated ones as the template has
        span = int(len(grams) * (2 - threshold) / threshold) + len(_template_words(text)) - 1 - len(grams)
        return F.struct(F.lit(i).alias("i"), F.lit(licence).alias("licence"), F.lit(len(grams)).alias("n"),
                        F.lit(len(grams) * threshold / (2 - threshold)).alias("lo"),
                        F.lit(len(grams) * (2 - threshold) / threshold).alias("hi"),
                        F.lit(span).alias("span"), F.array(*map(F.lit, grams)).alias("grams"))
    return F.array(*(one(i, *t) for i, t in enumerate(templates)))


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " ")), " ")


def _bigrams(words: Column) -> Column:
    """The bigrams of at least one word, in order."""
    return F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def _rest(text: Column, found: Column) -> Column:
    """The text with ``MATCHED`` in place of its passages in ``found``."""
    def without(passage: Column, otherwise: Column) -> Column:
        return F.when(F.array_contains(found, passage), F.lit(MATCHED)).otherwise(otherwise)

    def lines(paragraph: Column) -> Column:
        return F.array_join(F.transform(F.split(paragraph, "\n"), lambda x: without(x, x)), "\n")

    paragraphs = F.transform(F.split(text, PARAGRAPHS), lambda p: without(p, lines(p)))
    return F.when(F.size(found) == 0, text).otherwise(without(text, F.array_join(paragraphs, "\n")))


WINDOW = "struct<start: int, n: int, score: double, licence: string>"


def _windows(grams: Column, t: Column, threshold: float) -> Column:
    """For each bigram of template ``t`` in ``grams`` the best window that starts there, if it matches; by start."""
    def score(window: Column) -> Column:
        return F.size(F.array_intersect(window, t["grams"])) * 2.0 / (F.size(F.array_distinct(window)) + t["n"])

    def best(start: Column) -> Column:
        ends = F.transform(F.slice(grams, start, t["span"]), lambda g, k: F.when(
            (k + 1 >= t["lo"]) & F.array_contains(t["grams"], g),
            F.struct(score(F.slice(grams, start, k + 1)).alias("score"), (-k - 1).alias("minus"))))
        return F.transform(F.array(F.array_max(ends)), lambda e: F.struct(
            start.alias("start"), (-e["minus"]).alias("n"), e["score"].alias("score"), t["licence"].alias("licence")))

    hits = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(t["grams"], g), i + 1)), F.isnotnull)
    starts = F.filter(hits, lambda i: F.size(F.array_intersect(F.slice(grams, i, t["span"]), t["grams"])) >= t["lo"])
    return F.filter(F.flatten(F.transform(starts, best)), lambda w: w["score"] >= threshold)


def _apart(windows: Column) -> Column:
    """Of ``windows`` (by start) those that share no word: of two that do, the one with the higher score, then the longer
    one (a notice can be the beginning of another)."""
    def step(acc: Column, w: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        return (F.when(last.isNull() | (w["start"] > last["start"] + last["n"]), F.concat(acc, F.array(w)))
                .when((w["score"] > last["score"]) | ((w["score"] == last["score"]) & (w["n"] > last["n"])), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(w)))
                .otherwise(acc))

    return F.aggregate(windows, F.array().cast(f"array<{WINDOW}>"), step)


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_passages`` (distinct matching passages and, elsewhere, distinct
    matching windows that share no word), ``licences`` (sorted ids of their best templates, joined by commas), ``best`` and
    ``best_score`` (highest Dice; ties to the smaller id).

    Null, empty and wordless texts match nothing: 0 passages, an empty list, null best and score.
    Repeated rows give repeated results, an empty table none.  Other columns aren't read.
    """
    every = _templates(templates, threshold)
    known = F.array(*map(F.lit, sorted({g for _, t in templates for g in template_bigrams(t)})))
    sizes = [len(template_bigrams(t)) for _, t in templates]
    fewest = max(2, int(min(sizes) * threshold / (2 - threshold)) + 1)     # words of the smallest passage

    def grams(words: Column) -> Column:
        # a passage can't have fewer words than bigrams, so the size bounds hold for words from below
        return F.when(F.size(words) >= fewest, F.array_distinct(_bigrams(words))).otherwise(F.array().cast("array<string>"))

    rows = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.select(id_col, "_text", _words(F.col("_text")).alias("_words"))
    rows = rows.select(id_col, "_text", F.array_intersect(grams(F.col("_words")), known).alias("_known"))
    rows = rows.select(id_col, "_text", F.filter(every, lambda t: (F.size("_known") >= t["lo"]) & (
        F.size(F.array_intersect("_known", t["grams"])) >= t["lo"])).alias("_near"))

    def matches(passage: Column) -> Column:
        near = F.filter("_near", lambda t: (F.size(passage) >= t["lo"]) & (F.size(passage) <= t["hi"]))
        scored = F.transform(near, lambda t: F.struct(
            (F.size(F.array_intersect(passage, t["grams"])) * 2.0 / (F.size(passage) + t["n"])).alias("score"),
            t["licence"].alias("licence")))
        return F.transform(F.array(scored), lambda m: F.filter(m, lambda s: (s["score"] >= threshold) & (
            s["score"] == F.array_max(F.transform(m, lambda x: x["score"])))))[0]

    passages = F.array_distinct(F.concat(F.array("_text"), F.split("_text", PARAGRAPHS), F.split("_text", "\n")))
    rows = rows.select(id_col, "_text", "_near", F.when(F.size("_near") > 0, passages).otherwise(F.array().cast("array<string>")).alias("_p"))
    rows = rows.select(id_col, "_text", "_near", "_p", F.transform("_p", _words).alias("_w"))
    rows = rows.select(id_col, "_text", "_near", "_p", F.transform("_w", grams).alias("_b"))
    rows = rows.select(id_col, "_text", "_near", "_p", F.transform("_b", matches).alias("_m"))
    rows = rows.select(id_col, "_text", "_near", F.filter("_p", lambda p, i: F.size(F.get("_m", i)) > 0).alias("_found"), F.flatten("_m").alias("_m"))
    rest = F.when(F.size("_near") > 0, _words(_rest(F.col("_text"), F.col("_found"))))
    rows = rows.select(id_col, "_found", "_m", "_near", rest.alias("_rest"))
    rows = rows.select(id_col, "_found", "_m", "_near", "_rest", F.when(F.size("_near") > 0, _bigrams(F.col("_rest"))).alias("_grams"))
    windows = F.flatten(F.transform("_near", lambda t: _apart(_windows(F.col("_grams"), t, threshold))))
    rows = rows.select(id_col, "_found", "_m", "_rest", F.when(F.size("_near") > 0, _apart(F.array_sort(windows)))
                       .otherwise(F.array().cast(f"array<{WINDOW}>")).alias("_windows"))
    texts = F.array_distinct(F.transform("_windows", lambda w: F.array_join(F.slice("_rest", w["start"], w["n"] + 1), " ")))
    rows = rows.select(id_col, (F.size("_found") + F.size(texts)).alias("n_passages"), F.concat("_m", F.transform(
        "_windows", lambda w: F.struct(w["score"].alias("score"), w["licence"].alias("licence")))).alias("_m"))
    best = F.element_at(F.array_sort(F.transform("_m", lambda s: F.struct(
        (-s["score"]).alias("minus"), s["licence"].alias("licence")))), 1)
    return rows.select(
        id_col, F.col("n_passages").cast("long").alias("n_passages"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("_m", lambda s: s["licence"]))), ",").alias("licences"),
        F.when(F.size("_m") > 0, best["licence"]).alias("best"),
        F.when(F.size("_m") > 0, F.round(-best["minus"], 6)).alias("best_score"))


def oracle(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8) -> str:
    """DuckDB SQL of ``scan`` over ``documents`` whose notices are passages (it has no windows)."""
    rows = ", ".join("({}, {}, {})".format(i, "'" + licence + "'", "[" + ", ".join(f"'{g}'" for g in template_bigrams(t)) + "]")
                     for i, (licence, t) in enumerate(templates))
    return f"""
WITH t(i, licence, grams) AS (VALUES {rows}),
p AS (SELECT doc_id, unnest(list_distinct([x] || string_split_regex(x, '{PARAGRAPHS}') || string_split(x, chr(10)))) AS p
      FROM (SELECT doc_id, coalesce(text, '') AS x FROM documents)),
w AS (SELECT doc_id, p, string_split(trim(regexp_replace(lower(p), '{NOT_WORD}', ' ', 'g')), ' ') AS w FROM p),
g AS (SELECT doc_id, p, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS g
      FROM w WHERE len(w) >= 2),
m AS (SELECT doc_id, p, licence, 2.0 * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS score FROM g, t
      WHERE len(g) BETWEEN len(grams) * {threshold} / (2 - {threshold}) AND len(grams) * (2 - {threshold}) / {threshold}),
b AS (SELECT * FROM m WHERE score >= {threshold} QUALIFY score = max(score) OVER (PARTITION BY doc_id, p)),
h AS (SELECT doc_id, count(DISTINCT p) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences,
             min_by(licence, (-score, licence)) AS best, max(score) AS score
      FROM b GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_passages, coalesce(licences, '') AS licences, best,
       round(score::DOUBLE, 6) AS best_score
FROM documents d LEFT JOIN h ON d.doc_id = h.doc_id"""
