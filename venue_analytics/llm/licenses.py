"""License scan by a positional index of rare template words.

Base labels come from fixed phrases whose words stand consecutively. The method's labels come from
templates: licence words are weighed by inverse document frequency over all documents, and the index
holds the postings (word to template and position) of each template's highest-IDF words. Of each file the
words that the index holds are looked up; hits of one template whose position in the file minus position in
the template agree lie on one placement of it. The share of a template's postings that its best placement
hits is its score, and a template that reaches the limit counts when all its key phrases stand in the
file.

Per file everything happens within its row; only the document frequencies are shuffled, one row per
licence word and map task.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venue_analytics.llm.common import let, table, text_of

#: what separates words: ASCII other than digits and letters
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: base phrases and their labels (fixed values)
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]


#: notices as licences give them (fixed values); key phrases are words after splitting
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
             "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
             ("apache license version 2 0",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0.", ("apache license version 2 0",)),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.", ("gnu general public license version 3",)),
    Template("gpl-2.0", "This work is licensed under the GNU General Public License, version 2.", ("gnu general public license version 2",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation", ("gnu general public license", "redistribute")),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    Template("mit", "Released under the MIT License.", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the Software), to deal in the Software without restriction", ("permission is hereby granted free of charge",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted", ("permission to use copy modify",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla public license",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0.", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0.", ("cc by sa",)),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work under "
             "CC0 1.0", ("cc0",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to "
             "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
             "the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
             "notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT "
             "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
             "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
             "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
             "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.", ("permission is hereby granted free of charge", "noninfringement")),
    Template("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
             "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
             "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
             "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
             "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
             ("redistributions in binary form must reproduce",)),
    Template("bsd-3-clause", "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
             "following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
             "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
             "without specific prior written permission.", ("neither the name of", "endorse or promote products")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
             "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND "
             "THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
             "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
             "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS", ("permission to use copy modify", "author disclaims all warranties")),
    Template("unlicense", "This is free and unencumbered software released into the public domain.", ("free and unencumbered software",)),
)
#: highest-IDF words of a template that the index holds: so many, or this share of its words if that is more
LOOKUPS, SHARE = 12, 0.4
LIMIT = 0.6


def _template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^0-9a-z]+", text.lower()) if w]


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lowered (the Kelvin sign, whose lower case is an ASCII letter, put aside)."""
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit("K"), F.lit("ĸ"))), GAP), "")


def document_frequencies(docs: DataFrame, text_col: str = "text", templates=TEMPLATES) -> tuple[int, dict[str, int]]:
    """Number of rows and, of each template word, the rows that hold it. At most one row per template word
    comes to the driver."""
    vocabulary = sorted({w for t in templates for w in _template_words(t.text)})
    words = docs.select(F.array_intersect(words_of(text_of(text_col)), F.array(*[F.lit(w) for w in vocabulary])).alias("w"))
    rows = words.select(F.explode("w").alias("w")).groupBy("w").count().collect()
    return docs.count(), {r["w"]: r["count"] for r in rows}


class Index:
    """Postings of each template's highest-IDF words; rare and common are told apart by rank alone, so that a
    notice that many documents carry keeps its postings."""

    def __init__(self, n: int, df: dict[str, int], templates=TEMPLATES):
        self.templates = templates
        split = [_template_words(t.text) for t in templates]
        self.idf = {w: round(math.log((n + 1) / (df.get(w, 0) + 1)), 9) for s in split for w in s}
        chosen = [set(sorted(set(s), key=lambda w: (-self.idf[w], w))[:max(LOOKUPS, math.ceil(SHARE * len(set(s))))]) for s in split]
        self.postings: dict[str, list[tuple[int, int]]] = {}
        for k, (s, rare) in enumerate(zip(split, chosen)):
            for p, w in enumerate(s):
                if w in rare:
                    self.postings.setdefault(w, []).append((k, p))
        #: postings of each template: the hits that a whole one has
        self.most = [sum(w in rare for w in s) for s, rare in zip(split, chosen)]

    def scores(self, words: Column) -> Column:
        """Array of a score per template, for a bound array of words."""
        zero = F.array(*[F.lit(0.0)] * len(self.templates))
        if not self.postings:
            return zero
        posted = F.create_map(*[x for w, at in sorted(self.postings.items()) for x in (
            F.lit(w), F.array(*[F.struct(F.lit(k).alias("t"), F.lit(p).alias("p")) for k, p in at]))])
        held = sorted(self.postings)

        def place(hits: Column) -> Column:
            cells = F.sort_array(F.flatten(F.transform(hits, lambda h: F.transform(
                F.element_at(posted, h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("d"))))))

            def runs(c: Column) -> Column:
                starts = F.filter(F.transform(c, lambda e, j: F.struct(e["t"].alias("t"), e["d"].alias("d"), j.alias("j"))),
                                  lambda e: (e["j"] == 0) | ((F.get(c, e["j"] - 1)["t"] != e["t"]) | (F.get(c, e["j"] - 1)["d"] != e["d"])))
                return let(starts, lambda s: F.transform(s, lambda e, j: F.struct(
                    e["t"].alias("t"), (F.coalesce(F.get(s, j + 1)["j"], F.size(c)) - e["j"]).alias("n"))))
            most = F.array(*[F.lit(float(max(m, 1))) for m in self.most])
            return let(let(cells, runs), lambda r: F.transform(F.sequence(F.lit(0), F.lit(len(self.templates) - 1)), lambda t: F.least(
                F.lit(1.0), F.coalesce(F.array_max(F.transform(F.filter(r, lambda e: e["t"] == t), lambda e: e["n"])), F.lit(0)) / F.get(most, t))))
        looked_up = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*held), F.struct(w.alias("w"), i.alias("i")))), lambda h: h.isNotNull())
        return let(looked_up, lambda hits: F.when(F.size(hits) == 0, zero).otherwise(place(hits)))


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _phrase(line: Column, phrase: str) -> Column:
    """Struct (n, first, last) of a phrase's places in ``line``, blank-led words ended by a blank."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
    pieces = F.split(F.concat(F.lit("|"), line), f"(?= {phrase} )", -1)
    some = let(pieces, lambda p: F.struct(
        (F.size(p) - 1).cast("long").alias("n"), _spaces(F.element_at(p, 1)).cast("long").alias("first"),
        (_spaces(line) - _spaces(F.element_at(p, -1))).cast("long").alias("last")))
    return F.when(F.contains(line, F.lit(f" {phrase} ")), some).otherwise(none)


def scan(docs: DataFrame, text_col: str = "text", out: str = "license", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """``docs`` with a struct column ``out`` (replacing one of that name): ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels`` and ``labels`` (sorted arrays), ``score``.

    The score is that of the best template placement, 1 with a base label. Null and empty texts have no
    words, no labels and score 0. Phrases are given in lower case."""
    n, df = document_frequencies(docs, text_col, templates)
    index = Index(n, df, templates)
    names = [F.col(f"`{c}`") for c in docs.columns if c != out]
    held = docs.select(F.struct(*names).alias("d"), words_of(text_of(text_col)).alias("words"))
    held = held.select("d", "words", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("line"))
    line = F.col("line")
    held = held.select("d", "line", F.size("words").cast("long").alias("n_words"),
                       let(F.col("words"), index.scores).alias("scores"), F.array(*[_phrase(line, p) for p in phrases]).alias("p"))
    base = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(F.get("p", F.lit(k))["n"] > 0, F.lit(v))
                                                           for k, v in enumerate(phrases.values())]), lambda x: x.isNotNull())))

    def accepted(k: int, t: Template) -> Column:
        here = F.get("scores", F.lit(k)) >= LIMIT
        for key in t.keys:
            here = here & F.contains(line, F.lit(f" {key} "))
        return F.when(here, F.lit(t.label))
    own = F.filter(F.array(*[accepted(k, t) for k, t in enumerate(templates)]), lambda x: x.isNotNull())
    held = held.select("d", "n_words", "scores", "p", base.alias("base"), own.alias("own"))
    return held.select("d.*", F.struct(
        "n_words", F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_base"),
        F.array_min(F.transform("p", lambda x: x["first"])).alias("first_word"), F.array_max(F.transform("p", lambda x: x["last"])).alias("last_word"),
        F.col("base").alias("base_labels"), F.array_sort(F.array_distinct(F.concat("base", "own"))).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.array_max("scores")).alias("score")).alias(out))


# ------------------------------------------------------------------------------ query
def op6_licenses(spark, sf_dir):
    """License labels of every document."""
    got = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    x = F.col("license")
    return got.select("doc_id", x["n_words"].alias("n_words"), x["n_base"].alias("n_base"), x["first_word"].alias("first_word"),
                      x["last_word"].alias("last_word"), F.array_join(x["base_labels"], ",").alias("base_labels"),
                      F.array_join(x["labels"], ",").alias("labels"), x["score"].alias("score"))
