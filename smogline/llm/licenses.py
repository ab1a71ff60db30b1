"""Licence notices in texts, by the Dice coefficient over word bigrams. DataFrame functions only.

Texts and templates are normalised alike: letters lowered, runs of anything but letters and
digits one space. The similarity of a passage and a template is 2 * |A & B| / (|A| + |B|) over their
sets of word bigrams (the word itself, where there is one word).

*Passages.* A text is scanned by its lines, by its paragraphs (lines up to an empty one), and by windows:
for each template of two words or more, every run of as many words as the template has, over the
whole text and across its lines. So a notice is found inside of a longer line, and where it is wrapped and
goes on as something else. A text with fewer words than the template is one window.

*Size bounds*: a similarity of at least ``threshold`` needs sizes a and b with
2 * min(a, b) >= threshold * (a + b); a template out of bounds is no candidate. With them, a passage holds at
least threshold / (2 - threshold) of a template's bigrams. So it holds one of any b - t + 1 of them, where t is that
many: the *anchors*, the longest of its bigrams, which are rare in texts.

1. Each text is read once for its words; bigrams that are anchors are found by a join.
2. Lines and paragraphs of texts with an anchor are compared with the templates by a join of bigrams.
3. Windows around each anchor are compared with the one template it belongs to.

Tables of templates are broadcast only if they are small (``groups.checked``).

Defined cases: null and empty texts have no licence; of equal similarities the template first by
name is named; a template without words is never found; rows of one id, repeated ones too, are texts of their
own; an empty table gives none. Columns other than id and text, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.llm.groups import checked
from smogline.session import stored

#: Notices by which works name their licence, and short licences in full.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "MIT full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}


def templates(spark: SparkSession) -> DataFrame:
    """(name, text)"""
    rows = [F.struct(F.lit(n).alias("name"), F.lit(t).alias("text")) for n, t in TEMPLATES.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain != "", F.split(plain, " ")).otherwise(F.array().cast("array<string>"))


def _bigrams(words: Column) -> Column:
    last = F.size(words) - 1
    pairs = F.transform(
        F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)),
    )
    return F.array_distinct(F.when(last == 0, words).otherwise(pairs))


def _forms(known: DataFrame, threshold: float) -> DataFrame:
    """(name, length, bigrams, m, anchors) of the templates that have words."""
    b = F.col("bigrams")
    least = F.ceil(F.lit(threshold / (2 - threshold)) * F.size(b) - F.lit(1e-9))
    longest = F.transform(F.array_sort(F.transform(b, lambda x: F.struct((-F.length(x)).alias("l"), x.alias("x")))), lambda s: s["x"])
    forms = known.select("name", _words(F.col("text")).alias("words")).select(
        "name", F.size("words").alias("length"), _bigrams(F.col("words")).alias("bigrams"))
    return forms.where(F.size("bigrams") > 0).select(
        "*", F.size(b).alias("m"), F.slice(longest, F.lit(1), (F.size(b) - least + 1).cast("int")).alias("anchors"),
    )


def scan(
    docs: DataFrame,
    known: DataFrame | None = None,  # (name, text); the notices of this module by default
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
) -> DataFrame:
    """(id, licenses, best, similarity) for every row.

    ``licenses`` are the names of all templates found, sorted, joined by commas; ``best`` is the one
    of the most similar passage (null without one), ``similarity`` its coefficient (else 0).
    """
    known = templates(docs.sparkSession) if known is None else known
    forms = stored(_forms(known, threshold), "forms")
    sizes = forms.agg(F.min("length").alias("least")).first()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.monotonically_increasing_id().alias("row"))  # by place in the scan
    if sizes.least is None:
        return rows.select("id", F.lit("").alias("licenses"), F.lit(None).cast("string").alias("best"),
                           F.lit(0.0).alias("similarity"))
    anchors = stored(forms.select("name", "length", F.explode("anchors").alias("bigram")), "anchors")
    marks = stored(anchors.select("bigram").distinct(), "marks")

    # behind a generator, as an expression inside of a lambda would be worked out again for every element
    texts = rows.where(F.length("text") > 0).select("row", "text", F.explode(F.array(_words(F.col("text")))).alias("words"))
    texts = texts.select("row", F.col("text"), "words", F.explode(F.array(_pairs(F.col("words"), sizes.least == 1))).alias("pairs"))
    hits = stored(
        texts.select("row", F.posexplode("pairs").alias("at", "bigram")).join(checked(marks), "bigram", "left_semi"), "hits"
    )
    near = stored(
        rows.select("row", "text").join(hits.select("row").distinct(), "row", "left_semi")
        .select("row", "text", _words(F.col("text")).alias("words")), "near",
    )
    found = _of_passages(near, forms, threshold).unionByName(_of_windows(near, hits, anchors, forms, threshold))
    of_row = found.groupBy("row").agg(
        F.array_join(F.sort_array(F.collect_set("name")), ",").alias("licenses"),  # names of templates
        F.min(F.struct((-F.col("similarity")).alias("s"), "name")).alias("top"),
    )
    return rows.select("row", "id").join(of_row, "row", "left").select(
        "id", F.coalesce("licenses", F.lit("")).alias("licenses"), F.col("top.name").alias("best"),
        F.coalesce(-F.col("top.s"), F.lit(0.0)).alias("similarity"),
    )


def _pairs(words: Column, singles: bool) -> Column:
    """Every bigram of a text at its place; with ``singles``, its words behind them, for templates of one word."""
    last = F.size(words) - 1
    pairs = F.transform(
        F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)),
    )
    return F.concat(pairs, F.array_distinct(words)) if singles else pairs


def _of_passages(near: DataFrame, forms: DataFrame, threshold: float) -> DataFrame:
    """(row, name, similarity) of lines and paragraphs."""
    parts = F.array_distinct(F.concat(F.split("text", r"\n"), F.split("text", r"\n[ \t\r]*\n")))
    part = near.select("row", F.posexplode(parts).alias("place", "part")).where("part != ''")
    words = part.select("row", "place", F.explode(F.array(_words(F.col("part")))).alias("words"))
    sets = words.select("row", "place", F.explode(F.array(_bigrams(F.col("words")))).alias("b")).where(F.size("b") > 0)
    of = stored(forms.select("name", "m", F.explode("bigrams").alias("bigram")), "of")
    pairs = sets.select("row", "place", F.size("b").alias("n"), F.explode("b").alias("bigram")).join(
        checked(of), "bigram"
    ).where(2 * F.least("n", "m") >= threshold * (F.col("n") + F.col("m")))
    return pairs.groupBy("row", "place", "name", "n", "m").count().select(
        "row", "name", (2 * F.col("count") / (F.col("n") + F.col("m"))).alias("similarity")
    ).where(F.col("similarity") >= threshold)


def _of_windows(
    near: DataFrame, hits: DataFrame, anchors: DataFrame, forms: DataFrame, threshold: float
) -> DataFrame:
    """(row, name, similarity) of windows of a template's length that hold one of its anchors."""
    size, p = F.col("size"), F.col("at") + 1
    around = hits.join(anchors.where("length > 1").withColumnRenamed("length", "size"), "bigram").select("row", "name", "size", p.alias("p"))
    windows = (
        around.join(near.select("row", F.size("words").alias("n")), "row")
        .select("row", "name", "size", F.explode(F.sequence(
            F.least(F.greatest(F.col("p") - size + 2, F.lit(1)), F.greatest(F.col("n") - size + 1, F.lit(1))),
            F.greatest(F.least(F.col("p"), F.col("n") - size + 1), F.lit(1)))).alias("start")).distinct()
    )
    cut = windows.join(near.select("row", "words"), "row").select(
        "row", "name", F.explode(F.array(F.slice("words", F.col("start"), F.col("size")))).alias("window"))
    sets = cut.select("row", "name", F.explode(F.array(_bigrams(F.col("window")))).alias("b"))
    n, m = F.size("b"), F.col("m")
    compared = sets.join(forms.select("name", "m", "bigrams"), "name").where(2 * F.least(n, m) >= threshold * (n + m))
    return compared.select(
        "row", "name", (2 * F.size(F.array_intersect("b", "bigrams")) / (n + m)).alias("similarity")
    ).where(F.col("similarity") >= threshold)
