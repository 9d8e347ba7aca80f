"""License notices in documents, by MinHash over overlapping windows.

Everything here is DataFrame expressions. Words are runs of letters and digits in
lower case, shingles five of them. A template of n words is looked for in windows
of n + n / 2 words, one every n / 2 words, so that a passage of its length lies
whole in one of them. A window without any shingle of a template contains nothing
of it; all others get a signature of `HASHES` smallest hashes, each a band of its
own. Where four fifths of a template's shingles are in a window, the two sets agree
in a third at least, and a band is shared with a probability of
1 - (2/3) ** 40, which is above 0.9999999. Pairs that share a band are compared
exactly: the part of the template's shingles that the window holds. Templates of one
family are told apart by shingles that must be there (version, GNU license, clause).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINED = 0.8
HASHES = 40

_GRANT = (
    "you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by "
    "the Free Software Foundation"
)
_LATER = "either version {} of the License, or (at your option) any later version."
_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met"
)
_BSD_2 = (
    f"{_REDISTRIBUTION}: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)

# The wording of public license notices.
TEMPLATES = {
    "AGPL-3.0-header": f"This program is free software: {_GRANT.format('Affero ')}, {_LATER.format(3)}",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD": _REDISTRIBUTION,
    "BSD-2-Clause": _BSD_2 + _DISCLAIMER,
    "BSD-3-Clause": _BSD_2 + _BSD_3 + _DISCLAIMER,
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "EPL-1.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0 which accompanies this distribution, and is available at"
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at"
    ),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-header": f"This program is free software; {_GRANT.format('')}; {_LATER.format(2)}",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": f"This program is free software: {_GRANT.format('')}, {_LATER.format(3)}",
    "GPL-header": f"This program is free software: {_GRANT.format('')}",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1-header": f"This library is free software; {_GRANT.format('Lesser ')}; {_LATER.format('2.1')}",
    "LGPL-3.0-header": f"This library is free software: {_GRANT.format('Lesser ')}, {_LATER.format(3)}",
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction"
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at"
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."
    ),
}

_GPL, _LGPL, _AGPL = "the gnu general public license", "gnu lesser general public license", "gnu affero general public license"
#: Shingles without which a window is of another license or version of the family.
REQUIRED = {
    "AGPL-3.0-header": [_AGPL, "version 3 of the license"],
    "BSD-3-Clause": ["neither the name of the"],
    "EPL-1.0": ["the eclipse public license v1"],
    "EPL-2.0": ["the eclipse public license 2"],
    "GPL-2.0": ["general public license version 2"],
    "GPL-2.0-header": [_GPL, "version 2 of the license"],
    "GPL-3.0": ["general public license version 3"],
    "GPL-3.0-header": [_GPL, "version 3 of the license"],
    "GPL-header": [_GPL],
    "LGPL-2.1-header": [_LGPL, "version 2 1 of the"],
    "LGPL-3.0-header": [_LGPL, "version 3 of the license"],
}
#: Texts that another one holds but for a clause: at the place of that one they are not reported.
WITHIN = {"BSD-2-Clause": "BSD-3-Clause"}


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def _shingles(words: Column) -> Column:
    starts = F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(1), F.size(words) - SHINGLE + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(words, i, SHINGLE)))


def _signature(shingles: Column) -> Column:
    """The smallest hash of the set under each hash function, with the function's number."""
    turns = F.sequence(F.lit(0), F.lit(HASHES - 1))
    return F.transform(turns, lambda i: F.xxhash64(i, F.array_min(F.transform(shingles, lambda x: F.xxhash64(i, x)))))


def templates_frame(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """Rows license, words, step, parts: a template's words, the distance of windows, its different shingles."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, template string")
    words = rows.select("license", _words(F.col("template")).alias("tokens")).where(F.size("tokens") >= SHINGLE)
    return words.select(
        "license",
        F.size("tokens").alias("words"),
        F.floor(F.size("tokens") / 2).cast("int").alias("step"),
        F.array_distinct(_shingles(F.col("tokens"))).alias("parts"),
    )


def _covering_words(parts: list[list[str]]) -> list[str]:
    """Words of which every shingle has one, long ones first."""
    open_ = {shingle for part in parts for shingle in part}
    chosen = []
    while open_:
        counts: dict[str, int] = {}
        for shingle in open_:
            for word in set(shingle.split(" ")):
                counts[word] = counts.get(word, 0) + len(word) ** 2
        best = max(sorted(counts), key=counts.__getitem__)
        chosen.append(best)
        open_ = {x for x in open_ if best not in x.split(" ")}
    return chosen


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Rows doc_id, license, contained, first_word, n_words: one for each document and template found in it.

    The window with most of the template, the first of those: its place in words,
    and the part of the template's shingles that it holds. Templates, a short list
    of parameters, of fewer than five words are not looked for. NULL, empty and
    short texts match nothing; rows that repeat an id, or have none, are reported
    together under it.
    """
    spark = docs.sparkSession
    known = templates_frame(spark, TEMPLATES if templates is None else templates)
    rows = [(x.license, x.words, x.step, list(x.parts)) for x in known.collect()]
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not rows:
        return columns.where("false").selectExpr(
            "doc_id", "'' AS license", "0D AS contained", "0L AS first_word", "0L AS n_words"
        )
    # Without one of these words no shingle of a template is in the text.
    some = "|".join(_covering_words([x[3] for x in rows]))
    likely = columns.where(F.lower("text").rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{some})(?![\p{{L}}\p{{N}}])"))
    # A window with four fifths of a template's shingles has that many hits at least.
    least: dict[tuple[int, int], int] = {}
    for _, n, s, parts in rows:
        least[n, s] = min(least.get((n, s), len(parts)), math.ceil(CONTAINED * len(parts) - 1e-9))
    every = F.array(
        *(F.struct(F.lit(n).alias("words"), F.lit(s).alias("step"), F.lit(k).alias("least")) for (n, s), k in sorted(least.items()))
    )
    sizes = F.filter(every, lambda z: z["least"] <= F.size("hits"))
    wanted = sorted({s for r in rows for s in r[3]})
    # Each explode of a single array computes it once; a plain column would be computed again at every use.
    tokens = likely.select("doc_id", F.explode(F.array(_words(F.col("text")))).alias("tokens"))
    shingles = tokens.select("doc_id", F.explode(F.array(_shingles(F.col("tokens")))).alias("shingles"))
    places = F.transform("shingles", lambda x, i: F.when(x.isin(wanted), i))
    hits = shingles.select("doc_id", "shingles", F.explode(F.array(F.filter(places, lambda i: i.isNotNull()))).alias("hits"))
    # Windows that hold a hit: numbers k with k * step <= hit and hit + 5 <= k * step + words + step.
    windows = F.array_distinct(
        F.flatten(
            F.transform(
                "hits",
                lambda h: F.flatten(
                    F.transform(
                        sizes,
                        lambda z: F.transform(
                            F.sequence(
                                F.greatest(F.lit(0), F.ceil((h + SHINGLE - z["words"] - z["step"]) / z["step"]).cast("int")),
                                F.greatest(F.lit(0), F.floor(h / z["step"]).cast("int")),
                            ),
                            lambda k: F.struct(z["words"].alias("words"), z["step"].alias("step"), z["least"].alias("least"), (k * z["step"]).alias("first")),
                        ),
                    )
                ),
            )
        )
    )
    last = F.col("w.first") + F.col("w.words") + F.col("w.step") - SHINGLE
    within = F.size(F.filter("hits", lambda h: (h >= F.col("w.first")) & (h <= last)))
    window = hits.select("doc_id", "shingles", "hits", F.explode(windows).alias("w")).where(within >= F.col("w.least")).select(
        "doc_id",
        F.col("w.words").alias("words"),
        F.col("w.first").alias("first"),
        F.slice("shingles", F.col("w.first") + 1, F.col("w.words") + F.col("w.step") - SHINGLE + 1).alias("own"),
    )
    bands = window.where(F.size("own") > 0).select("doc_id", "words", "first", "own", F.explode(_signature(F.col("own"))).alias("band"))
    # A template's bands are HASHES rows, the templates a list of parameters: a bounded table.
    template_bands = F.broadcast(known.select("license", "words", "parts", F.explode(_signature(F.col("parts"))).alias("band")))
    found = bands.join(template_bands, ["words", "band"])
    held = F.size(F.array_intersect("own", "parts")) / F.size("parts")
    needs = F.lit(True)
    for name, needed in (REQUIRED if templates is None else {}).items():
        needs &= (F.col("license") != name) | (F.size(F.array_intersect("own", F.array(*map(F.lit, needed)))) == len(needed))
    best = (
        found.where(needs)
        .select("doc_id", "license", "first", "words", held.alias("contained"))
        .where(F.col("contained") >= CONTAINED)
        .groupBy("doc_id", "license")
        .agg(F.min(F.struct((-F.col("contained")).alias("less"), "first", "words")).alias("best"))
        .select(
            "doc_id",
            "license",
            (-F.col("best.less")).alias("contained"),
            F.col("best.first").cast("long").alias("first_word"),
            F.col("best.words").cast("long").alias("n_words"),
        )
    )
    if templates is not None:
        return best
    # At most one row per template: a bounded list for each document.
    rows_of = best.groupBy("doc_id").agg(F.collect_list(F.struct(*best.columns)).alias("all"))
    inside = F.lit(False)
    for name, other in WITHIN.items():
        over = F.exists("all", lambda x: (x["license"] == other) & (x["first_word"] < F.col("r.first_word") + F.col("r.n_words")) & (F.col("r.first_word") < x["first_word"] + x["n_words"]))
        inside |= (F.col("r.license") == name) & over
    return rows_of.select("all", F.explode("all").alias("r")).where(~inside).select("r.*")
