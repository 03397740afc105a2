"""License scans: MinHash bands over overlapping text windows retrieve license
templates, exact shingle containment verifies them. DataFrame functions only.

Texts are cut into windows of twice a template's length, each overlapping the
next by half, so a template lies whole in at least one window. One band is one
MinHash value; a window and a template whose containment reaches the threshold
have at least ``least_similarity`` in common, and the number of bands makes a
band equal with the probability GUARANTEE at least. A window can only have a
template's MinHash if it holds that very shingle, so windows without any shingle
of the templates are passed over, which loses nothing.

Documents are scanned where they are read; only windows with a template's
shingles are shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, text_or_empty

SHINGLE_WORDS = 5
CONTAINMENT_PERCENT = 75
GUARANTEE = 0.999
#: Most templates of one scan; their shingles and bands are held by each task.
MAX_TEMPLATES, MAX_TEMPLATE_WORDS = 1000, 1024

# License notices and texts (license, text), and the families
# whose members share most of their words.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                   "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
                   "or implied. See the License for the specific language governing permissions and limitations under "
                   "the License."),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
            "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
            "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
            "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
            "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
                 "License"),
    ("lgpl-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("lgpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License"),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License"),
    ("agpl-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-2-clause", "Redistributions of source code must retain the above copyright notice, this list of conditions "
                     "and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
                     "copyright notice, this list of conditions and the following disclaimer in the documentation "
                     "and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED"),
    ("bsd-3-clause", "Redistributions of source code must retain the above copyright notice, this list of conditions "
                     "and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
                     "copyright notice, this list of conditions and the following disclaimer in the documentation "
                     "and/or other materials provided with the distribution. 3. Neither the name of the copyright "
                     "holder nor the names of its contributors may be used to endorse or promote products derived from "
                     "this software without specific prior written permission. THIS SOFTWARE IS PROVIDED"),
    ("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
             "use this software for any purpose, including commercial applications, and to alter it and redistribute "
             "it freely"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
                  "compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work"),
    ("cc-by-4.0", "Licensed under CC BY 4.0 International"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa-3.0", "Text is available under the Creative Commons Attribution-ShareAlike License"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc-sa-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                        "International License"),
    ("cc-by-nd-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
)
FAMILIES = {"gnu": ("gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0"),
            "cc": ("cc-by-4.0", "cc-by-sa-4.0", "cc-by-sa-3.0", "cc-by-nc-4.0", "cc-by-nc-sa-4.0", "cc-by-nd-4.0"),
            "bsd-clauses": ("bsd-2-clause", "bsd-3-clause")}



def in_pieces(templates: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Templates of at most MAX_TEMPLATE_WORDS words: a longer text becomes
    pieces of that length under its license, each overlapping the next by half."""
    out = []
    for name, text in templates:
        w, step = template_words(text), MAX_TEMPLATE_WORDS // 2
        if len(w) <= MAX_TEMPLATE_WORDS:
            out.append((name, text))
        else:
            out += [(name, " ".join(w[at:at + MAX_TEMPLATE_WORDS])) for at in range(0, len(w) - step, step)]
    return out


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def stride(words: int) -> int:
    """Words between windows for templates of so many words: the power of two
    (4 at least) that lets every place of the template fit one window."""
    return max(4, 1 << (words - 2).bit_length())


def least_similarity(words: int, percent: int = CONTAINMENT_PERCENT) -> float:
    """Least Jaccard similarity of a window's and a template's shingles when the
    window contains ``percent`` of the template's."""
    own, window = words - SHINGLE_WORDS + 1, 2 * stride(words) - SHINGLE_WORDS + 1
    common = math.ceil(own * percent / 100)
    return common / (own + window - common)


def bands(words: int, percent: int = CONTAINMENT_PERCENT) -> int:
    """Bands that make one equal with the probability GUARANTEE."""
    return math.ceil(math.log(1 - GUARANTEE) / math.log(1 - min(least_similarity(words, percent), 1 - 1e-9)))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != F.lit(""))


def _shingles(text: Column) -> Column:
    """64-bit hashes of the shingles in order; empty for fewer words."""
    def hashes(w: Column) -> Column:
        return F.when(F.size(w) >= SHINGLE_WORDS, F.transform(
            F.sequence(F.lit(0), F.size(w) - SHINGLE_WORDS),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE_WORDS)]))).otherwise(
            F.array().cast("array<bigint>"))
    return let(_words(text), hashes)


def _min_hash(hashes: Column, count: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), count - 1), lambda j: F.array_min(
        F.transform(hashes, lambda h: F.xxhash64(h, j))))


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]], percent: int) -> DataFrame:
    """(no, license, stride, bands, shingles) of each template or piece."""
    templates = in_pieces(templates)
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates")
    rows = []
    for no, (name, text) in enumerate(templates):
        n = len(template_words(text))
        if n < SHINGLE_WORDS:
            raise ValueError(f"a template has {SHINGLE_WORDS} words at least: {text[:60]}")
        rows.append((no, name, text, stride(n), bands(n, percent)))
    made = spark.createDataFrame(rows, "no int, license string, text string, stride int, bands int")
    widest = made.groupBy("stride").agg(F.max("bands").alias("most"))
    return (made.join(widest, "stride").select("no", "license", "stride", F.col("most").alias("bands"),
                                               F.array_distinct(_shingles(F.col("text"))).alias("shingles")))


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
                  percent: int = CONTAINMENT_PERCENT) -> DataFrame:
    """Per id and license found: ``doc_id``, ``license``, ``containment`` (the
    largest share of a template's shingles in one window) and ``n_templates``
    (templates or pieces of the license found). Of a family of licenses that
    share most of their words, only those of the highest containment are
    reported; equal ones stay all.

    A null or empty text, or one of fewer words than a shingle, gives no row.
    Null ids count as one id, rows that share an id report together, and other
    columns are not read. Texts are scanned whole.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(template_table(spark, templates, percent).collect(),
                                  "no int, license string, stride int, bands int, shingles array<bigint>")
    rows = known.collect()
    listed = sorted({h for r in rows for h in r["shingles"]})
    classes = sorted({(r["stride"], r["bands"]) for r in rows})
    if not rows:
        return docs.select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("containment"),
                           F.lit(0).cast("long").alias("n_templates")).limit(0)

    hashed = docs.select("doc_id", _shingles(text_or_empty()).alias("hashes"))
    found = hashed.withColumn("hits", let(F.col("hashes"), lambda h: F.filter(
        F.transform(h, lambda x, i: F.when(x.isin(listed), i)), lambda i: i.isNotNull()))).where(F.size("hits") > 0)

    def windows(s: int, b: int) -> Column:
        """Numbers of the windows with hits; each hit lies in up to two."""
        last = 2 * s - SHINGLE_WORDS  # a window's last shingle
        mine = F.transform("hits", lambda p: F.filter(
            F.array(F.floor(p / s), F.floor(p / s) - 1), lambda k: (k >= 0) & (p - k * s <= last)))
        return F.transform(F.array_distinct(F.flatten(mine)), lambda k: F.struct(
            F.lit(s).alias("stride"), F.lit(b).alias("bands"), k.cast("long").alias("k")))

    cut_out = (found.select("doc_id", "hashes", F.explode(F.flatten(F.array(*[windows(s, b) for s, b in classes]))).alias("w"))
               .select("doc_id", F.col("w.stride").alias("stride"), F.col("w.bands").alias("bands"), F.array_distinct(
                   F.slice("hashes", (F.col("w.k") * F.col("w.stride") + 1).cast("int"),
                           F.col("w.stride") * 2 - SHINGLE_WORDS + 1)).alias("window")))
    keyed = cut_out.distinct().select("doc_id", "stride", "window", F.posexplode(
        _min_hash(F.col("window"), F.col("bands"))).alias("band", "low"))
    bands_of = known.select("no", "stride", F.posexplode(_min_hash(F.col("shingles"), F.col("bands"))).alias("band", "low"))
    candidates = (keyed.join(F.broadcast(bands_of), ["stride", "band", "low"])
                  .select("doc_id", "window", "no").distinct())
    share = F.size(F.array_intersect("window", "shingles")) / F.size("shingles")
    shares = (candidates.join(F.broadcast(known.select("no", "license", "shingles")), "no")
            .select("doc_id", "license", "no", share.alias("share")).where(F.col("share") * 100 >= percent)
            .groupBy("doc_id", "license").agg(F.max("share").alias("containment"),
                                              F.countDistinct("no").alias("n_templates")))
    kin = F.lit(None).cast("string")
    for name, members in FAMILIES.items():
        kin = F.when(F.col("license").isin(*members), F.lit(name)).otherwise(kin)
    best = F.max("containment").over(Window.partitionBy("doc_id", F.coalesce(kin, F.col("license"))))
    return shares.withColumn("best", best).where(F.col("containment") == F.col("best")).drop("best")


def oracle_sql(templates: Sequence[tuple[str, str]] = TEMPLATES, percent: int = CONTAINMENT_PERCENT) -> str:
    """The same result by exact containment over all windows, for DuckDB."""
    k = SHINGLE_WORDS
    values = ",\n  ".join("({}, '{}', {}, [{}])".format(
        no, name, stride(len(w := template_words(text))),
        ", ".join(f"'{x}'" for x in dict.fromkeys(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))))
        for no, (name, text) in enumerate(in_pieces(templates)))
    kin = " ".join(f"WHEN license IN ({', '.join(repr(m) for m in members)}) THEN '{f}'" for f, members in FAMILIES.items())
    return f"""WITH templates(no, license, stride, shingles) AS (VALUES
  {values}),
wanted AS (SELECT no, license, stride, len(shingles) AS size, unnest(shingles) AS shingle FROM templates),
words AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda w: w <> '') AS w
  FROM documents WHERE text IS NOT NULL),
places AS (SELECT doc_id, w, unnest(range(len(w) - {k - 1})) AS p FROM words WHERE len(w) >= {k}),
spelled AS (SELECT doc_id, p, array_to_string(w[p + 1:p + {k}], ' ') AS shingle FROM places),
hits AS (SELECT s.doc_id, s.p, t.* FROM spelled s JOIN wanted t USING (shingle)),
near AS (SELECT *, p // stride AS k FROM hits UNION ALL SELECT *, p // stride - 1 AS k FROM hits),
shares AS (SELECT doc_id, no, license, k, count(DISTINCT shingle) / any_value(size) AS share FROM near
  WHERE k >= 0 AND p - k * stride <= 2 * stride - {k} GROUP BY doc_id, no, license, k),
found AS (SELECT doc_id, license, max(share) AS containment, count(DISTINCT no) AS n_templates
  FROM shares WHERE share * 100 >= {percent} GROUP BY doc_id, license)
SELECT doc_id, license, containment, n_templates FROM found
QUALIFY containment = max(containment) OVER (PARTITION BY doc_id, CASE {kin} ELSE license END)"""
