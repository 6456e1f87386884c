"""License scan: MinHash bands over overlapping text windows retrieve templates, verified exactly.

Templates and documents are sequences of five-word shingles. Templates are classed by size in powers
of two; for a class of size c a document is read in windows of 2c shingles that start every c, so a
notice lies whole in one window. A window that holds ``similarity`` of a template has a Jaccard
similarity to it that the class bounds from below; with one hash to a band, ``bands`` follows from
that bound and the accepted chance of a miss. A window and a template that share a band are
candidates; the exact containment of the template's shingles in the window decides.

A band of a window can equal a template's only if the window holds the template's smallest shingle
in that band. So documents without any such shingle are passed over, and only windows around one are
hashed: this changes no result. Everything runs on built-in functions; templates are a parameter of
any length, whole license texts included. Their shingles lie in a table that candidates are joined
with; the plan holds only the smallest shingle per band (some fifty) of each.

Defined results: null text is an empty text; documents or templates without words match nothing; a
template of fewer than five words matches documents of just those words; rows that share an id are
reported together, null ids as one; an empty table or no templates give no rows. Other columns are
not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.llm.common import NEAR, with_native_shingles, written

#: Names and public notices of licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
)

#: Whole public texts, the notices that files carry, and identifier lines of five words or more.
WHOLE_TEXTS = (
    ("MIT text", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")),
    ("ISC text", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
        "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.")),
    ("BSD-3-Clause text", (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS "
        "PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
        "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN "
        "NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")),
    ("Unlicense text", (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author "
        "or authors of this software dedicate any and all copyright interest in the software to the public domain. We make "
        "this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend "
        "this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
        "software under copyright law. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")),
    ("Apache-2.0 notice", (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.")),
    ("AGPL notice", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation")),
    ("LGPL notice", (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation")),
    ("MIT notice", "Licensed under the MIT License."),
    ("SPDX Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("SPDX BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("SPDX BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("SPDX GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("SPDX GPL-2.0-or-later", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("SPDX GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("SPDX GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("SPDX MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
)


@dataclass(frozen=True)
class ScanParams:
    similarity: float = NEAR
    miss: float = 1e-4      # chance to pass over a window that holds a template
    segment: int = 4096     # shingles of a long document that are taken together, at least one window's step

    def bands(self, size: int) -> int:
        """Bands for templates of more than size/2 and at most ``size`` shingles."""
        least = size // 2 + 1
        both = self.similarity * least
        j = both / (2 * size + least - both)
        return math.ceil(math.log(self.miss) / math.log(1 - j))


def _templates(spark: SparkSession, templates, p: ScanParams) -> DataFrame:
    """(template, name, size, sh, least) of the distinct templates that have words: a key, the size
    class, the distinct shingles, and the smallest shingle of every band that any class may need."""
    raw = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(name).alias("name"), F.lit(text).alias("text"))
                                                    for name, text in templates))).alias("t")).select("t.*")
    sets = written(with_native_shingles(raw, "text", "runs").select("name", F.array_sort(F.array_distinct("runs")).alias("sh"))
                   .where(F.size("sh") > 0), "license-shingles")
    size = F.when(F.size("sh") > 1, F.expr("shiftleft(1, length(bin(size(sh) - 1)))")).otherwise(1)
    least = F.array(*(_least_by(F.col("sh"), b) for b in range(p.bands(1 << 30))))
    return written(sets.select(F.xxhash64("name", "sh").alias("template"), "name", size.alias("size"), "sh", least.alias("least"))
                   .dropDuplicates(["template"]), "license-templates")


def _order(h, band: int):
    return F.xxhash64(h, F.lit(band))


def _least_by(runs, band: int):
    """The shingle with the smallest hash in a band."""
    return F.array_min(F.transform(runs, lambda h: F.struct(_order(h, band).alias("o"), h.alias("h"))))["h"]


def scan(docs: DataFrame, templates=TEMPLATES, p: ScanParams = ScanParams(), id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, license, n_found, n_shingles, containment, first_word): per document and template, the
    most of its shingles in one window and the word at which the first such window starts."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table = _templates(docs.sparkSession, templates, p) if templates else None
    # The driver holds a key and some fifty shingles of each template; the rest stays in the table.
    known = sorted((r["size"], r["template"], r["least"][: p.bands(r["size"])])
                   for r in table.select("size", "template", "least").collect()) if templates else []
    if not known:
        return slim.select(F.col("id").alias(id_col), F.lit("").alias("license"), F.lit(0).alias("n_found"),
                           F.lit(0).alias("n_shingles"), F.lit(0.0).alias("containment"), F.lit(0).alias("first_word")).where(F.lit(False))
    runs = with_native_shingles(slim, "text", "runs").select("id", "runs")
    anchors = sorted({h for _, _, least in known for h in least})
    held = F.exists("runs", lambda h: h.isin(anchors))
    classes = sorted({size for size, *_ in known})
    window = 2 * classes[-1]
    # Long documents in segments, which overlap by a window: slices of a whole document for every
    # window would cost its length each. A segment holds whole windows of every class.
    segment = classes[-1] * math.ceil(p.segment / classes[-1])
    count = F.greatest(F.ceil(F.size("runs") / segment), F.lit(1)).cast("int")
    # The anchors are looked up where the places are made: a filter on ``runs`` would be moved below the
    # projections that make the shingles and make them anew there, once per mention.
    places = F.when(held, F.transform(F.sequence(F.lit(0), count - 1), lambda k: k * segment))
    segments = (runs.withColumn("at", F.explode_outer(places)).where("at is not null")
                .select("id", "at", F.slice("runs", F.col("at") + 1, segment + window).alias("runs")))
    # The documents are read and cut once for all classes; only those with an anchor are kept.
    segments = written(segments, "license-segments")
    per_class = []
    for size in classes:
        here = [(key, least) for c, key, least in known if c == size]
        marks = sorted({h for _, least in here for h in least})
        # Windows k*size .. (k+2)*size with a marked shingle, by the place where they start.
        hit = F.filter(F.transform("runs", lambda h, i: F.when(h.isin(marks), (i / size).cast("int"))), lambda k: k.isNotNull())
        starts = F.array_distinct(F.filter(F.flatten(F.transform(hit, lambda k: F.array(k, k - 1))), lambda k: (k >= 0) & (k < segment // size)))
        placed = segments.select("id", "at", "runs", F.explode(starts).alias("k"))
        sets = placed.select("id", (F.col("at") + F.col("k") * size).alias("first_word"),
                             F.array_distinct(F.slice("runs", F.col("k") * size + 1, 2 * size)).alias("set"))
        signed = sets.select("id", "first_word", "set", F.array(*(_least_by(F.col("set"), b) for b in range(p.bands(size)))).alias("sig"))
        shares = [F.when(F.exists(F.arrays_zip(F.col("sig").alias("a"), F.array(*(F.lit(h) for h in least)).alias("b")),
                                  lambda z: z["a"] == z["b"]), F.lit(key).cast("long")) for key, least in here]
        per_class.append(signed.select("id", "first_word", "set", F.explode(F.array_compact(F.array(*shares))).alias("template")))
    candidates = reduce(DataFrame.union, per_class)
    found = candidates.join(table.select("template", "name", "sh"), "template").select(
        "id", "name", F.size(F.array_intersect("set", "sh")).alias("n_found"), F.size("sh").alias("n_shingles"), "first_word")
    matches = found.where(F.col("n_found") >= F.col("n_shingles") * F.lit(p.similarity) - F.lit(1e-9))
    return (matches.groupBy("id", "name", "n_shingles").agg(F.max("n_found").alias("n_found"), F.min("first_word").alias("first_word"))
            .select(F.col("id").alias(id_col), F.col("name").alias("license"), "n_found", "n_shingles",
                    (F.col("n_found") / F.col("n_shingles")).alias("containment"), "first_word"))
