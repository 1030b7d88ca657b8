"""Licence scans: normalised text against licence templates by the Dice coefficient over word bigrams.

The units of a document are its lines, its paragraphs and its whole text. For a coefficient of at least t, the numbers
of bigrams of unit and template may differ by a factor of (2 - t) / t at most, which prunes units that fit
no template and templates that do not fit a unit; and a unit needs t / (2 - t) of its bigrams in the templates.
Only units that pass meet the templates, in an equi-join on bigrams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import text_or_empty

THRESHOLD = 0.8

# Public licence texts and notices.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "BSD-3-Clause": [
        "Released under the 3-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ],
    "BSD-2-Clause": [
        "Released under the 2-clause BSD license.",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
    ],
    "Zlib": [
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.""",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
}


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def bigrams(text: Column) -> Column:
    """Distinct hashes of neighbouring words, without case and punctuation."""

    def pairs(w):
        return F.array_distinct(F.transform(F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.xxhash64(F.get(w, i), x)))

    return F.element_at(F.transform(F.array(_words(text)), pairs), 1)


def template_table(spark: SparkSession, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """(template, license, template_n, bigram); a text of several paragraphs also gives each of them that no other licence has."""
    known = templates or TEMPLATES
    rows = []
    for name, texts in known.items():
        other = {p for n, ts in known.items() if n != name for t in ts for p in t.split("\n\n")}
        parts = dict.fromkeys(p for t in texts for p in [t, *t.split("\n\n")] if p == t or p not in other)
        rows += [(f"{name}#{i}", name, p) for i, p in enumerate(parts)]
    made = spark.createDataFrame(rows, "template string, license string, text string").withColumn("b", bigrams(F.col("text")))
    return made.select("template", "license", F.size("b").alias("template_n"), F.explode("b").alias("bigram"))


def scan(docs: DataFrame, threshold: float = THRESHOLD, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, license, template, dice): for each document and licence the best template of at least ``threshold``.

    Ties go to the smaller template name. A unit needs two words. Null and empty texts match nothing; rows that share a
    doc_id (or have none) are reported together. Other columns are ignored. Texts of any length are taken whole: the size
    bound counts distinct bigrams, so blanks and repeats don't matter. Empty in, empty out.
    """
    known = template_table(docs.sparkSession, templates).collect()  # the templates' own words: a fixed, small table
    table = docs.sparkSession.createDataFrame(known)
    sizes = [r.template_n for r in known]
    low, high = min(sizes) * threshold / (2 - threshold), max(sizes) * (2 - threshold) / threshold
    text = text_or_empty()
    units = F.array_distinct(F.concat(F.split(text, r"\n", -1), F.split(text, r"\n\s*\n", -1), F.array(text)))
    cut = docs.select("doc_id", F.explode(units).alias("unit")).where(F.length("unit") >= 3)
    cut = cut.select("doc_id", bigrams(F.col("unit")).alias("b")).where(F.size("b").between(low, high))
    shared = F.filter("b", lambda x: x.isin([int(r.bigram) for r in known]))
    cut = cut.select("doc_id", F.size("b").alias("n"), shared.alias("b")).where(F.size("b") >= F.col("n") * (threshold / (2 - threshold)))
    cut = cut.withColumn("unit", F.xxhash64("b", "n"))
    met = cut.distinct().select("doc_id", "unit", "n", F.explode("b").alias("bigram")).join(F.broadcast(table), "bigram")
    fits = (F.col("template_n") * (threshold / (2 - threshold)) <= F.col("n")) & (F.col("n") * (threshold / (2 - threshold)) <= F.col("template_n"))
    dice = met.where(fits).groupBy("doc_id", "unit", "n", "template", "license", "template_n").agg(F.count("*").alias("both"))
    dice = dice.withColumn("dice", F.round(2 * F.col("both") / (F.col("n") + F.col("template_n")), 6)).where(F.col("dice") >= threshold)
    best = F.min_by(F.struct("template", "dice"), F.struct(-F.col("dice"), "template"))
    return dice.groupBy("doc_id", "license").agg(best.alias("best")).select("doc_id", "license", "best.template", "best.dice")
