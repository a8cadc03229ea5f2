"""Operator 6, license scans, in DataFrame functions only.

Texts and templates are cut to overlapping windows of eight words. A window's shingles (three words) are hashed, and each
of twelve bands keeps the hash that is least after flipping the band's bits: a MinHash with one row a band, so windows
with similarity j meet in some band with probability 1 - (1 - j)^12. Windows of a text start every fourth word, so one holds any five
words in a row (``stride`` is at most window - 2); a template has a window at each word. A template of five words, the shortest allowed, has j = 1/2 there and is retrieved
with probability 0.9997; where eleven words of a longer one stand unchanged, j = 1. Each band maps its values to the
templates that have them, as literals: retrieval is an expression on each row, without a join or a shuffle, and gives each row the
few templates to verify. These are held against the row by their shingles: first by their hashes, all at once, then, stretch by
stretch, by their words.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.common import computed, table

_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
    "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_TWO_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
#: Short license notices, by SPDX identifier where there is one, then the texts of licenses and the notices that others ask for.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-2-Clause-text": _TWO_CONDITIONS + _DISCLAIMER,
    "BSD-3-Clause-text": _TWO_CONDITIONS + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. " + _DISCLAIMER,
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and "
    'this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
    "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of "
    "this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
    "to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software "
    "in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must "
    "not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0-text": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license "
    '(the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to '
    "whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, "
    "this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such "
    "copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    "Unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
    "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author "
    "or authors of this software dedicate any and all copyright interest in the software to the public domain.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the '
    "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "GPL-3.0-or-later-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
    "Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
    "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
    "https://mozilla.org/MPL/2.0/.",
}
TOKEN = r"[0-9a-z]+(?:[.-][0-9a-z]+)*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW, STRIDE, BANDS, CONTAINED = 8, 4, 12, 0.9


def tokens(text: str) -> list[str]:
    return re.findall(TOKEN, text.translate(str.maketrans(UPPER, LOWER)))


def shingles(words: list[str]) -> list[str]:
    return [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]


def _flips(bands: int) -> list[int]:
    """Bits that each band flips: multiples of an odd constant, as signed 64-bit numbers."""
    out = [(0x9E3779B97F4A7C15 * (i + 1)) % (1 << 64) for i in range(bands)]
    return [x - (1 << 64) if x >> 63 else x for x in out]


def triples(words, join):
    """``join`` of every three consecutive entries of an array column, two at a time."""
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, 1, F.greatest(n - 2, F.lit(0))), F.slice(words, 2, F.greatest(n - 2, F.lit(0))), join)
    return F.zip_with(pairs, F.slice(words, 3, F.greatest(n - 2, F.lit(0))), join)


def _longs(values):
    return F.split(F.lit(" ".join(map(str, values))), " ").cast("array<bigint>")


def template_hashes(spark: SparkSession, templates: dict[str, str]) -> list[list[int]]:
    """Hashes of the shingles of each template in order, worked out by Spark's own hash in one row."""
    h = [triples(F.split(F.lit(" ".join(tokens(t))), " "), lambda x, y: F.xxhash64(x, y)).alias(f"t{i}") for i, t in enumerate(templates.values())]
    return [list(x) for x in spark.range(1).select(*h).first()]


def template_bands(hashes: list[list[int]], window: int, bands: int) -> list[dict[int, set[int]]]:
    """For each band: least hash of a window -> numbers of the templates that have such a window."""
    out: list[dict[int, set[int]]] = [{} for _ in range(bands)]
    for number, h in enumerate(hashes):
        for i in range(max(1, len(h) - (window - 2) + 1)):
            for found, bits in zip(out, _flips(bands), strict=True):
                found.setdefault(min(x ^ bits for x in h[i : i + window - 2]), set()).add(number)
    return out


def find_licenses(docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES, window: int = WINDOW, stride: int = STRIDE, bands: int = BANDS, contained: float = CONTAINED) -> DataFrame:
    """doc_id, license, contained (share of the template's shingles, double), first_word (long): one row for each template that a row of ``docs`` holds.

    Case (of A-Z) and punctuation don't count; words are runs of a-z and 0-9 with dots and hyphens inside. A row holds a template where a stretch of
    shingles, twice as many as the template has words, that begins with one of the template's holds at least ``contained`` of its distinct shingles.
    The largest share counts; of equal ones the stretch whose last shingle of the template is nearest to its first; then the
    first. Shingles that stand scattered over a stretch, none beside the other, can escape the bands. Null and
    empty texts and those of two words hold none. Each row is scanned by itself, without a shuffle: repeated rows give repeated results, a null doc_id
    stays null, other columns are not read. Templates need five words or more.
    """
    hashes = template_hashes(docs.sparkSession, templates)
    found = template_bands(hashes, window, bands)
    maps = [F.map_from_arrays(_longs(m), F.split(F.lit(",".join(" ".join(map(str, sorted(v))) for v in m.values())), ",")) for m in found]
    a = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.regexp_extract_all(F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER), F.lit(f"({TOKEN})"), F.lit(1)).alias("w"))
    a = a.withColumn("h", triples(F.col("w"), lambda x, y: F.xxhash64(x, y)))
    # a window whose least hash is a template's holds that template's shingle: only windows around such are worth their bands
    every = sorted({x for h in hashes for x in h})
    a = a.select("doc_id", "w", "h", F.array_compact(F.transform("h", lambda x, i: F.when(x.isin(every), i))).alias("hits"))

    def around(i):
        return F.sequence(F.greatest(F.ceil((i - (window - 3)) / stride).cast("int") * stride, F.lit(0)), i - i % stride, F.lit(stride))

    def retrieved(at):
        here = [F.get("h", at + i) for i in range(window - 2)]
        least = [F.least(*[x.bitwiseXOR(F.lit(bits)) for x in here]) for bits in _flips(bands)]
        return F.filter(F.split(F.concat_ws(" ", *[F.try_element_at(m, x) for x, m in zip(least, maps, strict=True)]), " "), lambda x: x != "")

    # one row for each template that a row retrieves; outer, as Spark would push what it infers from an inner one below the hashes and work them out again
    numbers = F.array_distinct(F.flatten(F.transform(F.array_distinct(F.flatten(F.transform("hits", around))), retrieved)))
    a = a.select("doc_id", "w", "h", F.explode_outer(numbers.cast("array<int>")).alias("number")).where("number is not null")
    known = []
    for (name, t), h in zip(templates.items(), hashes, strict=True):
        own = sorted(set(shingles(tokens(t))))
        need = next(k for k in range(len(own) + 1) if k / len(own) >= contained)
        known.append(F.struct(F.lit(name).alias("license"), F.split(F.lit(",".join(own)), ",").alias("own"), _longs(sorted(set(h))).alias("hashes"), F.lit(max(need, 1)).alias("need"), F.lit(2 * len(tokens(t))).alias("span")))
    a = a.withColumn("t", F.get(F.array(*known), F.col("number"))).drop("number")
    a = a.where(F.size(F.array_intersect("t.hashes", "h")) >= F.col("t.need"))
    at = F.filter(F.sequence(F.lit(0), F.size("h") - 1), lambda p: F.array_contains("t.hashes", F.get("h", p)))
    a = a.select("doc_id", "w", "t", at.alias("at"))
    need, span = F.col("t.need"), F.col("t.span")
    first = F.filter(F.sequence(F.lit(0), F.greatest(F.size("at") - need, F.lit(0))), lambda k: F.get("at", k + need - 1) < F.get("at", k) + span)

    def stretch(k):
        p = F.get("at", k)
        return F.filter(F.slice("at", k + 1, span), lambda q: q < p + span)

    def judged(s):
        held = F.array_intersect("t.own", F.transform(s, lambda q: F.concat_ws(" ", F.get("w", q), F.get("w", q + 1), F.get("w", q + 2))))
        return F.struct((-F.size(held)).alias("k"), (F.get(s, F.size(s) - 1) - F.get(s, F.lit(0))).alias("long"), F.get(s, F.lit(0)).alias("p"))

    best = F.array_min(F.transform(F.transform(first, stretch), judged))
    a = computed(a.select("doc_id", F.col("t.license").alias("license"), F.size("t.own").alias("n"), best.alias("b")))
    a = a.select("doc_id", "license", (-F.col("b.k") / F.col("n")).alias("contained"), F.col("b.p").cast("long").alias("first_word"))
    return a.where(F.col("contained") >= contained)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
