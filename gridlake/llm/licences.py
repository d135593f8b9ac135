"""Licence scans by canonical digest.

A text is brought to canonical form: lower case, without copyright lines, equivalent spellings made one, and letters
and digits alone, joined by single blanks in each line. The digest of the canonical text is hash-joined to the digests
of known licences in the same form. What is looked up entire is the whole text, with and without a title line, each
block between empty lines, each run of as many blocks as a known licence has paragraphs, and each line, so a licence
counts as the document itself, as pasted blocks or as a one-line notice, but never by a part.

Units whose canonical length no known licence has are dropped before they are built and hashed; where the known
licences have more than ``MAX_SIZES`` lengths, the join alone decides. The known table is broadcast if it has at most
``MAX_BROADCAST`` rows, else joined by a shuffle. Matches are grouped per document and joined to all rows.

A few licences and notices come with the code; :func:`licence_folder` reads whole published files, of any length.

Null and empty texts have no units. Each of several rows alike gets the same result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import written

MAX_BROADCAST, MAX_SIZES = 100_000, 20_000

#: Copyright lines, but not lines of a licence that a wrap lets begin with "copyright notice" or a list with "(c)".
COPYRIGHT_LINES = (
    r"(?m)^[^\p{L}\p{N}\n(©]*(?:copyright(?![ \t]*(?:[,;.)-]|$)|[ \t]+(?:notices?|holders?|owners?|laws?|licen[cs]es?|statements?|and|or|to|in|on|is|of|interests?)\b)"
    r"|\(c\)[ \t]*(?:copyright|by\b|©|\d{4})|©|all rights reserved)[^\n]*$"
)
#: A first line that names a licence and says nothing else.
TITLE = r"^(?:the )?(?:[a-z0-9]+ ){0,4}license(?: [a-z0-9]+){0,4}$"
#: Spellings that mean the same, and the one that stands for them.
SPELLINGS = [
    (r"licenc", "licens"),
    (r"\bsub-licens", "sublicens"),
    (r"\borganisation", "organization"),
    (r"\bauthoris", "authoriz"),
    (r"\bfavour", "favor"),
    (r"\bnon-?commercial\b", "noncommercial"),
    (r"\bper cent\b", "percent"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\bhttps://", "http://"),
]

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR "
    "IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.\n"
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Published licence texts and notices, with their usual short names.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.\n" + _WARRANTY,
    ),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC_WARRANTY),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain '
        "a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
        "the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("BSD-2-Clause", _BSD_TERMS + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_TERMS + _BSD_THIRD + _BSD_WARRANTY),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\nIn jurisdictions that "
        "recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make "
        "this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law.\n"
        + _WARRANTY.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS")
        + "\nFor more information, please refer to <https://unlicense.org>",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the "
        "use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not "
        "required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may "
        "not be removed or altered from any source distribution.",
    ),
]


def canonical(text: Column) -> Column:
    """Canonical lines, joined by newlines."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINES, "")
    for found, kept in SPELLINGS:
        out = F.regexp_replace(out, found, kept)
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")
    return F.regexp_replace(F.regexp_replace(out, r"(?m)^ | $", ""), r"^\n+|\n+$", "")


def joined(lines: Column) -> Column:
    """Several canonical lines as one."""
    return F.regexp_replace(lines, r"\n+", " ")


def known_licences(spark: SparkSession, known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """(licence, size, digest, numbers of paragraphs) of distinct known texts, given as pairs or as a table (licence, text)."""
    rows = known if isinstance(known, DataFrame) else spark.createDataFrame(KNOWN if known is None else known, "licence string, text string")
    whole = rows.select("licence", canonical(F.col("text")).alias("lines")).withColumn("text", joined(F.col("lines"))).where("text <> ''")
    parts = F.array(F.size(F.split("lines", "\n+")), F.size(F.split("lines", "\n\n+")))
    return whole.groupBy(F.md5("text").alias("digest")).agg(
        F.min("licence").alias("licence"), F.min(F.char_length("text")).alias("size"), F.array_distinct(F.flatten(F.collect_set(parts))).alias("parts")
    )


def licence_folder(spark: SparkSession, path: str) -> DataFrame:
    """A known table (licence, text) of a folder of published licence files; a file's name is its licence."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"(?i)\.(?:txt|md)$", "").alias("licence"), F.col("value").alias("text"))


def licence_units(docs: DataFrame, sizes: list[int] | None, runs: tuple[int, ...] = ()) -> DataFrame:
    """Rows (doc_id, doc_key, place, unit, text) of canonical units of the given lengths (of any for None)."""
    lines = docs.select("doc_id", "doc_key", canonical(F.col("text")).alias("text"))
    fits = lambda size: F.lit(True) if sizes is None else size.isin(sizes)
    unit = lambda kind: lambda x: F.struct(F.lit(kind).alias("unit"), x.alias("text"))
    blocks, single = F.split("text", "\n\n+"), F.split("text", "\n")
    none = F.array().cast("array<struct<unit:string,text:string>>")
    units = lambda kind, texts: F.transform(F.filter(F.transform(texts, joined), lambda x: fits(F.char_length(x))), unit(kind))
    titled = F.element_at(single, 1).rlike(TITLE) & (F.size(single) > 1)
    # A run that is the whole text, or all of it but its title, is looked up as the text. Its length is known before it is built.
    length = lambda i, n: F.aggregate(F.slice(blocks, i, n), F.lit(n - 1), lambda acc, x: acc + F.char_length(x))
    whole = lambda i, n: titled & (F.element_at(blocks, 1) == F.element_at(single, 1)) & (i == 2) & (F.size(blocks) == n + 1)
    run = lambda n: F.when(
        F.size(blocks) > n,
        F.transform(F.filter(F.sequence(F.lit(1), F.size(blocks) - n + 1), lambda i: fits(length(i, n)) & ~whole(i, n)), lambda i: unit("run")(joined(F.array_join(F.slice(blocks, i, n), "\n")))),
    ).otherwise(none)
    every = F.concat(
        units("text", F.array("text")),
        F.when(titled, units("text", F.array(F.regexp_replace("text", r"^[^\n]*\n+", "")))).otherwise(none),
        *[run(n) for n in runs],
        F.when(F.size(blocks) > 1, units("block", blocks)).otherwise(none),
        F.when(F.size(single) > 1, units("line", single)).otherwise(none),
    )
    return lines.select("doc_id", "doc_key", F.posexplode(every).alias("place", "u")).select("doc_id", "doc_key", "place", "u.*")


def licence_report(docs: DataFrame, known: list[tuple[str, str]] | DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: licence of the whole text (or null), all licences found, and how many units matched."""
    table = written(known_licences(docs.sparkSession, known), "known-licences")
    n_rows, n_sizes = table.agg(F.count("*"), F.count_distinct("size")).collect()[0]
    sizes = [r["size"] for r in table.select("size").distinct().collect()] if n_sizes <= MAX_SIZES else None
    runs = tuple(sorted(r["n"] for r in table.select(F.explode("parts").alias("n")).distinct().where("n > 1").collect()))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("doc_key"), text.alias("text"))
    side = table.select("digest", "licence")
    matched = licence_units(keyed, sizes, runs).withColumn("digest", F.md5("text")).join(F.broadcast(side) if n_rows <= MAX_BROADCAST else side, "digest")
    # Rows alike have equal units at equal places.
    found = matched.select("doc_id", "doc_key", "place", "unit", "licence").distinct().groupBy(F.col("doc_id").alias("_id"), F.col("doc_key").alias("_key")).agg(
        F.max(F.when(F.col("unit") == "text", F.col("licence"))).alias("whole_licence"),
        F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("licences"),
        F.count("*").alias("n_matches"),
    )
    every = keyed.select("doc_id", "doc_key").join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("doc_key") == F.col("_key")), "left")
    return every.select("doc_id", "whole_licence", F.coalesce("licences", F.lit("")).alias("licences"), F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"))
