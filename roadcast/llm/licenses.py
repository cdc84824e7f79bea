"""Licence scan by canonical digests, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public licence texts and the notices that name a licence.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", 'MIT License\n\nCopyright (c) year holder\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", 'ISC License\n\nCopyright (c) year holder\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("0BSD", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
]
# Spellings of one word that licence comparison treats as equal.
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("licences", "licenses"),
    ("authorisation", "authorization"), ("organisation", "organization"), ("favour", "favor"), ("fulfil", "fulfill"),
    ("judgement", "judgment"), ("noncommercial", "non commercial"), ("percent", "per cent"), ("https", "http"),
]
COPYRIGHT_LINE = r"(^|\n)[^\n0-9a-z]*(copyright|©|\(c\))[^\n]*"


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, equal spellings, words only with single spaces between."""
    lines = F.regexp_replace(F.lower(text), F.lit(COPYRIGHT_LINE), F.lit("\n"))
    plain = F.concat(F.lit(" "), F.regexp_replace(lines, F.lit("[^\\p{L}\\p{N}]+"), F.lit("  ")), F.lit(" "))
    for spelling, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {spelling} "), F.lit(f" {usual} "))
    return F.trim(F.regexp_replace(plain, F.lit(" +"), F.lit(" ")))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(spark: SparkSession, known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """(digest, license), one row per digest; of two licences with the same canonical text the first by name."""
    rows = [F.struct(F.lit(name).alias("name"), F.lit(text).alias("text")) for name, text in known]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    return table.select(digest(F.col("text")).alias("digest"), "name").groupBy("digest").agg(F.min("name").alias("license"))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", max_broadcast: int = 1_000_000) -> DataFrame:
    """One row per document: doc_id, text_digest, license, n_notices, notices.

    ``license`` is the licence whose canonical digest equals that of the entire text, else null.  The same lookup runs over
    each line as a text of its own, because notices stand on a line inside a document: ``n_notices`` counts such lines, ``notices`` lists their
    licences, sorted, each once.  Null text counts as empty; a text without letters or digits matches nothing.  Repeated
    rows each get their result; an empty table gives none; other columns are not read.  The known digests are broadcast up to
    ``max_broadcast`` rows, else joined by a shuffle on the digest.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    side = F.broadcast(known) if known.count() <= max_broadcast else known
    row = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    whole = row.select("_row", "doc_id", digest(F.col("text")).alias("text_digest"))
    whole = whole.join(side.select(F.col("digest").alias("text_digest"), "license"), "text_digest", "left")
    lines = row.select("_row", F.explode(F.split("text", "\n")).alias("line")).filter(F.length(F.trim("line")) > 0)
    found = lines.select("_row", digest(F.col("line")).alias("digest")).join(side, "digest")
    found = found.groupBy("_row").agg(F.count(F.lit(1)).alias("n_notices"), F.array_join(F.sort_array(F.collect_set("license")), ",").alias("notices"))
    return whole.join(found, "_row", "left").select(
        "doc_id", "text_digest", "license", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices")
    )
