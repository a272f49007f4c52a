"""Licence scans by canonical digest lookup.

A text is brought to a canonical form (ASCII lower case, copyright lines dropped, equivalent spellings replaced,
punctuation and white space folded) and its SHA-256 is looked up among the digests of known licence texts. Units are
the entire document and each entire line of it, so a notice standing as a line of its own is found as well as a
document that is a licence. A text is brought to the form once, with its line breaks; both units are cut from that. Of
lines, only those as long as a known text are hashed, since others cannot be equal to one. All of it is DataFrame code; the known texts pass through the same expressions, and their
table is broadcast because its size is that of a fixed list.

Defined results: null or empty text has no licence; a text of copyright lines alone is canonically empty and matches
nothing; a line that stands several times counts as often; very long texts are read whole; a form that stands for
several licences counts as the first in order; rows that repeat a doc_id are reported separately; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

# Short licences and notices in their published wording.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
KNOWN = (
    ("MIT", "MIT License\n" + MIT),
    ("MIT", MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "ISC License\n" + ISC),
    ("ISC", ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
#: Published texts, one file for each licence; and the headings, besides none, under which texts are found.
TEXTS = Path(__file__).parent / "license_texts"
HEADINGS = {
    "MIT": ("The MIT License (MIT)", "The MIT License", "MIT License (MIT)", "MIT"),
    "ISC": ("The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "3-Clause BSD License", "BSD-3-Clause", "BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause", "BSD License"),
}
#: What follows the terms of a licence and is often left out.
APPENDIX = re.compile(r"(END OF TERMS AND CONDITIONS).*", re.S)
#: Notices besides those of KNOWN.
LATER = tuple((f"GPL-{v}.0-or-later", n) for v in (2, 3) for n in (f"SPDX-License-Identifier: GPL-{v}.0-or-later", f"This work is licensed under the GNU General Public License, version {v} or later.", f"This work is licensed under the GNU General Public License, version {v} or any later version."))


def whole_texts() -> tuple:
    """(licence, text) of entire texts: the published ones, without appendix, with bullets for numbers, under headings."""
    bodies = [("MIT", MIT), ("ISC", ISC)]
    for f in sorted(TEXTS.glob("*.txt")):
        body = f.read_text("utf-8")
        bodies += [(f.stem, body), (f.stem, APPENDIX.sub(r"\1", body)), (f.stem, APPENDIX.sub("", body))]
        if f.stem.startswith("BSD"):
            bodies.append((f.stem, re.sub(r"(?m)^[0-9]\. ", "* ", body)))
    return tuple(dict.fromkeys((i, f"{h}\n{b}") for i, b in bodies for h in ("", *HEADINGS.get(i, ()))))


# Spellings that count as equal, canonical one last.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("noninfringement", "non infringement"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("acknowledgement", "acknowledgment"),
    ("v", "version"),
    ("https", "http"),
)
COPYRIGHT_LINE = r"^[^a-z0-9\n]*(?:copyright|\(c\)|©)[^\n]*(?:[0-9]{4}|all rights reserved)[^\n]*$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical_lines(text: Column) -> Column:
    """The words of a text (ASCII letters, digits and non-ASCII characters) in canonical form, line by line. Two spaces
    stand between words, one for each, so that equal words side by side are replaced alike."""
    # lines end at line feeds only (d), as elsewhere
    out = F.regexp_replace(F.translate(text, UPPER, LOWER), f"(?md){COPYRIGHT_LINE}", " ")
    out = F.regexp_replace(out, r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f]+", "  ")
    out = F.concat(F.lit(" "), F.replace(out, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(f" {a} "), F.lit(f" {b} "))
    return out


def canonical(lines: Column) -> Column:
    """Canonical lines as one text with a space between words."""
    return F.trim(F.regexp_replace(lines, "[ \n]+", " "))


def _digest(form: Column) -> Column:
    """SHA-256 of a canonical form; null if that is empty."""
    return F.when(form != "", F.sha2(form, 256))


def known_licenses(spark: SparkSession, known: tuple = KNOWN) -> DataFrame:
    """(digest, license_id, n: characters), one row per digest; a fixed list of texts, so its size is bounded."""
    forms = spark.createDataFrame(list(known), "license_id string, body string").select("license_id", canonical(canonical_lines(F.col("body"))).alias("form"))
    return forms.where("form <> ''").groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license_id").alias("license_id"), F.first(F.length("form")).alias("n"))


def license_scan(docs: DataFrame, text: str = "text", key: str = "doc_id", known: tuple | None = None) -> DataFrame:
    """Per input row: doc_id, text_digest (canonical, null if empty), license_id (of the whole text, else null),
    line_licenses (licences of whole lines, sorted, comma-joined, '' if none), n_line_hits (lines that match)."""
    table = known_licenses(docs.sparkSession, KNOWN + LATER + whole_texts() if known is None else known)
    lengths = sorted(r["n"] for r in table.select("n").distinct().collect())
    table = F.broadcast(table.drop("n"))
    base = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("doc_id"), canonical_lines(F.col(text)).alias("lines"))
    base = base.select("rid", "doc_id", canonical(F.col("lines")).alias("form"), F.transform(F.split("lines", "\n"), lambda x: F.trim(F.replace(x, F.lit("  "), F.lit(" ")))).alias("lines"))
    alike = F.filter("lines", lambda x: F.length(x).isin(lengths))
    base = written(base.select("rid", "doc_id", _digest(F.col("form")).alias("text_digest"), F.transform(alike, lambda x: F.sha2(x, 256)).alias("lines")), "license-digests")
    whole = base.drop("lines").join(table.withColumnRenamed("digest", "text_digest"), "text_digest", "left")
    lines = base.select("rid", F.explode("lines").alias("digest")).join(table, "digest")
    hits = lines.groupBy("rid").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("line_licenses"), F.count(F.lit(1)).alias("n_line_hits"))
    return whole.join(hits, "rid", "left").select("doc_id", "text_digest", "license_id", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"), F.coalesce("n_line_hits", F.lit(0)).cast("bigint").alias("n_line_hits"))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def license_sql(known: tuple = KNOWN) -> str:
    """The same result in DuckDB SQL, for the known texts given (by default the short ones only)."""

    def form(x: str) -> str:
        out = f"regexp_replace(translate({x}, '{UPPER}', '{LOWER}'), {_sql_text('(?m)' + COPYRIGHT_LINE)}, ' ', 'g')"
        out = rf"' ' || regexp_replace({out}, '[\x00-\x2f\x3a-\x60\x7b-\x7f]+', '  ', 'g') || ' '"
        for a, b in SPELLINGS:
            out = f"replace({out}, ' {a} ', ' {b} ')"
        return f"trim(replace({out}, '  ', ' '))"

    rows = ", ".join(f"({_sql_text(i)}, {_sql_text(b)})" for i, b in known)
    dig = lambda x: f"CASE WHEN {form(x)} <> '' THEN sha256({form(x)}) END"
    return f"""WITH known AS (SELECT {dig('body')} AS digest, min(license_id) AS license_id FROM (VALUES {rows}) t(license_id, body) GROUP BY 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
lines AS (SELECT rid, {dig('line')} AS digest FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)),
hits AS (SELECT rid, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS line_licenses, count(*) AS n_line_hits FROM lines JOIN known USING (digest) GROUP BY rid)
SELECT d.doc_id, {dig('d.text')} AS text_digest, k.license_id, coalesce(h.line_licenses, '') AS line_licenses, coalesce(h.n_line_hits, 0) AS n_line_hits
FROM d LEFT JOIN known k ON k.digest = {dig('d.text')} LEFT JOIN hits h USING (rid)"""
