"""Licence scan by canonical digests of entire texts.

A text is brought to a canonical form: lower case; lines of copyright claims dropped; spellings that
mean the same made one; everything but letters and digits one space. The digest of the form is looked
up by a hash join among the digests of known licences. Looked up are the whole document and each of
its lines, so that a notice of one line is found in any document, and a licence of many lines where it
is the document. Only DataFrame functions.

Defined results: null and empty texts hold no licence; a licence that a document holds on several lines
gives a row for each; repeated rows give repeated results; an empty table gives an empty table; other
columns are left out. Known texts whose canonical form is the same count once, by the first name.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The texts of public licences and the usual notices for them.
KNOWN = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        """MIT License

        Copyright (c) the holders

        Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions:

        The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.

        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.

        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
        SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
        THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
        DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE."""
    ],
}

# The same with a title or without.
KNOWN["MIT"].append(KNOWN["MIT"][2].split("\n", 1)[1])
KNOWN["ISC"].append("ISC License\n\n" + KNOWN["ISC"][0])
KNOWN["BSD-3-Clause"] = ["Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."]
KNOWN["BSD-2-Clause"] = ["Licensed under the BSD 2-Clause License.", "Released under the BSD 2-Clause License."]
KNOWN["CC-BY-SA-4.0"] = ["Licensed under CC BY-SA 4.0."]
# Full texts, each the whole of a file.
for _file in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
    KNOWN.setdefault(_file.stem, []).append(_file.read_text("utf-8"))

# Spellings that mean the same.
SPELLINGS = [
    ("licence", "license"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("non-commercial", "noncommercial"),
    ("non-infringement", "noninfringement"),
    ("sub-license", "sublicense"),
    ("and/or", "and or"),
    ("https://", "http://"),
    ("&", " and "),
]

#: A claim of copyright at the start of a line; the notice that only refers to one does not start so.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright\s*(?:\(c\)|©|\d)|\(c\)\s|©)[^\n]*$"
_VERSION = r"\bv(?:ersion)?[ .]*(\d+)(?:\.0)*\b"
_OTHER = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The canonical form with its line breaks; lines may begin and end with a space."""
    form = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    for spelling, common in SPELLINGS:
        form = F.replace(form, F.lit(spelling), F.lit(common))
    return F.regexp_replace(F.regexp_replace(form, _VERSION, "version $1"), _OTHER, " ")


def _digest(lines: Column) -> Column:
    return F.sha2(F.trim(F.regexp_replace(lines, r"[ \n]+", " ")), 256)


def known_digests(df: DataFrame, known: dict[str, list[str]] | None = None) -> DataFrame:
    """Name and digest of the known texts: as many rows as there are texts."""
    rows = [(name, n, text) for name, texts in (known or KNOWN).items() for n, text in enumerate(texts)]
    texts = df.sparkSession.createDataFrame(rows, "_name string, _n int, _text string")
    return (
        texts.select("_name", _digest(canonical_lines(F.col("_text"))).alias("_known"))
        .groupBy("_known")
        .agg(F.min("_name").alias("licence"))
    )


def scan(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    known: dict[str, list[str]] | None = None,
) -> DataFrame:
    """A row for each licence found: key, ``line`` (from 0; null for the whole text), ``licence``."""
    lines = df.select(F.col(key), canonical_lines(F.col(text)).alias("_lines"))
    of_lines = lines.select(
        F.col(key), F.posexplode(F.split("_lines", "\n")).alias("line", "_unit")
    ).filter(F.trim("_unit") != "")
    of_texts = lines.filter(F.col("_lines").contains("\n")).select(
        F.col(key), F.lit(None).cast("int").alias("line"), F.col("_lines").alias("_unit")
    )
    units = of_lines.unionByName(of_texts).select(key, "line", _digest(F.col("_unit")).alias("_digest"))
    return units.join(
        F.broadcast(known_digests(df, known)), F.col("_digest") == F.col("_known")
    ).select(key, "line", "licence")
