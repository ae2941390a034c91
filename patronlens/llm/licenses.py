"""Licence scan by canonical digests.

A text's canonical form has A-Z in lower case, equivalent spellings made one, everything but letters and digits
as single spaces, and no lines that begin like a copyright line. Its SHA-256 identifies the text.

Licences are looked up by another form, which does not depend on where lines break: of its lines only real copyright
lines are left out (`STATEMENT`: with a sign, a (c) or a year after the word, or "all rights reserved" alone), and
spellings that a line break may part are made one after joining. The digest of this form is joined to those of the known
licences, with and without their title lines. The whole text is looked up, and so is each of its lines, since
licence notices stand as lines of their own.

Defined cases: a null text is empty; the empty canonical form has a digest and no licence;
repeated rows get equal results; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.workspace import small_table

# Equivalent spellings, each to the one that is kept.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("per cent", "percent"),
    ("https://", "http://"),
)

# The first words of a copyright line, after canonical form.
COPYRIGHT = r"^(copyright|c|\x{00a9}|all rights reserved)( |$)"

# A copyright line proper, after canonical form.
YEAR = r"(19|20)\d\d"
STATEMENT = (
    rf"^(\x{{00a9}}.*|copyright( .*)? (\x{{00a9}}.*|{YEAR}( .*)?)|copyright\x{{00a9}}.*|copyright (c|year|yyyy)( .*)?"
    rf"|c( .*)? {YEAR}( .*)?|c copyright( .*)?|all rights reserved)$"
)

# Title lines that copies of a known licence begin with.
TITLES = (
    ("MIT", ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT License (Expat)", "Expat License")),
    ("ISC", ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)")),
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)", "0BSD License")),
    ("Zlib", ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "The zlib/libpng License (Zlib)")),
)

# Known licences and notices.
KNOWN = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution."""),
    ("MIT-notice", "Released under the MIT License."),
    ("MIT-notice", "Licensed under the MIT License."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
)


def _plain_lines(text: Column) -> Column:
    """Lines in canonical form, without blank ones."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for other, kept in SPELLINGS:
        lowered = F.replace(lowered, F.lit(other), F.lit(kept))
    # Everything but letters, digits, the copyright sign and line ends.
    spaced = F.regexp_replace(lowered, r"[^\p{L}\p{N}\n\x{00a9}]+", " ")
    lines = F.transform(F.split(spaced, "\n", -1), lambda line: F.trim(line))
    return F.filter(lines, lambda line: line != "")


def _canonical(plain: Column) -> Column:
    return F.filter(plain, lambda line: ~line.rlike(COPYRIGHT))


def canonical_lines(text: Column) -> Column:
    """Lines in canonical form, without blank ones and lines that begin like a copyright line."""
    return _canonical(_plain_lines(text))


def _joined(plain: Column) -> Column:
    """Lines without copyright lines as one text that does not depend on where they broke."""
    text = F.array_join(F.filter(plain, lambda line: ~line.rlike(STATEMENT)), " ")
    for other, kept in SPELLINGS:
        words = " ".join(re.findall(r"\w+", other))
        if " " in words:
            text = F.replace(text, F.lit(words), F.lit(kept))
    return text


def _known_texts(spark: SparkSession, known) -> DataFrame:
    texts = small_table(spark, [list(k) for k in known], "license string, text string")
    return texts.select("license", _joined(_plain_lines(F.col("text"))).alias("form"))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """digest and license of the known texts; smallest name where two have one form."""
    digests = _known_texts(spark, known).select(F.sha2("form", 256).alias("digest"), "license")
    return digests.groupBy("digest").agg(F.min("license").alias("license"))


def _titled(known) -> list[tuple[str, str]]:
    """The known texts, and each again under its titles."""
    titles = dict(TITLES)
    return [*known, *((name, f"{title}\n{text}") for name, text in known for title in titles.get(name, ()))]


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", known=KNOWN) -> DataFrame:
    """One row per document: key, canonical_sha256, license of the whole text, notices (names, comma-joined) and n_notices, lines that are one."""
    spark = docs.sparkSession
    names = known_digests(spark, known)
    titled = known_digests(spark, _titled(known)).withColumnRenamed("digest", "_form")
    longest = max((len(words) for _, words in _titled(known)), default=0)
    plain = docs.select(F.col(key).alias("_key"), _plain_lines(F.col(text)).alias("_plain"))
    lines = plain.select("_key", _canonical(F.col("_plain")).alias("_lines"), _joined(F.col("_plain")).alias("_joined"))
    # A form is never longer than its text, and one longer than all known texts needs no digest.
    form = F.when(F.length("_joined") <= longest, F.sha2("_joined", 256)).otherwise(F.lit("")).alias("_form")
    whole = lines.select("_key", F.sha2(F.array_join("_lines", " "), 256).alias("digest"), form)
    alone = lines.select("_key", F.sha2(F.array_join("_lines", " "), 256).alias("whole"), form.alias("_f2"), F.explode(F.transform("_lines", lambda x: F.sha2(x, 256))).alias("digest"))
    # The table of known digests is a parameter of a few rows.
    hits = alone.join(F.broadcast(names), "digest")
    notices = hits.groupBy("_key", "whole", "_f2").agg(
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("notices"), F.count("*").alias("_n")
    ).select(F.col("_key").alias("_k2"), F.col("whole").alias("_w2"), "_f2", "notices", "_n")
    copies = whole.groupBy("_key", "digest", "_form").agg(F.count("*").alias("_rows"))
    per_row = copies.join(F.broadcast(titled), "_form", "left")
    same = per_row["_key"].eqNullSafe(notices["_k2"]) & (per_row["digest"] == notices["_w2"]) & (per_row["_form"] == notices["_f2"])
    joined = per_row.join(notices, same, "left")
    one = joined.select(
        F.col("_key").alias(key),
        F.col("digest").alias("canonical_sha256"),
        "license",
        F.coalesce("notices", F.lit("")).alias("notices"),
        F.floor(F.coalesce(F.col("_n") / F.col("_rows"), F.lit(0))).cast("bigint").alias("n_notices"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_rows"))).alias("_copy"),
    )
    return one.drop("_copy")
