"""Licence scan by digests of canonical texts.

Case, punctuation, copyright lines and equivalent spellings are normalised away; the
digest of the whole normalised text is then joined to those of known licences. Every
document is looked up as a whole, and each of its lines as a text of its own, since
notices stand on lines. Only SQL functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayfact.llm.common import ids_and_texts, prepare
from wayfact.session import materialize

#: Known licence texts and notices.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies "
        'or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
)

#: Spellings that mean the same in licence texts, on normalised words.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("sublicence", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("per cent", "percent"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("https", "http"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A line that names a year or a holder; other lines that begin with the word are licence text.
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright[^\n]*([0-9]{4}|\(c\)|©|[ \t]by[ \t])|\(c\)|©|all rights reserved)[^\n]*"
COPYRIGHT_SIGNS = ("copyright", "(c)", "©", "all rights reserved")
OTHER = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # but line ends
MAX_LENGTHS = 10_000  # distinct lengths of known texts up to which other lengths are passed over
MAX_KNOWN = 500_000  # known digests up to which they are sent to the texts, some 64 MB


def plain_lines(text: Column) -> Column:
    """Lower-case words joined by one blank, without copyright lines and punctuation; line ends stay."""
    text = F.translate(text, UPPER, LOWER)
    signed = reduce(lambda a, b: a | b, (F.contains(text, F.lit(sign)) for sign in COPYRIGHT_SIGNS))
    text = F.when(signed, F.regexp_replace(text, COPYRIGHT_LINE, "$1")).otherwise(text)
    return F.regexp_replace(text, OTHER, " ")


def common_spellings(words: Column) -> Column:
    """Words joined by one blank with each spelling replaced by the common one."""
    spelled = F.concat(F.lit(" "), words, F.lit(" "))
    variants = "|".join(spelling for spelling, _ in SPELLINGS)
    replaced = spelled
    for spelling, common in SPELLINGS * 2:  # neighbours share a blank, so every other one is left to the second turn
        replaced = F.replace(replaced, F.lit(f" {spelling} "), F.lit(f" {common} "))
    return F.when(F.rlike(spelled, F.lit(f" ({variants}) ")), F.trim(replaced)).otherwise(words)


def canonical(text: Column) -> Column:
    """The words of a whole text in common spelling, joined by one blank."""
    return common_spellings(F.trim(F.regexp_replace(plain_lines(text), "[ \\n]+", " ")))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """licence, digest and length, one row per distinct normalised text."""
    rows = spark.createDataFrame(list(known), "licence string, text string")
    rows = rows.select("licence", canonical(F.col("text")).alias("text"))
    rows = rows.select("licence", F.length("text").alias("length"), F.sha2("text", 256).alias("digest"))
    return rows.groupBy("digest", "length").agg(F.min("licence").alias("licence"))


def licences(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, place and licence for every text that is a known licence.

    Place 0 is the whole document, n its n-th line; lines of a one-line document are not
    looked up again. Null, empty and punctuation-only texts are no licence. Repeated rows
    are reported for each row. ``known`` (digest, licence, and length in characters if it is
    known) may be of any size: it is stored and counted, and sent to the texts if it is
    small. Only texts of a known length are hashed. Lines that begin with "copyright" are
    left out if they name a year, a sign or "by", as lines of a holder do.
    """
    spark = prepare(docs.sparkSession)
    known = materialize(known_digests(spark) if known is None else known, "licences")
    fits = F.lit(True)
    if "length" in known.columns:
        lengths = known.select("length").distinct().limit(MAX_LENGTHS + 1).collect()
        if len(lengths) <= MAX_LENGTHS:
            fits = F.length("text").isin([r.length for r in lengths])
    known = known.select("digest", "licence")
    if known.count() <= MAX_KNOWN:
        known = F.broadcast(known)
    lines = F.split("plain", "\n")
    whole = F.struct(F.lit(0).cast("bigint").alias("place"), F.regexp_replace("plain", "[ \\n]+", " ").alias("text"))
    singles = F.transform(
        lines, lambda line, i: F.struct((i + 1).cast("bigint").alias("place"), line.alias("text"))
    )
    units = F.when(F.size(lines) > 1, F.concat(F.array(whole), singles)).otherwise(F.array(whole))
    # The explode of one value keeps the normalised text from being computed once more a use.
    plain = ids_and_texts(docs).select("doc_id", F.explode(F.array(plain_lines(F.col("text")))).alias("plain"))
    found = (
        plain.select("doc_id", F.explode(units).alias("unit"))
        .select("doc_id", "unit.place", F.explode(F.array(common_spellings(F.trim("unit.text")))).alias("text"))
        .where((F.col("text") != "") & fits)
        .select("doc_id", "place", F.sha2("text", 256).alias("digest"))
    )
    return found.join(known, "digest").select("doc_id", "place", "licence")
