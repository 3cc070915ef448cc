"""License scans by canonical digests, with DataFrame operators only.

A text is brought into canonical form: lower case, every run of punctuation
and white space one separator, equivalent spellings made equal, and copyright
notices dropped.  A notice is a line that begins with the word and the sign, or
with either and a year or a placeholder.  Where it ends can't be told once a
text has been filled again, so there are three forms: without such lines,
without the paragraphs that begin with one, and with all of them.  Entire
texts are compared by digest: the whole document in its three forms, and each
of its lines, are looked up among the digests of known licence texts and
notices, which go through the same forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm.common import join_grouped, stage
from stellate.llm.license_texts import more_licenses

# fixed values: licence texts and one-line notices, as their owners publish them
PERMISSION_MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
PERMISSION_ISC = """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
LICENSES = (
    *more_licenses(),
    *[("MIT", PERMISSION_MIT.replace("MIT License", title, 1)) for title in ("", "The MIT License", "The MIT License (MIT)")],
    *[("ISC", PERMISSION_ISC.replace("ISC License", title, 1)) for title in ("", "The ISC License", "ISC License (ISC)")],
    *[("0BSD", PERMISSION_ISC.replace("ISC License", title, 1).replace(
        ", provided that the above copyright notice and this permission notice appear in all copies", ""))
      for title in ("", "BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License")],
    ("MIT", PERMISSION_MIT),
    ("ISC", PERMISSION_ISC),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("All-Rights-Reserved", "All rights reserved."),
)
#: equivalent spellings, each a whole word
SPELLINGS = (("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("sublicence", "sublicense"),
             ("organisation", "organization"), ("authorised", "authorized"), ("recognised", "recognized"),
             ("favour", "favor"), ("judgement", "judgment"), ("noncommercial", "non  commercial"),
             ("merchantibility", "merchantability"), ("whilst", "while"))
#: a line that begins with a copyright notice
NOTICE = (r"(?m)^[^\p{L}\p{N}\n]*((copyright|©)[^\p{L}\p{N}\n]*(\(c\)|©)|(copyright|\(c\)|©)[^\p{L}\p{N}\n]*(\p{N}|[<\[{]\p{L}))[^\n]*$")
SEPARATORS = r"[^\p{L}\p{N}\n]+"
#: a letter that marks such lines (in texts it counts as the plain one)
MARK, PLAIN = "ꙮ", "о"
KNOWN_ROWS = 1 << 18  # digests that are broadcast; more are joined by an exchange


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text, words parted by two spaces; empty ones stay, notices begin with ``MARK``."""
    low = F.translate(F.lower(F.coalesce(text, F.lit(""))), MARK, PLAIN)
    flat = F.regexp_replace(F.regexp_replace(low, NOTICE, f"{MARK} $0"), SEPARATORS, "  ")
    # two spaces around every word, so that each replacement has its own
    joined = F.concat(F.lit("  "), F.replace(flat, F.lit("\n"), F.lit("  \n  ")), F.lit("  "))
    for a, b in SPELLINGS:
        joined = F.replace(joined, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.transform(F.split(joined, "\n", -1), lambda x: F.trim(x))


def _filled(lines: Column) -> Column:
    return F.filter(lines, lambda x: x != "")


def _unmarked(lines: Column) -> Column:
    return _filled(F.transform(lines, lambda x: F.when(x.startswith(MARK), F.trim(F.substring(x, 2, 1 << 30))).otherwise(x)))


def without_notices(lines: Column) -> Column:
    """The lines that are neither empty nor notices."""
    return F.filter(lines, lambda x: (x != "") & ~x.startswith(MARK))


def without_paragraphs(lines: Column) -> Column:
    """The lines of the paragraphs that don't begin with a notice."""
    paragraphs = F.transform(F.split(F.array_join(lines, "\n"), "\n\n+", -1), lambda x: F.ltrim(x, F.lit("\n")))
    kept = F.array_join(F.filter(paragraphs, lambda x: ~x.startswith(MARK)), "\n")
    return _unmarked(F.split(kept, "\n", -1))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _whole(lines: Column) -> Column:
    return digest(F.array_join(lines, "  "))


def _forms(lines: Column) -> list[Column]:
    return [without_notices(lines), without_paragraphs(lines), _unmarked(lines)]


def known_licenses(spark: SparkSession, licenses=LICENSES) -> DataFrame:
    return spark.createDataFrame(list(licenses), "license string, text string")


def scan_licenses(docs: DataFrame, licenses: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``text_digest`` (of the whole
    canonical text without notice lines), ``license`` (whole text known in one
    of its forms: its licence, the least name if several; the form without
    notice lines comes first, then that without paragraphs, then the whole;
    else null), ``n_notices`` (lines that are a known text) and ``notices``
    (their distinct licences, sorted, comma-joined).

    ``licenses`` has ``license, text``.  Null and empty texts, and texts of
    notice lines and punctuation alone, have the digest of the empty text;
    repeated rows and a null id are kept; an empty table gives no rows; other
    columns are ignored; a known form that is empty is never found.
    """
    lines = licenses.select("license", canonical_lines(F.col("text").cast("string")).alias("lines"))
    units = F.explode(F.array(*[F.struct(_whole(f).alias("unit"), F.size(f).alias("n"), F.length(F.array_join(f, "  ")).alias("size"))
                                for f in _forms(F.col("lines"))]))
    known = stage(lines.select("license", units.alias("u")).select("license", "u.*").filter("n > 0")
                  .groupBy("unit").agg(F.min("license").alias("license"), F.min("n").alias("n"), F.min("size").alias("size")), "licenses")
    sizes = [r["size"] for r in known.filter("n = 1").select("size").distinct().collect()]  # lengths of known lines
    few = known.count() <= KNOWN_ROWS
    known = known.select("unit", "license")

    shown = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), canonical_lines(F.col(text_col).cast("string")).alias("lines"))
    # only a line as long as some known line can be one
    near = F.filter(without_notices(F.col("lines")), lambda x: F.array_contains(F.array(*[F.lit(n) for n in sizes]), F.length(x))) \
        if sizes else F.array().cast("array<string>")
    whole = [_whole(f).alias(f"form_{i}") for i, f in enumerate(_forms(F.col("lines")))]
    # the canonical form is made once, and staged as digests
    rows = stage(shown.select("doc_id", F.monotonically_increasing_id().alias("nth"), *whole,
                              F.transform(near, digest).alias("near")), "license-digests")

    def found(some: DataFrame) -> DataFrame:
        return some.join(F.broadcast(known), "unit") if few else join_grouped(some, known, ["unit"])

    forms = found(rows.select("nth", F.posexplode(F.array("form_0", "form_1", "form_2")).alias("form", "unit")))
    named = forms.groupBy("nth").agg(F.min(F.struct("form", "license")).alias("first"))
    notices = (found(rows.select("nth", F.explode("near").alias("unit"))).groupBy("nth")
               .agg(F.count("*").alias("n_notices"), F.array_sort(F.collect_set("license")).alias("found")))
    return (rows.select("doc_id", "nth", F.col("form_0").alias("text_digest")).join(named, "nth", "left").join(notices, "nth", "left")
            .select("doc_id", "text_digest", F.col("first.license").alias("license"), F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"),
                    F.coalesce(F.array_join("found", ","), F.lit("")).alias("notices")))
