"""Licence scan: texts reduced to a canonical form and looked up among the digests of known licences.

The canonical form leaves out copyright notices and a licence's title, takes equivalent spellings for one, and drops case,
punctuation and the amount of white space. Whole texts are looked up, and, as notices stand inside longer texts, every line as a text of its
own. The lookup is a hash join on the digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import license_texts

# Licence notices and short licence texts by name. Each is one known text.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS "
        "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
        "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not "
        "be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
        "the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must "
        "not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
)
# Spellings taken for the second one of each pair.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("version", "v"),
    ("copyright owner", "copyright holder"),
)
# Words that follow "copyright" and "(c)" inside licence texts, where a wrap can put them first on a line.
AFTER_COPYRIGHT = (
    "also|and|are|disclaimers?|doctrines?|holders?|if|in|interests?|is|laws?|licen[cs]es?|like|lines?|notices?|of|on|or|owners?|ownership|"
    "patents?|permissions?|resulting|statements?|the (?:software|library|program)|those|to|treaty|treaties"
)
AFTER_MARK = "all|representations|the licen[cs]es|under|you"
#: A copyright notice, in lower case: the word or mark and then a year or holder; d: only \n ends a line.
NOTICE = (
    r"(?md)^[^a-z0-9\n]*(?:"
    rf"copyright\b[^\p{{L}}\p{{N}}\n]*+(?!(?:{AFTER_COPYRIGHT})\b)[\p{{L}}\p{{N}}][^\n]*|"
    rf"(?:\(c\)|©)[^\p{{L}}\p{{N}}\n]*+(?!(?:{AFTER_MARK})\b)[\p{{L}}\p{{N}}][^\n]*|"
    r"all rights reserved[^a-z0-9\n]*)$"
)
#: Titles that may stand before a licence text, in canonical form.
TITLE = (
    r"^(?:the )?(?:unlicense|(?:mit|expat|isc|zlib|zlib libpng|bsd|bsd [23] clause(?: simplified| new or revised| new| revised)?|"
    r"[23] clause bsd|(?:simplified|new|modified|revised) bsd) license(?: mit| isc| zlib| bsd [23] clause)?) "
)
OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The canonical form: words parted by one space; empty for null."""
    form = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOTICE, " ")
    form = F.concat(F.lit(" "), F.trim(F.regexp_replace(form, OTHER, " ")), F.lit(" "))
    for a, b in SPELLINGS:
        form = F.replace(form, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.regexp_replace(F.trim(form), TITLE, "")


def _canonical_sql(text: str) -> str:
    """The canonical form in DuckDB, whose patterns know no lookahead: lines are told to be notices one by one."""
    front = "^[^a-z0-9]*"
    marks = (("copyright\\b", AFTER_COPYRIGHT), ("(\\(c\\)|©)", AFTER_MARK))
    notice = " OR ".join(f"(regexp_matches(l, '{front}{m}[^\\p{{L}}\\p{{N}}]*[\\p{{L}}\\p{{N}}]') AND NOT regexp_matches(l, '{front}{m}[^\\p{{L}}\\p{{N}}]*({after})\\b'))" for m, after in marks)
    notice += f" OR regexp_matches(l, '{front}all rights reserved[^a-z0-9]*$')"
    lines = f"array_to_string(list_transform(string_split(lower(coalesce({text}, '')), chr(10)), lambda l: CASE WHEN {notice} THEN ' ' ELSE l END), chr(10))"
    form = f"' ' || trim(regexp_replace({lines}, '{OTHER}', ' ', 'g')) || ' '"
    for a, b in SPELLINGS:
        form = f"replace({form}, ' {a} ', ' {b} ')"
    return f"regexp_replace(trim({form}), '{TITLE}', '')"


#: Known texts up to this many are broadcast (under 10 MB).
BROADCAST_ROWS = 50_000
#: Texts that are held by their digest alone have a canonical form of at least this many characters.
LONG = 1_000


def known_digests(
    spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN + license_texts.TEXTS, digests: tuple[tuple[str, str], ...] = license_texts.DIGESTS
) -> DataFrame:
    """``(digest, license, length)`` of the known texts, and the digests of those that are held without their text, which
    have at least :data:`LONG` characters and a null length."""
    texts = spark.createDataFrame(list(known), "license string, text string").withColumn("form", canonical(F.col("text")))
    texts = texts.select(F.sha2("form", 256).alias("digest"), "license", F.length("form").alias("length"))
    return texts.unionByName(spark.createDataFrame([(*d, None) for d in digests], "license string, digest string, length int")).distinct()


def scan(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_lines, whole, licenses``: matching lines, licences of the whole text, all names; lists are sorted.

    Every row gives one row. A null or empty text, and one whose canonical form is empty, matches nothing. Equal lines
    count as often as they stand there; a line or text that several known texts share names each of them. A text of one
    line is both a line and a whole text. Repeated rows get equal answers, other columns are not looked at.
    """
    mark = F.xxhash64(text)
    table = known if known.count() > BROADCAST_ROWS else F.broadcast(known)
    lengths = sorted({r["length"] for r in known.where(F.col("length") < LONG).select("length").distinct().collect()})  # fewer than LONG
    rows = docs.select(F.col(key).alias("id"), mark.alias("mark"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    unit = lambda t, at: F.struct(at.alias("at"), canonical(t).alias("form"))
    every = F.concat(F.array(unit(F.col("text"), F.lit(0))), F.transform(F.split("text", "\n"), lambda t, i: unit(t, i + 1)))
    likely = lambda u: F.length(u["form"]).isin(lengths) | (F.length(u["form"]) >= LONG)  # noqa: E731  (others need no digest)
    some = rows.select("id", "mark", F.explode_outer(F.filter(every, likely)).alias("u")).where("u is not null")
    units = some.select("id", "mark", "u.at", F.sha2("u.form", 256).alias("digest"))
    met = units.join(table, "digest").select("id", "mark", "at", "license").distinct()  # repeated rows have the same units
    of_row = met.groupBy("id", "mark").agg(
        F.count_distinct(F.when(F.col("at") > 0, F.col("at"))).alias("n_lines"),
        F.sort_array(F.collect_set(F.when(F.col("at") == 0, F.col("license")))).alias("whole"),
        F.sort_array(F.collect_set("license")).alias("licenses"),
    )
    none = F.array().cast("array<string>")
    back = docs.select(F.col(key), mark.alias("_mark")).join(of_row, F.col(key).eqNullSafe(F.col("id")) & (F.col("_mark") == F.col("mark")), "left")
    return back.select(key, F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"), F.coalesce("whole", none).alias("whole"), F.coalesce("licenses", none).alias("licenses"))


def scan_sql() -> str:
    """The same over the table ``documents`` in DuckDB."""
    quoted = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN + license_texts.TEXTS)
    held = ", ".join(f"('{digest}', '{name}')" for name, digest in license_texts.DIGESTS)
    return f"""
        WITH known AS (SELECT DISTINCT sha256({_canonical_sql("text")}) AS digest, license FROM (VALUES {quoted}) AS k(license, text)
            UNION SELECT digest, license FROM (VALUES {held}) AS h(digest, license)),
        units AS (
            SELECT doc_id, 0 AS place, text AS unit FROM documents WHERE text IS NOT NULL
            UNION ALL
            SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)), unnest(string_split(text, chr(10))) FROM documents WHERE text IS NOT NULL
        ),
        met AS (SELECT doc_id, place, license FROM units JOIN known ON sha256({_canonical_sql("unit")}) = digest),
        of_doc AS (
            SELECT doc_id, count(DISTINCT place) FILTER (place > 0) AS n_lines,
                   string_agg(DISTINCT license, ',' ORDER BY license) FILTER (place = 0) AS whole,
                   string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
            FROM met GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(whole, '') AS whole, coalesce(licenses, '') AS licenses
        FROM documents d LEFT JOIN of_doc o ON d.doc_id = o.doc_id
    """
