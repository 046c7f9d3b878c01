"""Known licence texts in documents, by digests of a canonical form."""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import license_catalogue
from ledgerline.llm.common import table, written
from ledgerline.operators.relational import join_lookup

# Fixed values: (name, text) of short public licences and notices. Texts as published; the
# canonical form drops copyright lines, so names and years in them do not matter. The catalogue
# of all other texts and notices is put before them below.
_SHORT = (
    ("MIT", """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT notice", "Released under the MIT License."),
    ("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0 notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0 notice", "Licensed under CC BY-NC 4.0."),
)

# Equivalent spellings, as words of the canonical form: licences differ in them without meaning it.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("merchantibility", "merchantability"),
    ("per cent", "percent"), ("analogue", "analog"), ("favour", "favor"), ("honour", "honor"), ("organisation", "organization"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("https", "http"),
)
# Lines of the canonical form that only state a copyright or reserve all rights.
DROPPED = ("copyright", "all rights reserved")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SIGN = "\\(c\\)|©"
_BETWEEN = "[^\\p{L}\\p{N}\n]+"
_CASES, _WORDLESS = str.maketrans(_UPPER, _LOWER), re.compile(r"(?:[^\w\n]|_)+")


def _plain(text: str) -> str:
    """The canonical form outside Spark; it only tells which entries of the catalogue repeat another."""
    now = _WORDLESS.sub(" ", re.sub(_SIGN, " copyright ", text.translate(_CASES)))
    for old, new in SPELLINGS:
        if old in now:
            now = re.sub(f"(^|[ \n]){old}([ \n]|$)", rf"\g<1>{new}\g<2>", now)
    lines = (line.strip() for line in now.split("\n"))
    return " ".join(x for x in lines if x and not x.startswith("copyright ") and x not in DROPPED)


@cache
def catalogue() -> tuple[tuple[str, str], ...]:
    """(name, text): one entry per licence and canonical form; those above come last and stay as they are.

    Made when it is first asked for.
    """
    rows = [*_SHORT, *license_catalogue.texts(), *((f"{name} notice", text) for name, text in license_catalogue.notices())]
    distinct: dict[tuple[str, str], tuple[str, str]] = {}
    for name, text in rows:
        distinct.setdefault((name, _plain(text)), (name, text))
    return (*[row for row in distinct.values() if row not in _SHORT], *_SHORT)


def canonical_lines(text: Column) -> Column:
    """Lines of the canonical form of a text, in order; the whole form is the lines joined by a blank.

    A-Z count as a-z; the copyright sign becomes a word; every other run of signs and blanks
    becomes one blank; spellings are made equal; copyright lines and empty lines go. Line ends
    stay until the last step, so a text is gone through once, whatever its lines.
    """
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    plain = F.regexp_replace(F.regexp_replace(plain, _SIGN, " copyright "), _BETWEEN, " ")

    def spelled(now: Column, pair: Column) -> Column:
        # Most texts have none of the spellings, which a plain search finds out.
        pattern = F.concat(F.lit("(^|[ \n])"), pair["old"], F.lit("([ \n]|$)"))
        changed = F.regexp_replace(now, pattern, F.concat(F.lit("$1"), pair["new"], F.lit("$2")))
        return F.when(F.contains(now, pair["old"]), changed).otherwise(now)

    pairs = F.array(*[F.struct(F.lit(old).alias("old"), F.lit(new).alias("new")) for old, new in SPELLINGS])
    lines = F.transform(F.split(F.aggregate(pairs, plain, spelled), "\n", -1), lambda line: F.trim(line))
    return F.filter(lines, lambda line: (line != "") & ~line.startswith("copyright ") & ~line.isin(*DROPPED))


def digest(canonical: Column) -> Column:
    return F.sha2(canonical.cast("binary"), 256)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """digest, license of the known texts, by the very expressions documents go through."""
    texts = spark.createDataFrame(list(known or catalogue()), "license string, text string")
    return texts.select(digest(F.array_join(canonical_lines(F.col("text")), " ")).alias("digest"), "license")


def license_scan(documents: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, digest, licenses, notices of every row.

    digest is that of the canonical form of the entire text, licenses the sorted names of known
    texts with that digest; notices the sorted names of known texts that are an entire line of
    a document of that id. Both are joins on the digest, so the catalogue may have any size.
    NULL text is empty text; a text without words has the digest of the empty form and no
    licence. Texts are looked up whole, however long. Repeated rows are looked up each; a row
    without doc_id has no notices; extra columns are not read. An empty table gives no rows.
    """
    lines = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), canonical_lines(F.col("text").cast("string")).alias("lines")
    )
    marked = written(lines.select(
        "doc_id", digest(F.array_join("lines", " ")).alias("digest"), F.array_distinct(F.transform("lines", digest)).alias("parts")
    ), "digests")
    names = known.filter("digest is not null and license is not null").groupBy("digest").agg(F.array_sort(F.collect_set("license")).alias("names"))
    notices = (
        join_lookup(marked.filter("doc_id is not null").select("doc_id", F.explode("parts").alias("digest")), names, ["digest"], "inner")
        .groupBy("doc_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("names")))).alias("notices"))
    )
    whole = join_lookup(marked.select("doc_id", "digest"), names, ["digest"])
    none = F.array().cast("array<string>")
    return join_lookup(whole, notices, ["doc_id"]).select(
        "doc_id", "digest", F.coalesce("names", none).alias("licenses"), F.coalesce("notices", none).alias("notices")
    )


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence of every document by the digest of its text, and the notices among its lines."""
    found = license_scan(table(spark, folder, "documents"), known_digests(spark))
    return found.select(
        "doc_id", "digest", F.array_join("licenses", ",").alias("licenses"), F.array_join("notices", ",").alias("notices")
    )


@cache
def oracle() -> str:
    """The same in SQL for DuckDB."""
    def lines(text: str) -> str:
        plain = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
        plain = f"regexp_replace(regexp_replace({plain}, '{_SIGN}', ' copyright ', 'g'), '{_BETWEEN}', ' ', 'g')".replace("\n", "\\n")
        for old, new in SPELLINGS:
            plain = f"regexp_replace({plain}, '(^|[ \\n]){old}([ \\n]|$)', '\\1{new}\\2', 'g')"
        dropped = ", ".join(f"'{d}'" for d in DROPPED)
        return (
            f"list_filter(list_transform(string_split({plain}, chr(10)), lambda x: trim(x)), "
            f"lambda x: x <> '' and not starts_with(x, 'copyright ') and x not in ({dropped}))"
        )

    known = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in catalogue())
    return f"""
with known as (
    select license, sha256(coalesce(array_to_string({lines('text')}, ' '), '')) as digest from (values {known}) as k(license, text)
), marked as (
    select doc_id, {lines('text')} as lines from documents
), whole as (
    select doc_id, lines, sha256(coalesce(array_to_string(lines, ' '), '')) as digest from marked
), notices as (
    select doc_id, string_agg(license, ',' order by license) as notices from (
        select distinct l.doc_id, k.license from (select doc_id, unnest(lines) as line from whole) l join known k on k.digest = sha256(l.line)
    ) group by doc_id
)
select w.doc_id, w.digest,
    coalesce((select string_agg(license, ',' order by license) from known k where k.digest = w.digest), '') as licenses,
    coalesce(n.notices, '') as notices
from whole w left join notices n on n.doc_id = w.doc_id
"""
