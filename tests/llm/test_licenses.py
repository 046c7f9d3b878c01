"""Canonical licence digests: variants that mean the same, and the query against its SQL."""

import textwrap
from pathlib import Path

from compare import connect, differences

from ledgerline.llm import licenses

MIT = dict(licenses.catalogue())["MIT"]


def test_variants_have_the_same_digest(spark):
    variants = [
        MIT, MIT.upper(), MIT.replace("<year> <copyright holders>", "1999 Somebody & Sons"), "\n\n " + MIT.replace(",", " ;").replace('"', "“"),
        MIT.replace("sublicense", "sub-license"), MIT.replace("MIT License", "MIT Licence") + "\nAll rights reserved.", MIT.replace("Copyright (c)", "©"),
    ]
    other = [MIT.replace("without restriction", "with restriction"), MIT[:-20], ""]
    df = spark.createDataFrame(list(enumerate(variants + other)), "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.license_scan(df, licenses.known_digests(spark)).collect()}
    assert all(found[i].licenses == ["MIT"] for i in range(len(variants)))
    assert all(found[len(variants) + i].licenses == [] for i in range(len(other)))


def test_odd_rows(spark, odd, none):
    known = licenses.known_digests(spark)
    found = licenses.license_scan(odd, known).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[14].notices == ["MIT notice"] and by_id[14].licenses == [] and by_id[0].digest == by_id[1].digest
    assert licenses.license_scan(none, known).count() == 0
    assert all(r.licenses == r.notices == [] for r in licenses.license_scan(odd, known.filter("false")).collect())


def test_query_equals_its_sql(spark, tables):
    df = licenses.op5_licenses(spark, tables)
    assert differences(df.collect(), df.columns, connect(tables), licenses.oracle()) == ""
    assert df.filter("notices <> ''").count() > 0


def test_licences_the_given_documents_do_not_hold(spark):
    """Whole texts in other layouts, and notices of other licences and versions; names written by hand."""
    folder = Path(licenses.__file__).parent / "license_texts"
    text = {f.name.removesuffix(".txt"): f.read_text() for f in folder.glob("*.txt")}
    body = MIT.split("\n\n", 2)[2]
    apache, gpl2 = text["Apache-2.0"], text["GPL-2.0"]
    numbered = text["BSD-2-Clause"].replace("* Redistributions of", "1. Redistributions of").replace("* Redistributions in", "2. Redistributions in")
    whole = [(t, [n.removesuffix(".regents")]) for n, t in text.items()] + [
        ("MIT License\n\nCopyright 2020 A\n\n" + "\n\n".join(textwrap.fill(p, 72) for p in body.split("\n\n")), ["MIT"]),
        ("Copyright (c) 2001 B\n\n" + body, ["MIT"]),
        ("The MIT License (MIT)\n\n" + body, ["MIT"]),
        ("/*\n" + "\n".join(" * " + line for line in apache.splitlines()) + "\n */", ["Apache-2.0"]),
        (apache[:apache.index("   APPENDIX")], ["Apache-2.0"]),
        ("\n\n".join(" ".join(p.split()) for p in apache.split("\n\n")), ["Apache-2.0"]),
        (gpl2.replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA"), ["GPL-2.0"]),
        (gpl2[:gpl2.index("            How to Apply")], ["GPL-2.0"]),
        ("BSD 2-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n\n" + numbered, ["BSD-2-Clause"]),
        (gpl2[:len(gpl2) // 2], []), (apache + "\nand one more condition", []),
    ]
    lines = [
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0 notice"]),
        ("Released under the GPLv3 or later", ["GPL-3.0-or-later notice"]),
        ("Licensed under CC BY 4.0.", ["CC-BY-4.0 notice"]),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", ["CC-BY-SA-3.0 notice"]),
        ("# SPDX-License-Identifier: LGPL-2.1-or-later", ["LGPL-2.1-or-later notice"]),
        ("Licensed under the Apache License, Version 2.0 (the \"License\");", ["Apache-2.0 notice"]),
        ("Distributed under the terms of the Mozilla Public License 2.0", ["MPL-2.0 notice"]),
        ("This software is released under the BSD 3-Clause Licence.", ["BSD-3-Clause notice"]),
        ("Licensed under the GNU Affero General Public License v3.0", ["AGPL-3.0 notice"]),
        ("Licensed under nothing at all.", []),
    ]
    rows = [t for t, _ in whole] + [f"Some words.\n{t}\nMore words." for t, _ in lines]
    found = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), licenses.known_digests(spark)).collect()}
    assert [found[i].licenses for i in range(len(whole))] == [n for _, n in whole]
    assert [found[len(whole) + i].notices for i in range(len(lines))] == [n for _, n in lines]


def test_no_entry_repeats_another(spark):
    known = licenses.known_digests(spark)
    assert known.distinct().count() == known.count() == len(licenses.catalogue())
    assert known.groupBy("digest").count().filter("count > 1").isEmpty()
