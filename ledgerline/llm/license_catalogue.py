"""Known licences as data: whole texts in ``license_texts``, and notices for each licence and version."""

from __future__ import annotations

import re
import textwrap
from importlib import resources
from itertools import product

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_GRANT = "Permission to use, copy, modify, and{} distribute this software for any purpose with or without fee is hereby granted"
_AS_IS = """

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies."

# Texts without their title, and the titles they are published under ("" is none).
SHORT = {
    "MIT": ([MIT], ("", "MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License")),
    "MIT-0": ([re.sub(r", subject to the following conditions:\n\n.*\n", ".\n", MIT)], ("", "MIT No Attribution", "MIT No Attribution License")),
    "ISC": ([_GRANT.format(x) + _KEEP + _AS_IS for x in ("", "/or")], ("", "ISC License", "The ISC License", "ISC License (ISC)")),
    "0BSD": ([_GRANT.format("/or") + "." + _AS_IS], ("", "BSD Zero Clause License", "Zero-Clause BSD", "0BSD License")),
}
TITLES = {
    "BSD-2-Clause": ("", "BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "BSD License", "The BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("", "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "BSD License", "The BSD License", "New BSD License"),
    "Zlib": ("", "zlib License", "The zlib License", "zlib/libpng License"),
}
# Where the terms of a long licence end; what follows tells how to apply them and is often left out.
_END = re.compile(r"(?m)^[ \t]*(END OF TERMS AND CONDITIONS|The End)[ \t]*$")
# The Foundation has moved; its licences were published again with every address.
_ADDRESS = re.compile(r"51 Franklin St(reet)?, Fifth Floor, Boston, MA\s+02110-1301,?\s+USA")
ADDRESSES = (
    "675 Mass Ave, Cambridge, MA 02139, USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
    "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
)

_CC = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_GNU = {
    "GPL": (("GNU General Public License", "GNU GPL", "GPL"), ("1", "2", "3")),
    "LGPL": (("GNU Lesser General Public License", "GNU Library General Public License", "GNU LGPL", "LGPL"), ("2", "2.1", "3")),
    "AGPL": (("GNU Affero General Public License", "GNU AGPL", "AGPL"), ("3",)),
    "GFDL": (("GNU Free Documentation License", "GNU FDL", "GFDL"), ("1.1", "1.2", "1.3")),
}
_VERSIONED = {
    "Apache": (("Apache License", "Apache Software License", "Apache"), ("1.0", "1.1", "2.0")),
    "MPL": (("Mozilla Public License", "MPL"), ("1.0", "1.1", "2.0")),
    "EPL": (("Eclipse Public License", "EPL"), ("1.0", "2.0")),
    "CDDL": (("Common Development and Distribution License", "CDDL"), ("1.0", "1.1")),
    "EUPL": (("European Union Public License", "European Union Public Licence", "EUPL"), ("1.0", "1.1", "1.2")),
    "Artistic": (("Artistic License", "Perl Artistic License"), ("1.0", "2.0")),
    "OFL": (("SIL Open Font License", "Open Font License", "OFL"), ("1.0", "1.1")),
    "AFL": (("Academic Free License", "AFL"), ("2.1", "3.0")),
    "BSL": (("Boost Software License",), ("1.0",)),
    "PSF": (("Python Software Foundation License", "PSF License"), ("2",)),
    "Unicode": (("Unicode License",), ("3.0",)),
}
# Licences whose notices name no version.
PLAIN = {
    "MIT": ("MIT License", "MIT", "Expat License", "MIT/X11 License"), "MIT-0": ("MIT No Attribution License", "MIT-0 License", "MIT-0"),
    "ISC": ("ISC License", "ISC"), "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD License", "0BSD License", "0BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "Revised BSD License", "BSD-3-Clause"),
    "BSD-4-Clause": ("BSD 4-Clause License", "4-Clause BSD License", "Original BSD License", "BSD-4-Clause"),
    "Zlib": ("zlib License", "zlib/libpng License", "zlib"), "Unlicense": ("Unlicense",), "WTFPL": ("WTFPL", "Do What The Fuck You Want To Public License"),
    "MS-PL": ("Microsoft Public License", "Ms-PL"),
    "CC0-1.0": ("CC0", "CC0 1.0", "CC0 1.0 Universal", "CC0 1.0 License", "CC0 License", "Creative Commons Zero v1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons CC0 License"),
}

SUBJECTS = ("", "This work is", "This project is", "This software is", "This program is")
VERBS = ("Licensed", "Released", "Distributed")
ARTICLES = ("", "the", "a", "the terms of the")

_FREE = "This {} is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation, "
FIXED = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def _full(version: str) -> str:
    return version if "." in version else f"{version}.0"


def _numbered(name: str, version: str, later: str = "") -> list[str]:
    """Spellings of a name with its version; signs do not matter, 2 and 2.0 both do."""
    short = version.removesuffix(".0")
    out = []
    for v in dict.fromkeys((short, _full(version))):
        out += [f"{name}, version {v}{later}", f"{name} v{v}{later}", f"{name} {v}{later}"]
        if " " not in name:
            out.append(f"{name}v{v}{later}")
        if not later and "License" in name:
            out.append(f"{name.removesuffix(' License')} {v} License")
    return out


def names() -> list[tuple[str, str]]:
    """(licence, a name notices call it by) of every licence and version."""
    out = [(one, spelled) for one, called in PLAIN.items() for spelled in called]
    for family, (called, versions) in _VERSIONED.items():
        for name, version in product(called, versions):
            out += [(f"{family}-{_full(version)}", x) for x in _numbered(name, version)]
    for family, (called, versions) in _GNU.items():
        for name, version in product(called, versions):
            if "Library" in name and version != "2" or "Lesser" in name and version == "2":
                continue
            one = f"{family}-{_full(version)}"
            out += [(one, x) for x in _numbered(name, version)] + [(one, x) for x in _numbered(name, version, " only")]
            for later in (" or later", " or any later version"):
                out += [(f"{one}-or-later", x) for x in _numbered(name, version, later)]
    for (kind, long), version in product(_CC.items(), ("1.0", "2.0", "2.5", "3.0", "4.0")):
        where = {"4.0": ("", " International"), "3.0": ("", " Unported")}.get(version, ("", " Generic"))
        for base, place, end in product((f"CC {kind}", f"Creative Commons {kind}", f"Creative Commons {long}"), where, ("", " License")):
            out.append((f"CC-{kind}-{version}", f"{base} {version}{place}{end}"))
    return out


def notices() -> list[tuple[str, str]]:
    """(licence, a sentence that states it)."""
    out = list(FIXED)
    for (one, name), subject, verb, article in product(names(), SUBJECTS, VERBS, ARTICLES):
        if article == "a" and not name.startswith("Creative") or article.endswith("of the") and "License" not in name:
            continue
        out.append((one, " ".join(x for x in (subject, verb, "under", article, name) if x)))
    out += [(one, f"License: {name}") for one, name in names()]
    out += [(one, f"SPDX-License-Identifier: {one}") for one in dict.fromkeys(one for one, _ in names())]
    for family in ("GPL", "LGPL", "AGPL"):
        called, versions = _GNU[family]
        for version, thing in product(versions, ("program", "library", "software", "file")):
            long = "GNU Library General Public License" if (family, version) == ("LGPL", "2") else called[0]
            start, one = _FREE.format(thing, long), f"{family}-{_full(version)}"
            out += [(f"{one}-or-later", f"{start}either version {version} of the License, or (at your option) any later version."), (one, f"{start}version {version} of the License.")]
            out.append((one, f"{start}version {version}."))
    return out


def layouts(text: str) -> list[str]:
    """The text as it stands and with a line per paragraph; short ones broken at every usual width too.

    Breaks matter only where a line then starts with "copyright" and is dropped.
    """
    paragraphs = [" ".join(p.split()) for p in re.split(r"\n\s*\n|\n(?=[ \t]*(?:\*|\d\.) )", text.strip())]
    out = [text, "\n\n".join(paragraphs)]
    if len(text) < 4000:
        out += ["\n\n".join(textwrap.fill(p, width, break_long_words=False) for p in paragraphs) for width in range(60, 101)]
    return out


def texts() -> list[tuple[str, str]]:
    """(licence, whole text) with and without title, closing parts and numbers of conditions."""
    bodies = [(one, body, titles) for one, (found, titles) in SHORT.items() for body in found]
    for file in sorted(resources.files("ledgerline.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        if not file.name.endswith(".txt"):
            continue
        one, text = file.name.removesuffix(".txt").removesuffix(".regents"), file.read_text(encoding="utf-8")
        forms = [text]
        if end := _END.search(text):
            forms += [text[:end.end()], text[:end.start()]]
        if _ADDRESS.search(text):
            forms = [_ADDRESS.sub(address, form) for form in forms for address in ADDRESSES] + forms
        if one.startswith("BSD"):
            bare = re.sub(r"(?m)^(?:\*|\d\.) ", "* ", text)
            count = iter(range(1, 9))
            forms = [bare, re.sub(r"(?m)^\* ", lambda _: f"{next(count)}. ", bare)]
        bodies += [(one, form, TITLES.get(one, ("",))) for form in forms]
    return [(one, f"{title}\n\n{form}" if title else form) for one, body, titles in bodies for form in layouts(body) for title in titles]
