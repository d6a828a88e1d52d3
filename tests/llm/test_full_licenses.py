"""Full licence texts as they stand in projects, written apart from the known ones."""

import re
import textwrap

import pytest
from pyspark.sql import functions as F

from gridseries.llm import license_scan

MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so%s

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
MIT = MIT_BODY % """, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
WTFPL = """            DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
                    Version 2, December 2004

 Copyright (C) 2004 Sam Hocevar <sam@hocevar.net>

 Everyone is permitted to copy and distribute verbatim or modified
 copies of this license document, and changing it is allowed as long
 as the name is changed.

            DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
   TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION

  0. You just DO WHAT THE FUCK YOU WANT TO.
"""
BSD2 = """Copyright (c) 2011, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

* Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer.

* Redistributions in binary form must reproduce the above copyright notice,
  this list of conditions and the following disclaimer in the documentation
  and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
CASES = [
    ("MIT", "MIT License\n\nCopyright (c) 2020 Someone\n\n" + MIT),
    ("MIT", "The MIT License (MIT)\n\nCopyright © 2001-2020 Someone. All rights reserved.\n\n" + MIT),
    ("MIT", MIT),
    ("MIT-0", "MIT No Attribution\n\nCopyright 2020 Someone\n\n" + MIT_BODY % "."),
    ("MIT-0", MIT_BODY % "."),
    ("WTFPL", WTFPL),
    ("BSD-2-Clause", BSD2),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + BSD2.replace("* Redistributions of", "1. Redistributions of").replace("* Redistributions in", "2. Redistributions in")),
    (None, MIT.replace("free of charge", "for a charge")),
    (None, MIT_BODY[:600] % "."),
]


def test_full_texts_match_as_a_whole(spark):
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(CASES)], "doc_id long, text string")
    got = {r["doc_id"]: r["license"] for r in license_scan.scan(docs).collect()}
    assert got == {i: spdx for i, (spdx, _) in enumerate(CASES)}


@pytest.mark.parametrize("spdx", ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense", "ISC", "0BSD", "BSD-3-Clause", "CC0-1.0"])
def test_full_text_is_known(spdx):
    longest = max((t for k, t in license_scan.KNOWN if k == spdx), key=len)
    assert len(longest) > 600


def rewrapped(text, width):
    paragraphs = [" ".join(p.split()) for p in re.split(r"\n[ \t]*\n", text) if p.strip()]
    return "\n\n".join(textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in paragraphs)


def test_every_known_text_however_its_lines_break(spark):
    forms = [(k, t) for k, t in license_scan.KNOWN] + [(k, rewrapped(t, w)) for k, t in license_scan.KNOWN for w in (10**6, 40, 60, 72, 100)]
    docs = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(forms)], "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.license for r in license_scan.scan(docs).collect()}
    first = {}
    for n, (k, _) in enumerate(license_scan.KNOWN):
        first.setdefault(found[n], k)
    known = len(license_scan.KNOWN)
    assert None not in first
    assert [forms[n] for n in range(known, len(forms)) if found[n] != found[(n - known) // 5]] == []


@pytest.mark.parametrize("line", [
    "Copyright (c) 2011, Someone", "Copyright © 2011-2013 Someone and others", "copyright 2011 someone", "(C) Copyright 2011 Someone", "© Someone", "# Copyright Someone Else 2011. All rights reserved", "Copyright Some One",
    "COPYRIGHT (C) 2011", "Copyright: 2011, the people", "Copyright <year> <holder>", "Copyright (C) 2007, 2011 Some Company, Inc.", " * Copyright (c) 2011\r",
])
def test_lines_that_name_a_holder_go(spark, line):
    docs = spark.createDataFrame([(1, f"{line}\n\n{MIT}"), (2, MIT.replace("\n\n", f"\n{line}\n\n", 1))], "doc_id long, text string")
    assert {r.license for r in license_scan.scan(docs).collect() if r.doc_id == 1} == {"MIT"}


def test_words_about_copyright_stay(spark):
    said = "copyright license to reproduce\ncopyright holder\nCopyright and Related Rights\ncopyright law of 1976\ncopyright treaty adopted on 20 December 1996"
    got = spark.createDataFrame([(said,)], "text string").select(license_scan.canonical(F.col("text")).alias("c")).first().c
    assert got == "copyright license to reproduce copyright owner copyright and related rights copyright law of 1976 copyright treaty adopted on 20 december 1996"


def test_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "copyright words without end " * 100_000), (2, "Copyright (C) 2001 " + "Name " * 50_000)], "doc_id long, text string")
    assert {r.license for r in license_scan.scan(docs).collect()} == {None}
