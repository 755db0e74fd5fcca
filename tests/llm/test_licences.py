import duckdb
import pyarrow as pa
import pytest

from laptrace.llm import licences

GRANT = licences.SENTENCES["mit-grant"]
NOTICE = licences.SENTENCES["mit-notice"]
CASES = [
    ("Released under the MIT License.", "MIT", "notice"),
    ("some words.\n * Licensed under the Apache License,\n * Version 2.0.\nYou may not use this file except in "
     "compliance with the License. ", "Apache-2.0", "short header"),
    (f"/* {GRANT.upper()}:\n\n{NOTICE}. other words. {licences.SENTENCES['mit-warranty']}. "
     f"{licences.SENTENCES['mit-liability']}. */", "MIT", "text"),
    (f"{NOTICE}. {GRANT}.", "", ""),  # the wrong order
    ("SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0-only", "notice"),
    ("SPDX License Identifier GPL-3.0-only", "GPL-3.0-only", "notice"),
    ("a line\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.", "MIT,CC-BY-NC-4.0", "notice,notice"),
    ("This is not licensed under the MIT license", "", ""),
    ("", "", ""), (None, "", ""), ("software " * 20000, "", ""),
]


def test_cases(spark, no_docs):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, (t, *_) in enumerate(CASES)],
                                 "doc_id long, text string, ids string, line string")
    rows = licences.scan(docs).orderBy("doc_id").collect()
    assert [(r.licences, r.rules) for r in rows] == [c[1:] for c in CASES]
    assert licences.scan(no_docs).count() == 0


def test_edge_rows(edge_docs, edge):
    rows = licences.scan(edge_docs).collect()
    assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(repr(i) for i, *_ in edge)
    assert all(r.n_known == 0 and r.licences == "" for r in rows)


def test_sentences_are_normalised():
    for text in licences.sentences():
        assert text == " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


@pytest.mark.parametrize("name", ["MapInArrow", "Python", "Exchange"])
def test_plan_is_native(spark, name):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert name not in licences.scan(docs)._jdf.queryExecution().executedPlan().toString()


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
GPL_2 = """    This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
GPL_3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def commented(text, mark):
    return "".join(f"{mark} {line}".rstrip() + "\n" for line in text.split("\n"))


PUBLIC = [
    (MIT, "MIT", "text"), (ISC, "ISC", "text"), (BSD, "BSD-2-Clause", "text"),
    (BSD + BSD_3, "BSD-3-Clause,BSD-2-Clause", "text,text"),
    (APACHE, "Apache-2.0", "header"), (commented(APACHE, "#"), "Apache-2.0", "header"),
    (commented(APACHE, " *").replace("http:", "https:"), "Apache-2.0", "header"),
    (APACHE[:150], "Apache-2.0", "short header"),
    (GPL_2, "GPL-2.0-or-later", "header"), (commented(GPL_2, " *"), "GPL-2.0-or-later", "header"),
    (GPL_3, "GPL-3.0-or-later", "header"), (MPL, "MPL-2.0", "header"), (commented(MPL, "//"), "MPL-2.0", "header"),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to", "Unlicense", "text"),
    ("Copyright 2020 A. Person. All rights reserved.", "proprietary", "notice"),
]
TAGS = [
    *[(f"// SPDX-License-Identifier: {licence}\nint main;", licence, "notice") for licence in licences.NAMES],
    *[(f"/* SPDX-License-Identifier: {licence} */", licence, "notice") for licence in licences.TAGGED],
    ("# SPDX-License-Identifier: (MIT OR Apache-2.0)\r\nx", "MIT,Apache-2.0", "notice,notice"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", "MIT,GPL-2.0-only", "notice,notice"),
    ("a word: SPDX-License-Identifier: Foo-1.0\nb", "", ""),
]


def test_public_texts_and_tags(spark):
    cases = PUBLIC + TAGS
    docs = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(cases)], "doc_id long, text string")
    rows = licences.scan(docs).orderBy("doc_id").collect()
    assert [(r.licences, r.rules) for r in rows] == [c[1:] for c in cases]


def test_sql_on_the_same_texts(spark):
    """The SQL of the query knows what the scan knows: every public text, tag and case, alone and one after another."""
    texts = [t for t, *_ in PUBLIC + TAGS + CASES]
    texts += [f"{a or ''}\n\n{b or ''}" for a, b in zip(texts, texts[1:], strict=False)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}))
    columns = ["doc_id", "n_known", "sentence_ids", "licences", "rules"]
    want = con.sql(f"select {', '.join(columns)} from ({licences.scan_sql()}) order by doc_id").fetchall()
    assert [tuple(r) for r in licences.scan(docs).select(*columns).orderBy("doc_id").collect()] == want
    assert sum(r[1] > 0 for r in want) > 60
