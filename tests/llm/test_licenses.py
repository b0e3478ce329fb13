"""Published licence texts, wrapped and commented, and the query's SQL on the same rows."""

import textwrap

import pytest

from tidemark.llm import license_scan

MIT = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

APACHE = """Copyright 2020 A. Person

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

BSD = """Copyright (c) 2019, A. Person, all rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{endorse}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
ENDORSE = "3. Neither the name of A. Person nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"

GPL = """This program is free software{mark} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""

GPL_TITLE = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.
"""


def wrapped(text, width, leader=""):
    lines = [line for part in text.split("\n") for line in (textwrap.wrap(part, width) or [""])]
    return "\n".join((leader + line).rstrip() for line in lines)


@pytest.fixture(scope="module")
def rows():
    texts = []
    full = [(MIT, "MIT"), (APACHE, "Apache-2.0"), (BSD.format(endorse=ENDORSE), "BSD-3-Clause"), (BSD.format(endorse=""), "BSD-2-Clause"), (GPL.format(mark=":", v=3), "GPL-3.0-or-later"), (GPL.format(mark=";", v=2), "GPL-2.0-or-later")]
    for text, name in full:
        texts += [(text, name), (wrapped(text, 78), name), (wrapped(text, 60, "// "), name), (wrapped(text, 70, " * ").replace("\n", "\r\n"), name), ("Some words before.\n\n" + wrapped(text, 78) + "\n\nand after", name)]
    texts += [
        (GPL_TITLE, "GPL-3.0-only"),
        ("Released under\nthe MIT License.", "MIT"),
        ("Released" + " " * 700 + "under the MIT License.", "MIT"),
        ("a line without an end\nReleased under the MIT License\nanother line", "MIT"),
        ("// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"),
        ("/* spdx-license-identifier: (GPL-2.0-only OR MIT) */\r\nint x;", "MIT"),
        ("Copyright (c) 2020 Foo, all rights reserved.", "LicenseRef-All-Rights-Reserved"),
        ("All rights reserved. All rights reserved.", "LicenseRef-All-Rights-Reserved"),
        ("x released under the mit license y", None), ("", None), (None, None), ("\x01\x02MIT", None), ("é" * 50 + ". ß\n\n\n\n", None),
        ("." * 300_000 + "\n" * 300_000 + "-" * 300_000, None), ("Released under the MIT License." + "\n-" * 300_000, "MIT"), ("word " * 100_000, None),
    ]
    return [(i % 50, *x) for i, x in enumerate(texts)] + [(0, *texts[0])]


def test_published_texts_are_recognised(spark, rows):
    docs = spark.createDataFrame([(i, t, want, "clash") for i, t, want in rows], "doc_id long, text string, license string, parts string")
    got = license_scan.scan_licenses(docs.withColumnRenamed("license", "known")).collect()
    found = sorted(((x.doc_id, x.license) for x in got), key=str)
    assert found == sorted(((i, want) for i, _, want in rows), key=str)
    assert license_scan.scan_licenses(docs.limit(0)).collect() == []
    plan = license_scan.scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_sql_agrees(spark, rows, tmp_path):
    import duckdb

    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = license_scan.op7_license_scan(spark, str(tmp_path))
    want = con.execute(license_scan.OP7_SQL)
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(str, want.fetchall()))
