"""Notices and statements of licences, wrapped, versioned and negated, with expectations written by hand."""

import textwrap

import duckdb
import pytest

from gamestate.llm import licenses

LINE = "Copyright (c) 2020 Jane Doe"
MIT = [
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
]
ISC = ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."]
BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
]
BSD3 = [*BSD, "3. Neither the name of Jane Doe Inc nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."]
HOPE = ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."]
FREE = "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation"
GPL, LGPL, AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
LATER = "either version {} of the License, or (at your option) any later version."
APACHE = [
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    "http://www.apache.org/licenses/LICENSE-2.0",
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
]


def notice(*parts: str, gap: str = "\n\n", mark: str = "") -> str:
    text = gap.join("\n".join(textwrap.wrap(p, 60)) for p in parts)
    return "\n".join((mark + line).rstrip() for line in text.split("\n")) + "\n"


#: Text, licences, and identifiers that must come in this order.
CASES = {
    "mit": (notice(LINE, *MIT), "MIT", "MitGrant,MitNotice,AsIsMit,MitLiable"),
    "mit in a comment": (notice(LINE, *MIT, mark=" * "), "MIT", "MitGrant,MitNotice,AsIsMit"),
    "mit with title": (notice("MIT License", LINE, *MIT), "MIT", "MitTitle,MitGrant,MitNotice,AsIsMit"),
    "isc": (notice(LINE, *ISC), "ISC", "IscGrant"),
    "isc without a blank line": (LINE + "\n" + notice(*ISC), "ISC", "IscGrant"),
    "isc with blank lines inside": (notice(*ISC).replace("\n", "\n\n"), "ISC", "IscGrant"),
    "bsd 2": (notice(LINE, *BSD), "BSD-2-Clause", "BsdGrant,BsdSource,BsdBinary"),
    "bsd 3 with a name": (notice(LINE, *BSD3, mark="# "), "BSD-3-Clause", "BsdGrant,BsdSource,BsdBinary,BsdNoEndorse"),
    "apache": (notice(LINE, *APACHE, mark="// "), "Apache-2.0", "Apache-2.0.name,ApacheMayNot,ApacheCopy,ApacheAsIs,ApacheSee"),
    "gpl 2": (notice(LINE, FREE.format(";", GPL) + "; " + LATER.format(2), *HOPE), "GPL-2.0-or-later", "GplFree,Version2OrLater,GplHope,GplDetails"),
    "gpl 3": (notice(LINE, FREE.format(":", GPL) + ", " + LATER.format(3), *HOPE), "GPL-3.0-or-later", "FreeSoftware,GplFree3,GplHope,GplDetails"),
    "gpl 3 with a semicolon": (notice(LINE, FREE.format(";", GPL) + "; " + LATER.format(3), *HOPE), "GPL-3.0-or-later", "GplFree,Version3OrLater,GplHope,GplDetails"),
    "gpl 2 only": (notice(FREE.format(";", GPL) + "; version 2 of the License."), "GPL-2.0-only", "GplFree,Version2Only"),
    "gpl 3 only": (notice(FREE.format(";", GPL) + "; version 3 of the License."), "GPL-3.0-only", "GplFree,Version3Only"),
    "gpl 2 only with a comma": (notice(FREE.format(";", GPL) + ", version 2 of the License."), "GPL-2.0-only", "GplOnly2"),
    "gpl without a version": (notice(LINE, FREE.format(";", GPL) + "."), "GPL", "GplFree"),
    "lgpl": (notice(FREE.format(";", LGPL) + "; " + LATER.format("2.1")), "LGPL-2.1-or-later", "LgplFree,Version2.1OrLater"),
    "agpl": (notice(FREE.format(":", AGPL) + ", " + LATER.format(3)), "AGPL-3.0-or-later", "AgplFree3"),
    "gpl 3 title": ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Everyone is permitted to copy", "GPL-3.0-only", "GplTitle3"),
    "mpl 2": ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0", "Mpl2,MplObtain"),
    "mpl 1.1": ("The contents of this file are subject to the Mozilla Public License, v. 1.1.", "MPL-1.1", "Mpl1.1"),
    "mpl 1.1 wrapped": ('The contents of this file are subject to the Mozilla Public License Version\n1.1 (the "License"); you may not use this file except in compliance with\nthe License.', "MPL-1.1", "Mpl1.1,ApacheMayNot"),
    "mpl named": ("Licensed under the Mozilla Public License, v. 1.1.", "MPL-1.1", "MPL-1.1.name"),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "Unlicense", "Unlicense"),
    "unlicense wrapped": ("This is free and unencumbered software released into the public\ndomain.", "Unlicense", "Unlicense"),
    "spdx": ("// SPDX-License-Identifier: Apache-2.0\nint main() {}", "Apache-2.0", "Apache-2.0.name"),
    "spdx of two": ("# SPDX-License-Identifier: GPL-2.0-or-later OR MIT\n", "MIT|GPL-2.0-or-later", "GPL-2.0-or-later.name,MIT.name"),
    "dual": ("This crate is small. Licensed under either of Apache License, Version 2.0 or MIT license at your option.", "Apache-2.0|MIT", "Apache-2.0.name,MIT.name"),
    "gpl named or later": ("This library is released under the GNU GPL v3 or any later version.", "GPL-3.0-or-later", "GPL-3.0-or-later.name"),
    "gpl named": ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only", "GPL-3.0-only.name"),
    "cc": ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "CC-BY-SA-3.0", "CC-BY-SA-3.0.name"),
    "two in one text": ("Licensed under CC BY-NC 4.0.\nReleased under the MIT Licence.", "MIT|CC-BY-NC-4.0", "CC-BY-NC-4.0.name,MIT.name"),
    "reserved": ("All rights reserved, no license is granted.", "All rights reserved", "AllRights"),
    "negated": ("This project is not licensed under the MIT License. It was never released under the Apache License, Version 2.0.", "", ""),
    "another version": ("Licensed under the Apache License, Version 1.1.", "", ""),
    "a licence as a topic": ("The licence plates are under the car, and the MIT License was a topic of the copyright talk.", "", ""),
    "version of nothing": ("version 2 of the License", "", "Version2Only"),
    "null": (None, "", ""),
    "empty": ("", "", ""),
    "blank": (" \n\t\n", "", ""),
    "very long": ("word " * 200_000 + "\n\nReleased under the MIT License.", "MIT", "MIT.name"),
}


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame([(k, t, 1) for k, (t, _, _) in CASES.items()], "doc_id string, text string, licenses int")


@pytest.fixture(scope="module")
def scanned(cases):
    return {r["doc_id"]: r for r in licenses.scan(cases).collect()}


@pytest.mark.parametrize("case", CASES)
def test_notice(scanned, case):
    r, (_, licence, ids) = scanned[case], CASES[case]
    got = r["sentence_ids"].split(",")
    assert r["licenses"] == licence
    assert [i for i in got if i in ids.split(",")] == ids.split(",")
    assert r["n_known"] == (0 if r["sentence_ids"] == "" else len(got))


def test_sql_twin_agrees_on_notices(cases, scanned):
    documents = cases.select("doc_id", "text").toPandas()  # noqa: F841  DuckDB finds it by name
    got = duckdb.sql(licenses.oracle()).fetchall()
    assert sorted(got) == sorted((r["doc_id"], r["n_known"], r["sentence_ids"], r["licenses"]) for r in scanned.values())


def test_repeated_scans_agree(cases, scanned):
    want = sorted(tuple(r) for r in scanned.values())
    for parts in (1, 2, 3, 5, 8):
        assert sorted(tuple(r) for r in licenses.scan(cases.repartition(parts)).collect()) == want
