"""Forms in which licences are named in files that are in use, with expectations written by hand."""

import duckdb
import pytest

from gamestate.llm import licenses

APACHE = "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an &quot;AS IS&quot; BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
CASES = {
    "// SPDX-License-Identifier: GPL-2.0+": "GPL-2.0-or-later",
    "# SPDX-License-Identifier: GPL-2.0": "GPL-2.0-only",
    "/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */": "GPL-2.0-only",
    "SPDX-License-Identifier: GPL-3.0-or-later WITH GCC-exception-3.1": "GPL-3.0-or-later",
    "SPDX-License-Identifier: (GPL-2.0 WITH Linux-syscall-note) OR MIT": "MIT|GPL-2.0-only",
    "Name: x\nLicense: GPLv3\nVersion: 2": "GPL-3.0-only",
    "License: MIT": "MIT",
    "License: Apache 2.0": "Apache-2.0",
    "License: LGPLv2.1+": "LGPL-2.1-or-later",
    "Released under LGPLv2.1+.": "LGPL-2.1-or-later",
    "Licensed under GPL v2+.": "GPL-2.0-or-later",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": "LGPL-2.0-or-later",
    "This dataset is available under CC-BY-SA 4.0.": "CC-BY-SA-4.0",
    "Available under CC-BY-SA 4.0": "CC-BY-SA-4.0",
    "Licensed under the Artistic License 2.0.": "Artistic-2.0",
    "Licensed under the EUPL, Version 1.2": "EUPL-1.2",
    "Licensed under the European Union Public Licence v. 1.2.": "EUPL-1.2",
    "Licensed under the PSF License Agreement.": "PSF-2.0",
    "License: see below": "",
    "The driver's license: MIT is a school.": "",
    "Licensed under GPL v4+.": "",
    "SPDX-License-Identifier: GPL-2.0 WITH everything": "",
}


@pytest.fixture(scope="module")
def scanned(spark):
    rows = [*CASES, APACHE]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "doc_id int, text string")
    return df, dict(zip(rows, sorted(licenses.scan(df).collect(), key=lambda r: r["doc_id"]), strict=True))


@pytest.mark.parametrize("text", CASES)
def test_form(scanned, text):
    assert scanned[1][text]["licenses"] == CASES[text]


def test_quotes_of_pages(scanned):
    assert scanned[1][APACHE]["sentence_ids"] == "ApacheAsIs"


def test_sql_twin_agrees(scanned):
    documents = scanned[0].toPandas()  # noqa: F841  DuckDB finds it by name
    assert sorted(duckdb.sql(licenses.oracle()).fetchall()) == sorted(tuple(r) for r in scanned[1].values())
