"""Customary licence notices through Spark and DuckDB alike."""

import duckdb
import pytest

from cohortlens.llm import license_scan

GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the "
       "Free Software Foundation, either version {v} of the License, or (at your option) any later version.")
NOTICES = [
    ("All rights reserved.", "Proprietary"),
    ("Some prose.\nCopyright (c) 2020 X. All rights reserved.", "Proprietary"),
    ("(c) Example Ltd, ALL RIGHTS\nRESERVED", "Proprietary"),
    (GNU.format(name="General Public License", v="3"), "GPL-3.0-or-later"),
    (GNU.format(name="General Public License", v="2"), "GPL-2.0-or-later"),
    (GNU.format(name="Lesser General Public License", v="3"), "LGPL-3.0-or-later"),
    (GNU.format(name="Lesser General Public License", v="2.1"), "LGPL-2.1-or-later"),
    (GNU.format(name="Affero General Public License", v="3"), "AGPL-3.0-or-later"),
    ("# SPDX-License-Identifier: MIT\nimport os", "MIT"),
    ("// spdx-license-identifier:GPL-3.0-or-later", "GPL-3.0-or-later"),
    ("/* SPDX-License-Identifier: Apache-2.0 */ All rights reserved.", "Apache-2.0,Proprietary"),
    ("The text is licensed under CC0 1.0.", "CC0-1.0"),
    ("To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the "
     "public domain worldwide.", "CC0-1.0"),
    ("This software is provided 'as-is', without any express or implied warranty. Permission is granted to anyone to use this software "
     "for any purpose, including commercial applications, and to alter it and redistribute it freely.", "Zlib"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "EPL-2.0"),
    ("The seats were reserved, the rights were not.", ""), ("No licence is given here.", ""), (None, ""), ("", ""),
]


@pytest.fixture(scope="module")
def both(spark):
    rows = [(i, t) for i, (t, _) in enumerate(NOTICES)]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return got, {r[0]: r for r in con.execute(license_scan.duckdb_sql()).fetchall()}


def test_notices_are_named(both):
    got, _ = both
    assert [got[i].licenses for i in range(len(NOTICES))] == [want for _, want in NOTICES]


def test_sql_agrees_on_notices(both):
    got, sql = both
    assert {i: tuple(r) for i, r in got.items()} == sql
