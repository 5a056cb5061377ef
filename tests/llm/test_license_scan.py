"""Canonical digests against hand-made variants and the SQL statement."""
import textwrap
from pathlib import Path

import duckdb

from ledgerlake.llm import license_scan as L
from ledgerlake.llm.license_texts import KNOWN

MIT = next(t for i, t in KNOWN if i == "MIT" and len(t) > 500)
ROWS = [
    (1, "Copyright (c) 2020 Some Body\n\n" + MIT.upper().replace(" ", "  ")),
    (2, MIT.replace("sublicense", "sub-licence").replace("\n", " \n * ")),
    (3, "words before " + MIT),                                                     # only part of the text
    (4, "prose here\nreleased under the MIT licence!!\nmore prose\nALL RIGHTS RESERVED\n(c) Some Body\nall rights reserved"),
    (5, None), (6, ""), (7, " \n--\n"), (None, "Licensed under CC BY-NC 4.0."), (4, "Licensed under CC BY-NC 4.0."),
    (8, "x " * 60_000 + "\nLicensed under the Apache License, Version 2.0."), (9, "© 2021 Me\nLicenced under the Apache-Licence version 2.0"),
    (10, "Éa über licence\ncopyright law is law"),
]


def got(spark, tmp_path):
    spark.createDataFrame([(*r, "z", "y") for r in ROWS], "doc_id long, text string, digest string, licenses string").write.parquet(f"{tmp_path}/documents.parquet")
    return L.op4_license_scan(spark, str(tmp_path))


def test_variants(spark, tmp_path):
    rows = [tuple(r) for r in got(spark, tmp_path).collect()]
    assert len(rows) == len(ROWS)
    by = {}
    for doc_id, digest, whole, n, ids in rows:
        by.setdefault(doc_id, []).append((whole, n, ids))
    assert by[1][0] == ("MIT", 0, "MIT") == by[2][0]
    assert by[3] == [(None, 0, "")]
    assert sorted(by[4], key=str) == sorted([(None, 3, "MIT,all-rights-reserved"), ("CC-BY-NC-4.0", 1, "CC-BY-NC-4.0")], key=str)
    assert by[5] == by[6] == by[7] == [(None, 0, "")]
    assert by[None] == [("CC-BY-NC-4.0", 1, "CC-BY-NC-4.0")]
    assert by[8] == [(None, 1, "Apache-2.0")]
    assert by[9] == [("Apache-2.0", 1, "Apache-2.0")]
    assert by[10] == [(None, 0, "")]


def test_sql_says_the_same(spark, tmp_path):
    df = got(spark, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cur = con.execute(L.ORACLE_SQL)
    cols = [d[0] for d in cur.description]
    assert sorted(str(tuple(r)) for r in df.select(*cols).collect()) == sorted(map(str, cur.fetchall()))


def test_empty_and_own_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert L.scan(docs).collect() == []
    known = spark.createDataFrame([("B", "My text"), ("A", "my  TEXT."), ("C", None)], "license_id string, text string")
    out = L.scan(spark.createDataFrame([(1, "My, text"), (2, "no")], "doc_id long, text string"), known)
    assert {r.doc_id: (r.license_id, r.n_license_lines, r.licenses) for r in out.collect()} == {1: ("A", 1, "A,B"), 2: (None, 0, "")}


def test_published_files(spark):
    """Licence files as published, wrapped, with titles and holders; notices of other ids."""
    common = Path(L.__file__).with_name("licenses")
    wrapped = "\n".join(textwrap.fill(p, 76) for p in MIT.split("\n"))
    files = {"MIT": f"MIT License\n\nCopyright (c) 2021 Some Body\n\n{wrapped}\n", "ISC": "The ISC License\n\nCopyright (c) 2011-2023 Some Body and Contributors\n\n"
             + "\n".join(textwrap.fill(t, 70) for i, t in KNOWN if i == "ISC" and t.startswith("Permission") and len(t) > 500 and "rights reserved" not in t)}
    files |= {f.stem: f.read_text("utf-8") for f in common.glob("*.txt") if "_" not in f.stem}
    files["BSD-2-Clause"] = "BSD 2-Clause License\n\nCopyright (c) 2019, Some Body\nAll rights reserved.\n\n" + files["BSD-2-Clause"].replace("  * Redistributions of s", "1. Redistributions of s").replace("  * Redistributions in", "2. Redistributions in")
    assert len(files) > 20
    notices = [("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
               ("LGPL-2.1-or-later", "distributed under the terms of the GNU Lesser General Public License, version 2.1 or later"), ("AGPL-3.0-only", "Licensed under the AGPLv3."),
               ("BSD-3-Clause", "Released under the 3-clause BSD licence."), ("CC-BY-SA-4.0", "This work is licensed under a\nLicensed under CC BY-SA 4.0."), ("Unlicense", "SPDX-License-Identifier: Unlicense")]
    rows = [(i, t, n) for i, (n, t) in enumerate([*files.items(), *notices])]
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    for i, _, n in rows[:len(files)]:
        assert got[i].license_id in (n, f"{n}-only"), n
        assert n in got[i].licenses
    for i, _, n in rows[len(files):]:
        assert got[i].licenses.split(",")[0] == n, n


def test_copyright_statements(spark, tmp_path):
    """Only the statement goes: not the notice or licence after it, not a clause, also without a year."""
    flat = " ".join(MIT.split())
    clause = "You must retain, in the Source form of any Derivative Works,"
    rows = [(1, "Copyright (c) 2024 Acme. Released under the MIT License."), (2, "Copyright (c) 2020 X " + flat), (3, "Copyright Joyent, Inc. and contributors\n" + MIT),
            (4, "Copyright Joyent, Inc. and other Node contributors.\n" + MIT), (5, f"some words\n(c) {clause}"), (6, f"some words (c) {clause}"),
            (7, "Copyright 2020, 2021 Foo Bar <foo@bar.org> Licensed under the Apache License, Version 2.0."), (8, "COPYRIGHT HOLDERS AND CONTRIBUTORS\nbe liable"), (9, "copyright holders and contributors be liable"),
            (10, "words\r(c) 2020 Me\u2028© x\n © 2020 Me"), (11, "Copyright (c) 2020 " + "x" * 100_000 + "\n" + MIT), (12, "(c) 2020-2021 Foo, Inc. All rights reserved.")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = L.op4_license_scan(spark, str(tmp_path))
    got = {r.doc_id: r for r in df.collect()}
    assert [got[i].license_id for i in (1, 2, 3, 4, 7, 11, 12)] == ["MIT", "MIT", "MIT", "MIT", "Apache-2.0", "MIT", "all-rights-reserved"]
    assert got[5].digest == got[6].digest and got[8].digest == got[9].digest
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cur = con.execute(L.ORACLE_SQL)
    cols = [d[0] for d in cur.description]
    assert sorted(str(tuple(r)) for r in df.select(*cols).collect()) == sorted(map(str, cur.fetchall()))
