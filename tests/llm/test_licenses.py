from __future__ import annotations

import hashlib
from pathlib import Path

import duckdb
import pytest
from llm_cases import edge_rows
from oracle_check import compare

from rarespark.llm import licenses as L


def report(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r for r in L.license_report(df).collect()}


def test_variants_of_a_licence(spark):
    other = L.MIT.replace("<year> <copyright holders>", "2024 Some One").replace('"AS IS"', "“as is”").replace("\n\n", "\n \r\n\t")
    other = other.replace("sublicense", "sub-licence").replace("License", "LICENCE")
    texts = [L.MIT, other, L.MIT + " One more word.", L.BSD_HEAD + L.BSD_TAIL, L.BSD_HEAD + L.BSD_THIRD + L.BSD_TAIL, "x\n" + L.ISC, L.ISC]
    got = report(spark, texts)
    assert [got[i].license_id for i in range(len(texts))] == ["MIT", "MIT", None, "BSD-2-Clause", "BSD-3-Clause", None, "ISC"]


def test_notices_and_spellings(spark):
    texts = [
        "Prose.\nReleased under the MIT Licence\nlicensed under the apache license version 2.0!",
        "Released under the MIT License, or so.",
        "Organised & unauthorised\n(c) 2020 Nobody\nAll rights reserved.",
        "organized and unauthorized",
    ]
    got = report(spark, texts)
    assert [got[i].notices for i in range(4)] == ["Apache-2.0,MIT", None, None, None]
    assert got[2].digest == got[3].digest == hashlib.sha256(b"organized and unauthorized").hexdigest()


def test_edge_cases(edge, empty):
    got = L.license_report(edge).collect()
    assert len(got) == len(edge_rows())
    blank = hashlib.sha256(b"").hexdigest()
    assert sorted(r.doc_id for r in got if r.digest == blank and r.doc_id) == [2, 3, 4]
    assert L.license_report(empty).collect() == []


def test_titles_and_statements_before_a_licence(spark):
    """Editions of one text under other titles, without one, and on a single line."""
    body = L.MIT.split("\n\n", 2)[2]
    isc = L.ISC.split("\n\n", 2)[2]
    bsd = L.BSD_HEAD + L.BSD_THIRD + L.BSD_TAIL
    bsd = bsd[bsd.index("Redistribution and use") :]
    texts = {
        "MIT": [body, "The MIT License (MIT)\n\nCopyright (c) 2019 A. Person\n\n" + body, ("MIT License Copyright (c) 2020 Some One " + body).replace("\n", " ")],
        "ISC": [isc, "ISC License (ISC)\n" + isc, "Copyright 2001 by Somebody, Inc. " + isc.replace("\n", " ")],
        "BSD-3-Clause": ["BSD 3-Clause License\n\nCopyright (c) 2018, X\nAll rights reserved.\n\n" + bsd, "The 3-Clause BSD License\n" + bsd],
    }
    rows = [(name, t) for name, own in texts.items() for t in own]
    got = report(spark, [t for _, t in rows])
    assert [got[i].license_id for i in range(len(rows))] == [name for name, _ in rows]
    prose = report(spark, ["The MIT License", "A story. " + body, "Copyright 2020 X. " + "Words that are no licence. " * 20])
    assert [prose[i].license_id for i in range(3)] == [None] * 3 and prose[2].digest != prose[0].digest


def test_the_twin_knows_the_digests():
    sql = L.report_sql()
    assert all(d in sql for _, d in L.KNOWN_DIGESTS)


def test_identifiers(spark):
    digests = [d for _, d in L.KNOWN_DIGESTS]
    assert len(set(digests)) == len(digests)
    got = report(spark, ["// SPDX-License-Identifier: GPL-2.0-or-later", "# SPDX-License-Identifier: MPL-2.0"])
    assert [got[i].notices for i in range(2)] == ["GPL-2.0", "MPL-2.0"]


def test_longer_licences(spark):
    path = "/usr/share/common-licenses/"
    names = [("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2"), ("LGPL-3.0", "LGPL-3"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0")]
    if not all(Path(path + file).exists() for _, file in names):
        pytest.skip("the system ships no licence texts")
    got = report(spark, [Path(path + file).read_text() for _, file in names])
    assert [got[i].license_id for i in range(len(names))] == [name for name, _ in names]


def test_twin_on_licence_texts(spark):
    """The SQL twin agrees where documents are licences, name them, or nearly are."""
    texts = [L.MIT, "The MIT License (MIT)\n" + L.MIT.split("\n\n", 2)[2], L.ISC, L.BSD_HEAD + L.BSD_TAIL, L.MIT + " more", None, "", "SPDX-License-Identifier: ISC"]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    df = L.license_report(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert compare(df, con, L.report_sql()) == ""
