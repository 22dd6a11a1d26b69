"""Licence scans: entire texts are looked up by the digest of their canonical form.

A text is brought to a canonical form line by line: characters that stand for ASCII ones
and capitals are replaced, copyright lines and "all rights reserved" go, punctuation and
white space become single spaces, and spellings that licences use side by side become one.
The SHA-256 of the lines that are left, joined by spaces, is hash-joined with the digests
of known licences. Single lines are looked up in the same way among known notices.

The known texts are a fixed short list, so the join sends them to every task; documents
are not shuffled. Everything is made of SQL functions.

Nulls: a null text counts as empty, matches nothing and has the digest of the empty text.
Every input row gives one result row. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Capitals and typographic signs with what stands for them.
FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ‘’“”–—• \r"
TO = "abcdefghijklmnopqrstuvwxyz''\"\"--*  "

#: A longer line that starts with a copyright statement holds more than that.
COPYRIGHT_CHARS = 200
COPYRIGHT_LINE = r"^[^a-z0-9]*(copyright|\(c\)|©)"
RIGHTS_LINE = r"^[^a-z0-9]*all rights reserved[^a-z0-9]*$"

# Spellings that the same licence is found with.
FIXED_SPELLINGS = [
    ("&", " and "),
    ("licence", "license"),
    ("licencing", "licensing"),
    ("sub-license", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"),
    ("non-commercial", "noncommercial"),
    ("per cent", "percent"),
    ("wilful", "willful"),
    ("whilst", "while"),
    ("favour", "favor"),
    ("http://", "https://"),
]
PATTERN_SPELLINGS = [
    (r"([a-z]{3})is(e|es|ed|ing|ation|ations)([^a-z]|$)", "iz"),
]

# Titles that short licences stand under, and the words that they begin with.
TITLE = (
    "(?:the )?(?:mit|expat|isc|0bsd|new bsd|modified bsd|simplified bsd|bsd zero clause|zero clause bsd|bsd [023] clause|[023] clause bsd)"
    "(?: new or revised| new| revised| simplified| clear)?(?: license)?(?: (?:mit|expat|isc|0bsd|bsd [023] clause))?"
)
OPENING = "permission is hereby granted free|permission to use copy modify and or|redistribution and use in source and binary"
#: Title and copyright statements before the words of a licence, in the joined canonical text.
HEAD = f"^(?:{TITLE} )?(?:(?:copyright|c) .{{1,300}}? )?({OPENING})"

# Texts of licences.
MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """ISC License

Copyright <year> <holder>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Copyright (c) <year>, <holder>
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZERO_BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

KNOWN_TEXTS = [
    ("MIT", MIT),
    ("ISC", ISC),
    ("BSD-2-Clause", BSD_HEAD + BSD_TAIL),
    ("BSD-3-Clause", BSD_HEAD + BSD_THIRD + BSD_TAIL),
    ("0BSD", ZERO_BSD),
]
# SHA-256 of the canonical form of longer licences, whose texts are not held here.
KNOWN_DIGESTS = [
    ("Apache-2.0", "4a1a663a4efcefc0364f800b0bc81b8311834875d59e3e1ed84e6b02a6e31382"),
    ("Apache-2.0", "925c8f6d9819c574ae4c7535292f664ea2a1b96ce90f8053ecca5a2b1af0f46c"),
    ("Artistic-1.0-Perl", "d397409846a7661a252bdab7aca93c4612ba2cb1e772c1998944845269fe83f9"),
    ("CC-BY-SA-4.0", "54f899de20b9f23fc967c93e3930a3765ac1a0fb1d6b84746989a4378263f702"),
    ("CC0-1.0", "97098b9d4d582064b16255ff38f4b45a41ecce484eb98a46cdb15423d6de9f85"),
    ("GFDL-1.2", "50516456b02d21f3eddc795284661170883e70f6d17ae784f9179cae739d38b7"),
    ("GFDL-1.3", "5088e9395e3dcb3233d7f0bb02cbbb2fbe4a5065ec192be935776131bb442272"),
    ("GPL-1.0", "dc4ab9dc141a33fdf0133134066fa6cddef1e5a0fb4b6d41c3c0d9fa2e388cd7"),
    ("GPL-2.0", "39786d77d59c9dcee9f793a165fe6882769aac80c3eed377b53bab5a98f64160"),
    ("GPL-3.0", "6284a3a71cb0d08b9d8e4153de7150d4397b5e0ea12cd9ab5ebb8956cd9c77c0"),
    ("LGPL-2.0", "50a7bea776fc56f5fceaa3ffb6b508fb11a181a9036a85d1267979f5ae7a9ddd"),
    ("LGPL-2.1", "708fb2d2c8a288a5e4f6fc45d31a8a243db8c27391fbd5af84e6bde59e9d99fa"),
    ("LGPL-3.0", "9111884d93a72b30a3d024876dab3d755949ac2cfab230268a4169a93b86560c"),
    ("MPL-1.1", "b7d84d01c490426450a25a5574202d0f29938da7cc154ed71d4a82e1144e7079"),
    ("MPL-2.0", "432d99d886fc485f7207957350103a31e64bcfa23f6674f66f21946d400c0f72"),
    ("Unlicense", "4ae7848544d20cbba7a0aa7b97c639923ad45dcf84514ca0d1afb78ae3d66c3e"),
]
# One-line notices.
KNOWN_NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("0BSD", "SPDX-License-Identifier: 0BSD"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("Artistic-2.0", "SPDX-License-Identifier: Artistic-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSL-1.0", "SPDX-License-Identifier: BSL-1.0"),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("EPL-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("GFDL-1.3", "SPDX-License-Identifier: GFDL-1.3-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("MPL-1.1", "SPDX-License-Identifier: MPL-1.1"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    ("Zlib", "SPDX-License-Identifier: Zlib"),
]


def canonical_line(line: Column) -> Column:
    """Canonical form of a line; empty for copyright lines."""
    line = F.translate(line, FROM, TO)
    bare = (line.rlike(COPYRIGHT_LINE) & (F.length(line) <= COPYRIGHT_CHARS)) | line.rlike(RIGHTS_LINE)
    line = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), FIXED_SPELLINGS, line)
    for pattern, middle in PATTERN_SPELLINGS:
        line = F.regexp_replace(line, pattern, f"$1{middle}$2$3")
    line = F.trim(F.regexp_replace(line, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(bare, F.lit("")).otherwise(line)


def canonical_lines(text: Column) -> Column:
    """The lines that say something, in canonical form."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), canonical_line)
    return F.filter(lines, lambda line: line != "")


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def canonical_text(lines: Column) -> Column:
    """The lines as one text, without a short licence's title and copyright statement."""
    return F.regexp_replace(F.array_join(lines, " "), HEAD, "$1")


def known_table(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """``(license_id, digest)`` of a short list of texts."""
    rows = spark.createDataFrame(texts, "license_id string, text string")
    return rows.select("license_id", _digest(canonical_text(canonical_lines(F.col("text")))).alias("digest")).distinct()


def license_report(docs: DataFrame, texts=None, notices=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, license_id, notices)`` per row: the licence that the entire text
    is, and those that its lines name, in order and separated by commas (else null)."""
    spark = docs.sparkSession
    known = known_table(spark, texts or KNOWN_TEXTS)
    if not texts:
        known = known.unionByName(spark.createDataFrame(KNOWN_DIGESTS, "license_id string, digest string"))
    lines = known_table(spark, notices or KNOWN_NOTICES).select(F.struct("digest", "license_id").alias("n"))
    # A short fixed list: as a map it is looked up line by line without a join.
    names = {r["n"]["digest"]: r["n"]["license_id"] for r in lines.collect()}
    digests = F.array(*[F.lit(d) for d in sorted(names)])
    licenses = F.array(*[F.lit(names[d]) for d in sorted(names)])
    longest = max(len(t) for _, t in (notices or KNOWN_NOTICES)) * 6
    canonical = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), canonical_lines(F.col(text_col)).alias("lines"))

    def name_of(line: Column) -> Column:
        return F.try_element_at(licenses, F.nullif(F.array_position(digests, _digest(line)), F.lit(0)).cast("int"))

    short = F.filter("lines", lambda line: F.length(line) <= longest)
    found = F.array_sort(F.array_distinct(F.array_compact(F.transform(short, name_of))))
    named = canonical.select(
        "doc_id", _digest(canonical_text(F.col("lines"))).alias("digest"), F.when(F.size(found) > 0, F.array_join(found, ",")).alias("notices")
    )
    return named.join(F.broadcast(known), "digest", "left").select("doc_id", "digest", "license_id", "notices")


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def canonical_lines_sql(text: str) -> str:
    """The same form in the dialect of the SQL twin."""
    line = f"translate(raw, {_sql_text(FROM)}, {_sql_text(TO)})"
    bare = f"((regexp_matches({line}, {_sql_text(COPYRIGHT_LINE)}) and length({line}) <= {COPYRIGHT_CHARS}) or regexp_matches({line}, {_sql_text(RIGHTS_LINE)}))"
    body = reduce(lambda c, pair: f"replace({c}, {_sql_text(pair[0])}, {_sql_text(pair[1])})", FIXED_SPELLINGS, line)
    for pattern, middle in PATTERN_SPELLINGS:
        body = f"regexp_replace({body}, {_sql_text(pattern)}, '\\1{middle}\\2\\3', 'g')"
    body = f"trim(regexp_replace({body}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'))"
    lines = f"list_transform(string_split(coalesce({text}, ''), chr(10)), lambda raw: case when {bare} then '' else {body} end)"
    return f"list_filter({lines}, lambda x: x <> '')"


def report_sql() -> str:
    def values(rows):
        return ", ".join(f"({_sql_text(name)}, {_sql_text(text)})" for name, text in rows)

    def digest(lines: str) -> str:
        return f"sha256(regexp_replace(array_to_string({lines}, ' '), {_sql_text(HEAD)}, '\\1'))"

    return f"""with d as (select doc_id, {canonical_lines_sql('text')} as lines from documents),
    known as (select distinct license_id, {digest(canonical_lines_sql('text'))} as digest
              from (values {values(KNOWN_TEXTS)}) t(license_id, text)
              union select license_id, digest from (values {values(KNOWN_DIGESTS)}) t(license_id, digest)),
    notice as (select distinct license_id, array_to_string({canonical_lines_sql('text')}, ' ') as line
               from (values {values(KNOWN_NOTICES)}) t(license_id, text)),
    named as (select doc_id, string_agg(license_id, ',' order by license_id) as notices from (
              select distinct doc_id, license_id from (select doc_id, unnest(lines) as line from d) join notice using (line))
              group by doc_id),
    k as (select doc_id, {digest('lines')} as digest from d)
    select doc_id, digest, license_id, notices from k left join known using (digest) left join named using (doc_id)"""
