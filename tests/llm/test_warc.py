from __future__ import annotations

import base64
import hashlib

import pytest

from rarespark.llm import warc
from rarespark.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, sha1 string, holder int, block string, file string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "b", "f") for r in rows], SCHEMA)


def expected(rows, least=0):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids = [i for i, _, h in rows if (h or "").encode() == payload and i is not None]
        holder = max(ids) if ids and len(payload) >= least else page_id
        kind = ("response", None) if page_id == holder else ("revisit", holder)
        out.append((page_id, len(payload), digest, *kind))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://www.a.example:80/x?y=1#z", "same"),
    (5, "https://b.example/", "same"),
    (3, None, "same"),
    (4, "http://a.example/p q\r\nX: y", None),
    (6, "", ""),
    (7, "http://[bad", "<p>\r\n\r\nWARC/1.1\r\n\r\n</p>"),
    (8, "http://ä.example/ü", "é" * 70_000),
    (9, "http://c.example/", "repeated"),
    (9, "http://c.example/", "repeated"),
    (None, "http://d.example/", "no id"),
    (None, "http://d.example/", "same"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = warc.archive_round_trip(pages(spark, ROWS), least).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=repr) == expected(ROWS, least)


def test_empty_table(spark):
    assert warc.archive_round_trip(pages(spark, [])).collect() == []


def test_lookup_reads_what_is_asked_for(spark, monkeypatch):
    """Many small blocks; keys that are not there; equal keys over several blocks."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rows = [(i, f"http://h{i % 7}.example/{i % 11}", f"page {i}") for i in range(100)] + [(50, "http://h1.example/6", f"v{k}") for k in range(9)]
    folder = scratch_path(spark, "archive")
    blocks, directory = warc.build_index(warc.write_archive(pages(spark, rows), folder))
    assert len(directory) > 30 and directory == sorted(directory)
    wanted = pages(spark, [rows[3], rows[3], (50, "http://h1.example/6", ""), (1000, "http://h1.example/6", ""), (3, "http://zz.example/", "")])
    got = warc.lookup(wanted, blocks, directory, folder, with_payload=True).collect()
    assert sorted(bytes(r.payload) for r in got) == sorted([b"page 3", b"page 50", *(b"v%d" % k for k in range(9))])


def test_url_keys():
    assert warc.url_key("http://user@www.Site.Example:8080/a/b?c=d#e") == "example,site,www)/a/b?c=d"
    assert warc.url_key("www.site.example") == "example,site,www)/"
    assert warc.url_key(None) == ""
    assert "\t" not in warc.url_key("http://a/\tb\n")


def test_a_changed_payload_is_noticed():
    raw = warc.record(1, "http://a/", b"payload", None)
    assert warc.parse_record(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"payload\r\n", b"Payload\r\n"))
