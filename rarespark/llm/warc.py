"""WARC archives with a two-level capture index.

Writing: each task writes archives of its own, one gzip member per record, and returns a
line per capture. Only archives named in the committed lines count, so a task that is run
again leaves nothing wrong behind. Of equal payloads one record is a response, the others
are revisits that refer to it.

Index: capture lines sorted by reversed-host URL key are packed into compressed blocks; a
sparse directory has the first key of each block, at most ``DIRECTORY`` entries and one
per task, so its size is bounded whatever the number of captures. A lookup finds a key's
blocks by binary search in the directory, its lines by binary search in the block, and
then reads just the records' byte ranges.

Nulls: a null payload is empty, a null URL has an empty key and no target header, a null
id stays null. Rows that repeat an id get a record each; those that repeat the response's
id and payload are responses too. An empty table gives an empty archive and index.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rarespark.llm import words as W
from rarespark.session import cut_lineage, scratch_path

ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 3000
DIRECTORY = 1 << 16
READ_SPAN = 8 << 20
GAP = 64 << 10
DATE = "1970-01-01T00:00:00Z"

CAPTURE = "url_key string, page_id bigint, file string, offset bigint, length bigint"


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: ``com,example)/path?query``."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host = parts.hostname or ""
    except ValueError:
        return url
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + ")" + path if url else ""


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record. A revisit holds the HTTP headers, with the full payload's length, and no body."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", "sha1:" + _digest(payload)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields.append(("WARC-Refers-To", _urn(refers_to)))
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode().partition(":") for line in lines)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _from_urn(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def parse_record(raw: bytes) -> dict:
    """Fields of a record. A response's payload is measured and its digest checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _headers(lines[1:])
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    size = int(_headers(http.split(b"\r\n")[1:])["content-length"]) if revisit else len(payload)
    if not revisit and _digest(payload) != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {
        "page_id": _from_urn(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": _from_urn(fields.get("warc-refers-to")),
        "payload": None if revisit else payload,
    }


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as tasks need it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()
    return re.sub(r"^file:/+", "file:///", full)


def _write(folder: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            lines = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                packer = zlib.compressobj(wbits=31)
                member = packer.compress(record(page_id, url, (html or "").encode(), refers_to)) + packer.flush()
                out.write(member)
                lines.append((url_key(url), page_id, name, at, len(member)))
                at += len(member)
            columns = list(zip(*lines, strict=True)) or [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["url_key", "page_id", "file", "offset", "length"]
            )
        if out is not None:
            out.close()

    return rows


def write_archive(pages: DataFrame, folder: str, min_payload: int = 0) -> DataFrame:
    """Writes a record per row of ``pages (page_id, url, html)`` and returns the capture lines.

    Payloads of at least ``min_payload`` bytes are stored once: the record with the largest
    id is the response, the others revisit it.
    """
    spark = pages.sparkSession
    W.bounded_batches(spark)
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", F.sha1(html.cast("binary")).alias("sha1"))
    shared = (
        rows.where(F.octet_length(html) >= min_payload)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha1", "holder")
    )
    joined = rows.join(cut_lineage(shared, "payloads"), "sha1", "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder"))
    marked = joined.select("page_id", "url", "html", refers_to.alias("refers_to"))
    return cut_lineage(marked.mapInArrow(_write(_qualified(spark, folder)), CAPTURE), "captures")


def _pack(lines: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def block(some):
            text = "\n".join("\t".join("" if x is None else str(x) for x in line) for line in some)
            data = pa.array([zlib.compress(text.encode())], pa.binary())
            first = [pa.array([some[0][0]], pa.string()), pa.array([some[0][1]], pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), *first, data], ["block", "url_key", "page_id", "data"])

        for batch in batches:
            waiting.extend(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            while len(waiting) >= lines:
                yield block(waiting[:lines])
                waiting = waiting[lines:]
        if waiting:
            yield block(waiting)

    return rows


def build_index(captures: DataFrame) -> tuple[DataFrame, list[tuple[str, int, str]]]:
    """Compressed blocks of sorted capture lines, and their sparse directory."""
    n = captures.count()
    lines = max(BLOCK_LINES, -(-n // DIRECTORY))
    order = ["url_key", "page_id", "file", "offset"]
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = cut_lineage(
        ordered.mapInArrow(_pack(lines), "block string, url_key string, page_id bigint, data binary"), "capture-blocks"
    )
    found = blocks.select("url_key", "page_id", "block").collect()  # DIRECTORY entries and one per task at most
    return blocks, sorted((r["url_key"], _rank(r["page_id"]), r["block"]) for r in found)


def _rank(page_id: int | None) -> int:
    """Nulls sort first, as in Spark."""
    return -(1 << 63) - 1 if page_id is None else page_id


def _route(directory: list[tuple[str, int, str]]):
    firsts = [(key, rank) for key, rank, _ in directory]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, keys, ids = [], [], []
            for page_id, url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wanted = (url_key(url), _rank(page_id))
                first = max(0, bisect.bisect_left(firsts, wanted) - 1)
                for at in range(first, bisect.bisect_right(firsts, wanted)):
                    blocks.append(directory[at][2])
                    keys.append(wanted[0])
                    ids.append(page_id)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.string()), pa.array(keys, pa.string()), pa.array(ids, pa.int64())], ["block", "url_key", "page_id"]
            )

    return rows


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block, its data first, then the keys that are looked for."""
    lines, keys = [], []
    for batch in batches:
        found = []
        for _, key, page_id, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if data is not None:
                lines = [x.split("\t") for x in zlib.decompress(data).decode().split("\n")]
                keys = [(x[0], _rank(int(x[1]) if x[1] else None)) for x in lines]
                continue
            wanted = (key, _rank(page_id))
            at = bisect.bisect_left(keys, wanted)
            while at < len(keys) and keys[at] == wanted:
                found.append((lines[at][2], int(lines[at][3]), int(lines[at][4])))
                at += 1
        columns = list(zip(*found, strict=True)) or [[]] * 3
        kinds = [pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "offset", "length"])


RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _read(folder: str, with_payload: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        name, source = None, None
        for batch in batches:
            ranges = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            at = 0
            while at < len(ranges):
                file, begin, _ = ranges[at]
                last, end = at, begin
                while last < len(ranges) and ranges[last][0] == file and ranges[last][1] - end <= GAP and end - begin < READ_SPAN:
                    end = max(end, ranges[last][1] + ranges[last][2])
                    last += 1
                if file != name:
                    name, source = file, system.open_input_file(f"{base}/{file}")
                raw = source.read_at(end - begin, begin)
                found = [parse_record(zlib.decompress(raw[o - begin : o - begin + n], wbits=31)) for _, o, n in ranges[at:last]]
                if not with_payload:
                    for x in found:
                        x["payload"] = None
                yield pa.RecordBatch.from_pylist(found, RECORD)
                at = last

    return rows


def lookup(
    wanted: DataFrame, blocks: DataFrame, directory: list[tuple[str, int, str]], folder: str, with_payload: bool = False
) -> DataFrame:
    """Records of the captures ``wanted (page_id, url)``, each found through the index."""
    spark = wanted.sparkSession
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    keys = wanted.select(F.col("page_id").cast("bigint").alias("page_id"), "url").mapInArrow(
        _route(directory), "block string, url_key string, page_id bigint"
    )
    keys = keys.distinct().withColumn("data", F.lit(None).cast("binary"))
    both = keys.unionByName(blocks.select("block", "url_key", "page_id", "data"))
    sorted_ = both.repartition("block").sortWithinPartitions("block", F.col("data").isNull())
    found = sorted_.select("block", "url_key", "page_id", "data").mapInArrow(_search, "file string, offset bigint, length bigint")
    spans = found.repartition("file", F.floor(F.col("offset") / READ_SPAN)).sortWithinPartitions("file", "offset")
    return spans.mapInArrow(_read(_qualified(spark, folder), with_payload), schema)


def archive_round_trip(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and reads every record back by its URL key."""
    folder = scratch_path(pages.sparkSession, "archive")
    captures = write_archive(pages, folder, min_payload)
    blocks, directory = build_index(captures)
    return lookup(pages, blocks, directory, folder).drop("payload")
