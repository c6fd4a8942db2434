"""WARC archives: writing, normalising monolithic gzip files, reading by offset.

``write_monolithic`` writes one WARC record per page, a whole file being one gzip stream, as archives from
careless tools are: readable from the start only. ``normalise`` inflates each such file once, as a stream,
rewrites every record as a gzip member of its own and writes a sidecar index (``.idx``, one JSON line per
record: record id, type, offset and length of its member). ``read`` takes the members by that index.

Equal payloads of at least ``min_bytes`` bytes are stored once: the record of the largest page id is the
response, the others are revisits that name it and hold the HTTP header only, with the length of the full
payload. Smaller payloads are always responses. Rows that repeat both the id and the payload of the
response are responses too. A page without id can be a response for null ids only.

Payload: the html in UTF-8; null is an empty payload. Line breaks in a URL are percent-encoded; a null URL
has no target header. Ids may be null. An empty table gives no files. Columns other than page_id, url and
html are ignored. Tasks write files under names of their own and a manifest that Spark commits says which
count; a task holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import file_at, fresh_folder, ship
from basketry.session import materialise

DATE = "1970-01-01T00:00:00Z"
_CHUNK = 1 << 20
_END = b"\r\n\r\n"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    value = record_id.rsplit(":", 1)[1].rstrip(">")
    return None if value == "null" else int(value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [
            f"WARC-Refers-To: {_record_id(refers_to)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END + block + _END


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, value in pairs}


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of a record."""
    head, _, rest = data.partition(_END)
    fields = _fields(head)
    return fields, rest[: int(fields["content-length"])]


def records(source, chunk: int = _CHUNK) -> Iterator[bytes]:
    """The records of a gzip stream of one or many members, one after the other."""
    inflate, held = zlib.decompressobj(31), bytearray()
    need = -1
    while True:
        data = source.read(chunk)
        if not data:
            break
        while data:
            held += inflate.decompress(data)
            data = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            while True:
                if need < 0:
                    at = held.find(_END)
                    if at < 0:
                        break
                    need = at + 4 + int(_fields(bytes(held[:at]))["content-length"]) + 4
                if len(held) < need:
                    break
                yield bytes(held[:need])
                del held[:need]
                need = -1
    if held:
        raise ValueError("the archive ends inside a record")


def _open_new(folder: str, suffix: str):
    path = f"{folder}/{uuid.uuid4().hex}{suffix}"
    files, inner = file_at(path)
    files.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return path, files.open_output_stream(inner, compression=None)


def _one(path: str | None, count: int) -> Iterator[pa.RecordBatch]:
    if path is not None:
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64())], names=["path", "records"])


def write_monolithic(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, level: int = 1) -> DataFrame:
    """Write the archives; returns their manifest (path, records)."""
    ship(pages.sparkSession)
    folder = folder or fresh_folder(pages.sparkSession, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))

    def digested(batches: Iterator[pa.RecordBatch], kept: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [digest_of(h.as_py().encode()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(digests, pa.string())], names=[*kept, "digest"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, stream, squeeze, count = None, None, zlib.compressobj(level, zlib.DEFLATED, 31), 0
        for batch in batches:
            names = ("page_id", "url", "html", "digest", "response_id")
            for page_id, url, html, digest, response in zip(*(batch.column(n) for n in names), strict=True):
                if stream is None:
                    path, stream = _open_new(folder, ".warc.gz")
                payload, page, target = html.as_py().encode(), page_id.as_py(), response.as_py()
                revisit = target is not None and target != page
                stream.write(squeeze.compress(record(page, url.as_py(), payload, digest.as_py(), target, revisit)))
                count += 1
        if stream is not None:
            stream.write(squeeze.flush())
            stream.close()
        yield from _one(path, count)

    # The first pass sends on digests only; the second carries the payloads to their files.
    large = rows.filter(F.octet_length("html") >= min_bytes).select("page_id", "html")
    digests = large.mapInArrow(lambda b: digested(b, ("page_id",)), "page_id long, digest string")
    latest = digests.groupBy("digest").agg(F.max("page_id").alias("response_id"))
    keyed = rows.mapInArrow(lambda b: digested(b, ("page_id", "url", "html")), "page_id long, url string, html string, digest string")
    joined = keyed.join(latest, "digest", "left")
    return materialise(joined.mapInArrow(write, "path string, records long"), "warc-manifest")


def normalise(manifest: DataFrame, folder: str | None = None, level: int = 6) -> DataFrame:
    """Rewrite every file of the manifest, one member per record; returns the manifest of the new files."""
    ship(manifest.sparkSession)
    folder = folder or fresh_folder(manifest.sparkSession, "warc-normal")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for old in batch.column("path").to_pylist():
                files, inner = file_at(old)
                path, out = _open_new(folder, ".warc.gz")
                to, name = file_at(path + ".idx")
                offset = count = 0
                with files.open_input_stream(inner, compression=None) as source, to.open_output_stream(name, compression=None) as index, out:
                    for data in records(source):
                        squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = squeeze.compress(data) + squeeze.flush()
                        out.write(member)
                        fields = _fields(data[: data.find(_END)])
                        line = {"id": fields["warc-record-id"], "type": fields["warc-type"], "offset": offset, "length": len(member)}
                        index.write(json.dumps(line).encode() + b"\n")
                        offset += len(member)
                        count += 1
                yield from _one(path, count)

    spread = manifest.repartition(max(1, manifest.count()))
    return materialise(spread.mapInArrow(rewrite, "path string, records long"), "warc-normal-manifest")


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def member(source, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """The record at an offset of a normalised archive."""
    source.seek(offset)
    return parse(zlib.decompress(source.read(length), 31))


def read(manifest: DataFrame) -> DataFrame:
    """The records of normalised archives, each taken by its place in the sidecar index. The payload of
    a response is hashed again; a difference from its header raises."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, inner = file_at(path)
                found = []
                with files.open_input_file(inner) as source, files.open_input_stream(inner + ".idx", compression=None) as index:
                    for line in _lines(index):
                        place = json.loads(line)
                        fields, block = member(source, place["offset"], place["length"])
                        http, _, payload = block.partition(_END)
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        revisit = fields["warc-type"] == "revisit"
                        size = int(_fields(http)["content-length"])
                        if not revisit and (len(payload) != size or digest_of(payload) != digest):
                            raise ValueError(f"{path}: the record at {place['offset']} is damaged")
                        target = _page_id(fields["warc-refers-to"]) if revisit else None
                        found.append((_page_id(fields["warc-record-id"]), size, digest, fields["warc-type"], target, fields.get("warc-target-uri")))
                        if len(found) == 5000:
                            yield _records(found)
                            found = []
                yield _records(found)

    ship(manifest.sparkSession)
    spread = manifest.select("path").repartition(max(1, manifest.count()))
    return spread.mapInArrow(load, RECORD)


def _lines(source) -> Iterator[bytes]:
    held = b""
    while data := source.read(_CHUNK):
        *lines, held = (held + data).split(b"\n")
        yield from lines


def _records(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[p.split()[0] for p in RECORD.split(", ")])


def read_sql() -> str:
    """What writing, normalising and reading give, as DuckDB SQL over ``pages``."""
    value = " + ".join(f"{16 >> j} * (instr('01', substr(bits, 5 * i + {j + 1}, 1)) - 1)" for j in range(5))
    return f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, array_to_string(list_transform(range(40),
  lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][instr('0123456789abcdef', substr(hex, i + 1, 1))]), '') AS bits FROM payloads),
digests AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32),
  lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {value}, 1)), '') AS payload_digest FROM bits),
latest AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response_id FROM digests)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN response_id IS NOT DISTINCT FROM page_id OR response_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN response_id IS DISTINCT FROM page_id THEN response_id END AS refers_to
FROM latest"""
