"""Operator 10: WARC archives, index first.

Writing: each task streams its rows into archive files under a shared folder (one gzip member
per record, a new file every ``FILE_BYTES``) and returns one index row per record: file,
offset, length, URL, digest. A file gets a new name in every task attempt and only the index
of the successful attempt names it, so a retried task leaves at most an unread file behind.
Reading: the index rows of the wanted records are dealt out by (file, offset range), sorted,
and neighbouring byte ranges are joined into one read before the members are parsed.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with the largest id is
written as response and the others as revisits of it; shorter payloads are all responses.

Defined results: a null payload is the empty payload; a null URL gives a record without
target URI; where all rows of a payload have a null id, all are responses, and a null id
beside others is a revisit. Rows are never merged: repeated rows give repeated records, all of
them responses where they share both payload and largest id.
Files are reached through ``pyarrow.fs`` by the URI of the shared folder.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.llm.common import materialise, scratch_path, table

FILE_BYTES = 256 << 20          # an archive file is closed beyond this size
READ_BYTES = 8 << 20            # most bytes of one joined read (a longer record is read whole)
GAP_BYTES = 64 << 10            # ranges this near are joined
BLOCK_BYTES = 64 << 20          # offsets of one block go to one reading task
DATE = "2024-01-01T00:00:00Z"   # WARC-Date of all records: output does not depend on the clock
INDEX = "id {id}, file string, offset long, length long, url string, payload_digest string, record_type string"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    uri = re.sub("^s3[an]://", "s3://", uri)         # Hadoop's names of that store
    return pafs.FileSystem.from_uri(uri if re.match(r"[a-z0-9+.-]+:", uri) else f"file://{uri}")


# One record ----------------------------------------------------------------------------
def _urn(record_id) -> str:
    return f"<urn:x-record:{record_id}>"


def record_bytes(record_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record, uncompressed. A revisit carries the HTTP head without the payload, and the
    payload's length in a header of its own."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(record_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT}"]
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers in lower case, payload) of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Deciding the record type ----------------------------------------------------------------
def record_types(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``rows`` (id, url, payload) with ``_refers_to``: null for a response."""
    keyed = rows.withColumn("_sha", F.unhex(F.sha1("payload")))
    copies = (keyed.filter(F.length("payload") >= min_bytes).groupBy("_sha")
              .agg(F.max("id").alias("_last"), F.count(F.lit(1)).alias("_n")).filter("_n > 1 and _last is not null"))
    # A written table, so that a payload with very many copies can be split in the join.
    joined = keyed.join(materialise(copies, "copies").withColumnRenamed("_sha", "_s"), F.col("_sha") == F.col("_s"), "left")
    other = F.col("_last").isNotNull() & ~F.col("id").eqNullSafe(F.col("_last"))
    return joined.select("id", "url", "payload", F.when(other, F.col("_last")).alias("_refers_to"))


# Writing ---------------------------------------------------------------------------------
def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write (id, url, payload, _refers_to) rows as archives; the index, one row per record."""
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "file", "offset", "length", "url", "payload_digest", "record_type"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, file, at, index = None, "", 0, []

        def flush():
            cols = list(zip(*index, strict=True)) if index else [[]] * 7
            types = [id_type, pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for b in batches:
            id_type = b.schema.field("id").type
            for rid, url, payload, to in zip(*(b.column(i) for i in range(4)), strict=True):
                rid, url, raw, to = rid.as_py(), url.as_py(), payload.as_py() or b"", to.as_py()
                if out is None:
                    file = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, at = fs.open_output_stream(f"{root}/{file}", compression=None), 0
                digest = payload_digest(raw)
                z = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = z.compress(record_bytes(rid, url, raw, digest, to)) + z.flush()
                out.write(member)
                index.append((rid, file, at, len(member), url, digest, "response" if to is None else "revisit"))
                at += len(member)
                if at >= FILE_BYTES:
                    out.close()
                    out = None
                    yield flush()
                    index.clear()
        if out is not None:
            out.close()
            yield flush()

    return rows.select("id", "url", "payload", "_refers_to").mapInArrow(run, INDEX.format(id=kind))


# Reading ---------------------------------------------------------------------------------
def joined_ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[int]]]:
    """(file, offset, length, members) reads of rows (file, offset, length) sorted by file and
    offset; members are positions in ``rows``."""
    file, start, end, members = None, 0, 0, []
    for i, (f, o, n) in enumerate(rows):
        if members and (f != file or o - end > GAP_BYTES or max(end, o + n) - start > READ_BYTES):
            yield file, start, end - start, members
            members = []
        if not members:
            file, start, end = f, o, o
        members.append(i)
        end = max(end, o + n)
    if members:
        yield file, start, end - start, members


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of the records
    that ``index`` names. A response's digest is computed from what was read and must equal
    the index's; a revisit has a null payload and its headers' length and digest."""
    kind = index.schema["id"].dataType.simpleString()
    dealt = index.repartition("file", (F.col("offset") / BLOCK_BYTES).cast("long")).sortWithinPartitions("file", "offset")
    schema = f"id {kind}, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string"
    names = ["id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def one(fields: dict[str, str], payload: bytes, want: str):
        kind_, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
        if kind_ == "response":
            digest = payload_digest(payload)
        if digest != want:
            raise ValueError(f"{fields['warc-record-id']}: payload digest {digest}, index {want}")
        to = fields.get("warc-refers-to")
        return (payload if kind_ == "response" else None, int(fields["x-payload-length"]) if kind_ == "revisit" else len(payload),
                digest, kind_, to and to.removeprefix("<urn:x-record:").removesuffix(">"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for b in batches:
            col = {n: b.column(b.schema.get_field_index(n)) for n in ("file", "offset", "length", "payload_digest", "id", "url")}
            rows = list(zip(*(col[n].to_pylist() for n in ("file", "offset", "length")), strict=True))
            want = col["payload_digest"].to_pylist()
            for file, start, length, members in joined_ranges(rows):
                with fs.open_input_file(f"{root}/{file}") as f:
                    f.seek(start)
                    data = memoryview(f.read(length))
                got = []
                for i in members:
                    at = rows[i][1] - start
                    got.append(one(*parse_record(zlib.decompress(data[at:at + rows[i][2]], 31)), want[i]))
                lo = members[0]
                arrays = [col["id"].slice(lo, len(members)), col["url"].slice(lo, len(members))]
                types = [pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string()]
                arrays += [pa.array(c, t) for c, t in zip(zip(*got, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return dealt.select("id", "file", "offset", "length", "url", "payload_digest").mapInArrow(run, schema)


def archive_and_read(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                     min_bytes: int = 0) -> DataFrame:
    """Write every row, then read every record back through the index."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("string").cast("binary").alias("payload"))
    index = materialise(write_archives(record_types(rows, min_bytes), folder), "warc-index")
    return read_records(index, folder)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    back = archive_and_read(pages, scratch_path(spark, "warc"))
    return back.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(pages.schema["page_id"].dataType).alias("refers_to"))
