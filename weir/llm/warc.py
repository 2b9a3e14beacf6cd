"""WARC archives: write records with an index, and read selected records back by byte ranges.

Each task writes one archive, every record a gzip member of its own, and returns an index row per record.
The index becomes a table by Spark's commit, so it names only archives of tasks that succeeded; what a lost or
doubled task leaves behind is never read. To read, the selected records' places are sorted and joined to ranges,
and a task fetches its ranges with one read each.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import SLICE, stored
from weir.workspace import scratch

_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC/1.1 record; with ``refers_to`` a revisit, which holds the HTTP header but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{_ID}{quote(page or '')}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_ID}{quote(refers_to)}>", f"WARC-Profile: {_REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """WARC header fields by lower-case name, the payload's length as HTTP tells it, and the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return fields, size, payload


def gzipped(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def with_first_copies(pages: DataFrame, least_bytes: int, id: str, url: str, html: str) -> DataFrame:
    """(id, url, payload, digest, refers_to): refers_to is the smallest id with the same payload, unless it is the row's own."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    copies = (
        rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    )
    own = F.coalesce(F.col("id") == F.col("first"), F.lit(False))
    return rows.join(copies, "digest", "left").select(
        "id", "url", "payload", "digest", F.when(~own, F.col("first").cast("string")).alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 100, level: int = 6, date: str = "1970-01-01T00:00:00Z",
    id: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """Write a record per row into archives under ``folder``; returns the stored index.

    Index: (file, offset, length, id, url, digest). Of rows with equal payloads of at least ``least_bytes``
    bytes, those with the smallest id are responses, the others revisit it.
    """
    rows = with_first_copies(pages, least_bytes, id, url, html).withColumn("name", F.col("id").cast("string"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        file, out, offset = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    some = batch.slice(at, SLICE)
                    offsets, lengths = [], []
                    out = out or system.open_output_stream(f"{path}/{file}", compression=None)
                    for name, url_, payload, digest, refers in zip(*(some.column(c).to_pylist() for c in ("name", "url", "payload", "digest", "refers_to"))):
                        data = gzipped(record(name, url_, payload, digest, refers, date), level)
                        out.write(data)
                        offsets.append(offset)
                        lengths.append(len(data))
                        offset += len(data)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file] * len(offsets), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()),
                         some.column("id"), some.column("url"), some.column("digest")],
                        ["file", "offset", "length", "id", "url", "digest"])
        finally:
            if out is not None:
                out.close()

    kind = rows.schema["id"].dataType.simpleString()
    return stored(rows.mapInArrow(write, f"file string, offset long, length long, id {kind}, url string, digest string"), "warc-index")


def byte_ranges(index: DataFrame, gap: int, most: int) -> DataFrame:
    """(file, start, stop, records): neighbouring records of a file at most ``gap`` bytes apart, ranges cut every ``most`` bytes.

    A window walks the records of one archive, which is as long as one task's share of the input.
    """
    by_file = Window.partitionBy("file").orderBy("offset")
    before = F.lag(F.col("offset") + F.col("length")).over(by_file)
    new = before.isNull() | (F.col("offset") - before > gap) | (F.floor(F.col("offset") / most) > F.floor(F.lag("offset").over(by_file) / most))
    numbered = index.withColumn("_new", F.when(new, 1).otherwise(0)).withColumn("_range", F.sum("_new").over(by_file))
    return numbered.groupBy("file", "_range").agg(
        F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop"),
        F.sort_array(F.collect_list(F.struct("offset", "length", "digest"))).alias("records"),
    ).drop("_range")


def read_records(index: DataFrame, folder: str, gap: int = 1 << 16, most: int = 1 << 22, with_payload: bool = True) -> DataFrame:
    """The records of the index rows given, read from the archives under ``folder``.

    (page, url, record_type, payload_bytes, payload_digest, refers_to, payload): page ids as text, empty for a
    null id; a revisit has a null payload. A response whose payload does not have the indexed digest raises an
    error.
    """
    ranges = byte_ranges(index.select("file", "offset", "length", "digest"), gap, most)
    rows = ranges.repartition("file", "start").sortWithinPartitions("file", "start")
    names = ["page", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * with_payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()][:len(names)]
        name, source = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != name:
                    if source is not None:
                        source.close()
                    name, source = row["file"], system.open_input_file(f"{path}/{row['file']}")
                data = source.read_at(row["stop"] - row["start"], row["start"])
                out = []
                for place in row["records"]:
                    at = place["offset"] - row["start"]
                    fields, size, payload = parse(zlib.decompress(data[at:at + place["length"]], 31))
                    digest, response = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"] == "response"
                    if digest != place["digest"] or response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{name} at {place['offset']}: the payload does not have the digest {place['digest']}")
                    refers = fields.get("warc-refers-to")
                    out.append((
                        fields["warc-record-id"][len(_ID) + 1:-1], fields.get("warc-target-uri"), fields["warc-type"], size, digest,
                        refers and refers[len(_ID) + 1:-1], payload if response else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        if source is not None:
            source.close()

    schema = "page string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string" + ", payload binary" * with_payload
    return rows.mapInArrow(read, schema)


def archive_and_read(pages: DataFrame, least_bytes: int = 100, id: str = "page_id", url: str = "url", html: str = "html", with_payload: bool = False) -> DataFrame:
    """Write all rows to new archives in the shared folder and read them back: what :func:`read_records` gives, ``page`` typed as the id.

    A null html is an empty payload, a null url no target. Payloads shorter than ``least_bytes`` are never
    revisits. A row with a null id revisits a copy that has one; rows that repeat the smallest id are responses
    all of them. An empty table gives no rows; other columns are not read.
    """
    folder = scratch(pages.sparkSession, "warc")
    found = read_records(write_archives(pages, folder, least_bytes, id=id, url=url, html=html), folder, with_payload=with_payload)
    kind = pages.schema[id].dataType
    page = F.when(F.col("page") != "", F.col("page")).cast(kind)
    return found.withColumns({"page": page, "refers_to": F.col("refers_to").cast(kind)})


WARC_SQL = """
    WITH hashed AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), firsts AS (
        SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM hashed
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
    FROM firsts
"""
