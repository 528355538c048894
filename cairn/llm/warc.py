"""WARC archives, written and read through an index.

Writing packs one gzip member per record into archive files and yields an index
row per record: file, offset, length, URL, digest. The index is a table that
Spark commits; it names the file of the attempt that succeeded, so a task that
ran twice leaves an unused file and nothing else. Reading starts at the index:
the wanted rows are sorted by place, neighbours are coalesced into one range
read, and each range is fetched once.

Archives lie below the shared folder and are opened through Arrow's file
systems, which know local, HDFS and object-store URIs.

A payload of at least ``SMALLEST`` bytes is stored once: the record with the
smallest id is the response, all others with the same bytes are revisits that
name it. Copies are found by digest; only digests and ids are shuffled, first
reduced to the smallest id per digest.

Edge cases: NULL html is an empty payload, NULL URLs have no target header. A
NULL id is never the smallest unless all are NULL. Rows that share the smallest
id are all responses. Payloads of any length are one record; an empty table
writes nothing. Of the input only id, URL and html are used, so extra columns
cannot clash.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.scratch import stored
from cairn.llm.text import quoted
from cairn.session import scratch_dir

SMALLEST = 100
FILE_BYTES = 256 << 20
# Ranges closer than GAP are read as one; records are dealt to tasks by segment.
GAP, MOST_READ, SEGMENT = 64 << 10, 8 << 20, 32 << 20
DATE = "1970-01-01T00:00:00Z"

INDEX = (
    "file string, offset long, length long, url string, digest string, page_id long, record_type string, refers_to long"
)
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def marked(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """Id, URL, payload, digest and, for revisits, the id of the response."""
    payload = F.coalesce(F.col(quoted(html)), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(quoted(page_id)).cast("long").alias("page_id"), F.col(quoted(url)).alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    copied = (
        rows.where(F.length("payload") >= SMALLEST)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null")
        .select(F.col("digest").alias("copied"), "first_id")
    )
    joined = rows.join(stored(copied, "warc-copies"), F.col("digest") == F.col("copied"), "left")
    other = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", "digest", F.when(other, F.col("first_id")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the length of its payload, not its bytes."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """WARC headers, HTTP head and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    return headers, http, payload


def opened(place: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    return pyarrow.fs.FileSystem.from_uri(place)


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write all pages below the folder; the index, committed as a table."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(folder)
        files.create_dir(path)
        records = (row for batch in batches for row in batch.to_pylist())
        row = next(records, None)
        while row is not None:
            # Index rows leave the task when their archive is complete.
            rows, name, offset = [], f"{uuid.uuid4().hex}.warc.gz", 0
            with files.open_output_stream(f"{path}/{name}", compression=None) as out:
                while row is not None and offset < FILE_BYTES:
                    own = (row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                    data = gzip.compress(record(*own), 4, mtime=0)
                    out.write(data)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    rows.append((name, offset, len(data), own[1], own[3], own[0], kind, own[4]))
                    offset += len(data)
                    row = next(records, None)
            yield _batch(rows, INDEX)

    return stored(marked(pages, page_id, url, html).mapInArrow(write, INDEX), "warc-index")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])


def ranges(rows: list[dict]) -> Iterator[list[dict]]:
    """Index rows in order of place, as groups to be read at once."""
    group: list[dict] = []
    for row in rows:
        if group:
            start, end = group[0]["offset"], group[-1]["offset"] + group[-1]["length"]
            far = row["offset"] - end > GAP or row["offset"] + row["length"] - start > MOST_READ
            if row["file"] != group[0]["file"] or far:
                yield group
                group = []
        group.append(row)
    if group:
        yield group


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the index rows, fetched by coalesced range reads.

    With ``payloads`` the payload of responses is a column too.
    """
    schema = f"{RECORD}, payload binary" if payloads else RECORD

    def rows_of(group: list[dict], source: pa.NativeFile) -> Iterator[tuple]:
        start = group[0]["offset"]
        data = source.read_at(group[-1]["offset"] + group[-1]["length"] - start, start)
        for row in group:
            at = row["offset"] - start
            headers, http, payload = parsed(zlib.decompress(data[at : at + row["length"]], 31))
            named = [headers.get(h, "").removeprefix("<urn:page:").removesuffix(">") for h in ("WARC-Record-ID", "WARC-Refers-To")]
            own, refers = (int(n) if n else None for n in named)
            if headers["WARC-Type"] == "response":
                size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                if headers["WARC-Payload-Digest"] != f"sha256:{digest}":
                    raise ValueError(f"record {own} in {row['file']} at {row['offset']} is damaged")
            else:
                size = int(http.rpartition(b"Content-Length: ")[2])
                digest, payload = headers["WARC-Payload-Digest"].removeprefix("sha256:"), None
            found = (own, row["url"], headers["WARC-Type"], refers, size, digest)
            yield (*found, payload) if payloads else found

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(folder)
        name, source = None, None
        for batch in batches:
            for group in ranges(batch.select(["file", "offset", "length", "url"]).to_pylist()):
                if group[0]["file"] != name:
                    name = group[0]["file"]
                    source = files.open_input_file(f"{path}/{name}")
                yield _batch(list(rows_of(group, source)), schema)

    segment = F.floor(F.col("offset") / SEGMENT)
    placed = index.repartition("file", segment).sortWithinPartitions("file", "offset")
    return placed.mapInArrow(read, schema)


def archive_folder(pages: DataFrame) -> str:
    """A new folder for archives in the shared folder."""
    return scratch_dir(pages.sparkSession, "warc")
