"""WARC archives: writing, and normalising whole-file gzip into one member a record (operator 8).

``write_archives`` writes each partition's records into archives that are one gzip stream each, as
crawlers that compress the whole file leave them.  ``normalise`` inflates such a stream once, in blocks,
rewrites every record as a gzip member of its own and writes a sidecar index (one line a record:
offset, length, type, page id), so a record is read by one seek.  ``read_records`` reads by the index.

Of records with equal payloads of at least ``LEAST`` bytes the one with the smallest page id is the
response and holds the payload; the others are revisits that name it.  Null html is an empty payload.
A row without an id or of the same id as the smallest is a response; a null url leaves the header out,
and control characters in one are escaped.  Repeated rows give a record each, an empty table none.
Files appear under their names only when whole and the tables between the steps are written ones.
An archive that was cut anywhere within a gzip member, its trailer included, or followed by other bytes raises.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, save_file, shared_folder, shared_uri, ship_package

#: Smaller payloads are never revisits.
LEAST = 100
#: Payload bytes after which a task begins another archive.
ARCHIVE_BYTES = 256 << 20
BLOCK = 1 << 20
#: Rows of digest and id that may be broadcast (about 20 MB).
MAX_BROADCAST = 200_000

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def record_id(page_id: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> list[bytes]:
    """The bytes of a response record, or of a revisit of page ``first``."""
    block = HTTP if first is not None else HTTP + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="".join(chr(c) for c in range(33, 127))))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response"]
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first)}", f"X-Refers-To-Page-ID: {first}"]
    head.append(f"Content-Length: {len(block)}")
    return ["\r\n".join(head).encode() + b"\r\n\r\n", block, b"\r\n\r\n"]


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def inflated(blocks: Iterable[bytes]) -> Iterator[bytes]:
    """The contents of a gzip stream of any number of members, a block at a time.  A stream that ends
    before its last member's trailer, holds no member, or goes on with bytes that are no gzip raises."""
    stream, whole = zlib.decompressobj(31), False
    for data in blocks:
        while data:
            if stream.eof:
                stream = zlib.decompressobj(31)
            out = stream.decompress(data, BLOCK)
            whole = stream.eof
            if out:
                yield out
            data = stream.unused_data if whole else stream.unconsumed_tail
    # with a full output buffer and no input left, the end may still be inside the stream
    while not whole and (out := stream.decompress(b"", BLOCK)):
        whole = stream.eof
        yield out
    if not (whole or stream.eof):
        raise ValueError("the archive ends inside a gzip member")


def records(blocks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes, Iterator[bytes]]]:
    """(headers, header bytes, block in pieces) of the records of inflated bytes; no record is held
    whole.  A record's pieces must be used up before the next record is taken."""
    source, rest = iter(blocks), b""
    while True:
        while b"\r\n\r\n" not in rest:
            more = next(source, None)
            if more is None:
                if rest.strip():
                    raise ValueError("the archive ends inside a record")
                return
            rest += more
        head, _, rest = rest.partition(b"\r\n\r\n")
        fields = headers(head)
        left = int(fields["Content-Length"]) + 4  # with the blank lines that end a record

        def pieces() -> Iterator[bytes]:
            nonlocal left, rest
            while left:
                if not rest:
                    rest = next(source, b"")
                    if not rest:
                        raise ValueError("the archive ends inside a record")
                part, rest = rest[:left], rest[left:]
                left -= len(part)
                yield part

        yield fields, head + b"\r\n\r\n", pieces()


def _blocks(f) -> Iterator[bytes]:
    while data := f.read(BLOCK):
        yield data


def write_archives(pages: DataFrame, *, id_col="page_id", url_col="url", html_col="html", archive_bytes=ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """(URI of the folder, a written table of the archives' names)."""
    spark = pages.sparkSession
    ship_package(spark)
    uri = shared_uri(spark, "warc")
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    own = own.withColumn("digest", F.sha2("payload", 256))
    large = own.filter(F.octet_length("payload") >= LEAST).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = materialize(large.filter("n > 1 and first is not null").select(F.col("digest").alias("__digest"), "first"), "repeated")
    side = F.broadcast(repeated) if repeated.count() <= MAX_BROADCAST else repeated
    joined = own.join(side, (F.col("digest") == F.col("__digest")) & (F.col("page_id") > F.col("first")), "left")

    def write(batches):
        from pyspark import TaskContext

        part, names, rows = TaskContext.get().partitionId(), [], _payload_rows(batches)
        ahead = next(rows, None)
        while ahead is not None:
            name = f"crawl-{part:07d}-{len(names):05d}"

            def packed():
                nonlocal ahead
                stream, size = zlib.compressobj(1, zlib.DEFLATED, 31), 0
                while ahead is not None and size < archive_bytes:
                    for piece in record(*ahead):
                        yield stream.compress(piece)
                    size += len(ahead[2])
                    ahead = next(rows, None)
                yield stream.flush()

            save_file(uri, f"{name}.warc.gz", packed())
            names.append(name)
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    written = joined.select("page_id", "url", "payload", "digest", "first").mapInArrow(write, "name string")
    return uri, materialize(written, "archives")


def _payload_rows(batches) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "first")]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def normalise(uri: str, archives: DataFrame) -> DataFrame:
    """Rewrite every archive with a member a record and its index; the table of names."""

    def rewrite(batches):
        for batch in batches:
            for name in batch.column("name").to_pylist():
                fs, root = shared_folder(uri)
                lines: list[dict] = []
                with fs.open_input_stream(f"{root}/{name}.warc.gz", compression=None) as f:

                    def members():
                        offset = 0
                        for fields, head, pieces in records(inflated(_blocks(f))):
                            stream, size = zlib.compressobj(4, zlib.DEFLATED, 31), 0
                            for piece in chain([head], pieces):
                                out = stream.compress(piece)
                                size += len(out)
                                yield out
                            out = stream.flush()
                            size += len(out)
                            yield out
                            lines.append({"offset": offset, "length": size, "type": fields["WARC-Type"], "page_id": fields.get("X-Page-ID")})
                            offset += size

                    save_file(uri, f"{name}.records.warc.gz", members())
                save_file(uri, f"{name}.index", (json.dumps(x).encode() + b"\n" for x in lines))
                yield pa.RecordBatch.from_pydict({"name": [name], "n_records": [len(lines)]})

    return materialize(spread(archives).mapInArrow(rewrite, "name string, n_records long"), "normalised")


def spread(archives: DataFrame) -> DataFrame:
    """A task for each archive, up to 10,000: a row is a name, but its work is a whole file."""
    return archives.select("name").repartition(max(1, min(archives.count(), 10_000)), "name")


def read_member(f, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """(headers, block) of the record at a place of a normalised archive."""
    f.seek(offset)
    ((fields, _, pieces),) = [(a, b, b"".join(c)) for a, b, c in records(inflated([f.read(length)]))]
    return fields, pieces[:-4]


def read_records(uri: str, archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, read by the index."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def read(batches):
        for batch in batches:
            for name in batch.column("name").to_pylist():
                fs, root = shared_folder(uri)
                with fs.open_input_stream(f"{root}/{name}.index", compression=None) as f:
                    index = [json.loads(x) for x in f.read().splitlines()]
                rows: list[tuple] = []
                with fs.open_input_file(f"{root}/{name}.records.warc.gz") as f:
                    for entry in index:
                        fields, block = read_member(f, entry["offset"], entry["length"])
                        stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        size, page, first = int(fields["X-Payload-Length"]), fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                        if first is None:
                            payload = block.partition(b"\r\n\r\n")[2]
                            size = len(payload)
                            if hashlib.sha256(payload).hexdigest() != stated:
                                raise ValueError(f"the payload of page {page} in {name} is not what was written")
                        rows.append((None if page is None else int(page), size, stated, fields["WARC-Type"], None if first is None else int(first)))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return spread(archives).mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


WARC_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
     f AS (SELECT sha256(b) AS d, min(page_id) AS first FROM p GROUP BY 1)
SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest,
       CASE WHEN octet_length(b) >= {LEAST} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(b) >= {LEAST} AND page_id > first THEN first END AS refers_to
FROM p JOIN f ON sha256(b) = d"""
