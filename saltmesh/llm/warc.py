"""WARC archives: writing, normalising monolithic gzip files, and reading by sidecar index.

`write_archives` writes records to gzip files of one stream each. `normalise` inflates such a file once, as a stream,
writes every record as a gzip member of its own and puts a sidecar index (offset, length, type, record id) beside the
archive. `read_archives` reads records by the index, each member on its own.

Files go to a shared folder under names given by the partition; an attempt writes to a name of its own and renames when
done, so a task that runs again after a lost executor replaces its file whole.

Defined results: null html is an empty payload. Payloads under SMALL bytes are always responses. Equal page ids with
equal payloads are each a response if they hold the largest id. A null page id revisits the response if there is one.
Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_folder, stored, table

#: Payloads below so many bytes are never revisits.
SMALL = 1000
#: Bytes of records after which a writer starts another archive.
ARCHIVE_BYTES = 64_000_000
#: Revisits up to which they are broadcast to the pages (about 60 bytes each); beyond it the pages are shuffled.
BROADCAST_ROWS = 100_000
LEVEL = 4
BLOCK = 1 << 20

RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string, member_offset long, member_length long, intact boolean"


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


class _Output:
    """A file that appears under its name when it is closed."""

    def __init__(self, folder: str, name: str):
        self.fs, base = _filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        context = TaskContext.get()
        self.name, self.own = f"{base}/{name}", f"{base}/.{name}.{context.taskAttemptId() if context else 0}"
        self.stream = self.fs.open_output_stream(self.own)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.own, self.name)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit whose HTTP header alone stays."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if refers_to is None else http
    url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {url}"]
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _headers(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode(errors="replace").split("\r\n")[1:])}


def _urn(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def split_records(blocks: Iterator[bytes]) -> Iterator[tuple[bytes, dict[str, str]]]:
    """The records of an inflated stream with their headers, holding one record and one block at a time."""
    held = bytearray()
    more = True
    while more or held:
        at = held.find(b"\r\n\r\n")
        need = None
        if at >= 0:
            headers = _headers(bytes(held[:at]))
            need = at + 4 + int(headers["content-length"]) + 4
        if need is None or len(held) < need:
            block = next(blocks, None)
            if block is None:
                if held:
                    raise ValueError("the stream ends inside a record")
                return
            held += block
            while need is not None and len(held) < need:
                block = next(blocks, None)
                if block is None:
                    raise ValueError("the stream ends inside a record")
                held += block
            continue
        yield bytes(held[:need]), headers
        del held[:need]


def inflate(stream) -> Iterator[bytes]:
    """A gzip file's content in blocks, of one member or several."""
    unzip = zlib.decompressobj(31)
    while data := stream.read(BLOCK):
        while data:
            if out := unzip.decompress(data, 4 * BLOCK):
                yield out
            data = unzip.unconsumed_tail
            if unzip.eof:
                data = unzip.unused_data
                unzip = zlib.decompressobj(31)
    if out := unzip.flush():
        yield out


def write_archives(records: DataFrame, folder: str, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes (page_id, url, payload, digest, refers_to) to files of one gzip stream each; (archive, n_records) of each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, n, size, out, zipped = TaskContext.get().partitionId(), 0, 0, 0, None, None
        made: list[tuple[str, int]] = []

        def close():
            out.write(zipped.flush())
            out.close()
            made.append((f"{folder}/part-{part:06d}-{count:04d}.warc.gz", n))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out, zipped, n, size = _Output(folder, f"part-{part:06d}-{count:04d}.warc.gz"), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0
                data = record(*row)
                out.write(zipped.compress(data))
                n, size = n + 1, size + len(data)
                if size >= limit:
                    close()
                    count, out = count + 1, None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"archive": pa.array([m[0] for m in made], pa.string()), "n_records": pa.array([m[1] for m in made], pa.int64())})

    return records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(write, "archive string, n_records long")


def _spread(files: DataFrame) -> DataFrame:
    """About one file a task."""
    return files.repartition(max(1, min(files.count(), 10_000)))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites each archive with one gzip member for each record and a sidecar index; (archive, n_records, n_bytes) of the new ones."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for source in batch.column(0).to_pylist():
                name = source.rsplit("/", 1)[1]
                fs, path = _filesystem(source)
                out, index = _Output(folder, name), []
                with fs.open_input_stream(path, compression=None) as stream:
                    for data, headers in split_records(inflate(stream)):
                        zipped = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = zipped.compress(data) + zipped.flush()
                        index.append(f"{out.size}\t{len(member)}\t{headers['warc-type']}\t{headers['warc-record-id']}")
                        out.write(member)
                out.close()
                side = _Output(folder, f"{name}.idx")
                side.write("\n".join(index).encode())
                side.close()
                made.append((f"{folder}/{name}", len(index), out.size))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*made, strict=True)) or [()] * 3, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["archive", "n_records", "n_bytes"])

    return _spread(archives.select("archive")).mapInArrow(rewrite, "archive string, n_records long, n_bytes long")


def read_archives(archives: DataFrame) -> DataFrame:
    """RECORDS of normalised archives, each member read at its offset. intact: the payload has the digest of its header."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = zip(*((n, k) for n, k in (f.split() for f in RECORDS.split(", "))), strict=True)
        arrow = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                fs, path = _filesystem(archive)
                with fs.open_input_stream(f"{path}.idx") as side:
                    index = side.read().decode().split("\n")
                rows = []
                with fs.open_input_file(path) as file:
                    for line in filter(None, index):
                        offset, length = map(int, line.split("\t")[:2])
                        file.seek(offset)
                        data = zlib.decompress(file.read(length), 31)
                        head, _, body = data.partition(b"\r\n\r\n")
                        headers = _headers(head)
                        http, _, payload = body[: int(headers["content-length"])].partition(b"\r\n\r\n")
                        digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
                        intact = kind == "revisit" or hashlib.sha1(payload).hexdigest() == digest
                        full = int(_headers(http)["content-length"])
                        rows.append((_urn(headers["warc-record-id"]), full, digest, kind, _urn(headers.get("warc-refers-to")), headers["warc-target-uri"], archive, offset, length, intact))
                cols = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, arrow[k]) for c, k in zip(cols, kinds, strict=True)], list(names))

    return _spread(archives.select("archive")).mapInArrow(read, RECORDS)


def with_revisits(pages: DataFrame, small: int = SMALL) -> DataFrame:
    """pages (page_id, url, payload) with digest and refers_to: of equal payloads the largest page_id is the response."""
    pages = pages.withColumn("digest", F.sha1("payload"))
    keys = pages.where(F.length("payload") >= small).select("page_id", "digest")
    groups = stored(keys.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n"), "responses")
    revisits = stored(keys.join(groups, "digest").where("not page_id <=> refers_to").distinct(), "revisits")
    known = revisits.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to")
    if revisits.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    return pages.join(known, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left").drop("_page", "_digest")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", payload)
    folder = new_folder(spark, "warc")
    raw = stored(write_archives(with_revisits(pages), f"{folder}/raw"), "raw-archives")
    archives = stored(normalise(raw, f"{folder}/records"), "archives")
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


#: The contract's columns; every payload that is read back has to be intact.
OP1_SQL = f"""
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    largest AS (SELECT payload_digest, max(page_id) AS top FROM payloads WHERE payload_bytes >= {SMALL} GROUP BY payload_digest),
    told AS (SELECT p.*, CASE WHEN p.payload_bytes >= {SMALL} AND p.page_id IS DISTINCT FROM l.top THEN l.top END AS refers_to FROM payloads p LEFT JOIN largest l ON l.payload_digest = p.payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, true AS intact FROM told"""
