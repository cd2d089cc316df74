"""WARC archives as a chunked record table.

A payload is never handled whole once it has left its table: it becomes rows of record id and
chunk number in the JVM, the writer appends them to its archive one by one, and the reader turns
an archive back into such rows while it streams, each with the digest of everything up to its
end. So memory is bounded by the chunk size in writer and reader, whatever a payload's length.
The rows of one record come out of one explosion, hence in order and in one task, and nothing is
shuffled to keep them together.

Archives lie in the shared folder. A task writes to a name of its own and reports it; only the
names in the committed manifest are read, so attempts that failed or ran twice leave no trace in
the result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textorbit.llm.common import table
from textorbit.session import new_path, stage

CHUNK_BYTES = 256 << 10
# Records of payloads below this are never revisits.
MIN_REVISIT_BYTES = 100
# Archives are closed at about this many payload bytes.
ARCHIVE_BYTES = 256 << 20
SALTS = 16
READ_BYTES = 256 << 10

CHUNKS = (
    "archive string, record_no long, record_id string, page_id long, url string, record_type string, refers_to long, "
    "header_digest string, chunk_no long, start long, data binary, sha256 string, last boolean"
)


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder name, with or without a scheme."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.LocalFileSystem(), path


def _payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def with_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, salts: int = SALTS) -> DataFrame:
    """Record type and reference of every page: page_id, url, payload, digest, record_type, refers_to.

    Copies are found by digest. The first page of each digest with copies is spread over salts,
    so that pages of one digest, however many, meet it in many tasks.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        _payload(F.col("html")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long_ones = rows.filter(F.octet_length("payload") >= min_bytes)
    firsts = long_ones.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select(
        "digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    )
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    rows = rows.join(firsts, ["digest", "salt"], "left")
    revisit = F.coalesce(F.col("page_id") > F.col("first_id"), F.lit(False))
    return rows.select(
        "page_id", "url", "payload", "digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def chunk_rows(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk of a record's body, in order; a revisit's body is empty."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    n = F.greatest(F.ceil(F.octet_length("body") / chunk_bytes), F.lit(1)).cast("int")
    rows = records.withColumn("body", body).withColumn("n_chunks", n)
    rows = rows.withColumn("body_bytes", F.octet_length("body").cast("long"))
    starts = F.sequence(F.lit(0), F.col("n_chunks") - 1)
    rows = rows.select("page_id", "url", "digest", "record_type", "refers_to", "body_bytes", "n_chunks", "body",
                       F.explode(starts).alias("chunk_no"))
    piece = F.substring(F.col("body"), F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))
    return rows.select("page_id", "url", "digest", "record_type", "refers_to", "body_bytes", "n_chunks", "chunk_no", piece.alias("data"))


def _header(row: dict, record_id: str) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:uuid:{record_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {row['body_bytes']}",
    ]
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if row["url"] is not None:
        url = "".join(c if c.isprintable() and c != "%" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in row["url"])
        lines.append(f"WARC-Target-URI: {url}")
    if row["refers_to"] is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page-ID: {row['refers_to']}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8")


def write_archives(records: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``records`` to gzip archives, one member per record; returns the manifest: archive, n_records, n_bytes.

    The manifest is staged, so each archive in it was written by a task that ended well.
    """
    names = ["page_id", "url", "digest", "record_type", "refers_to", "body_bytes", "n_chunks", "chunk_no"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = filesystem(folder)
        disk.create_dir(root, recursive=True)
        out, path, records_, size, gz = None, "", 0, 0, None
        done = []
        for batch in batches:
            heads = batch.select(names).to_pylist()
            for row, data in zip(heads, batch.column("data")):
                if row["chunk_no"] == 0:
                    if out is not None and size >= archive_bytes:
                        out.close()
                        done.append((path, records_, size))
                        out = None
                    if out is None:
                        path, records_, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = disk.open_output_stream(path, compression=None)
                    gz = zlib.compressobj(1, zlib.DEFLATED, 31)
                    out.write(gz.compress(_header(row, str(uuid.uuid4()))))
                    records_ += 1
                data = data.as_buffer()
                if data is not None and len(data):
                    out.write(gz.compress(data))
                    size += len(data)
                if row["chunk_no"] == row["n_chunks"] - 1:
                    out.write(gz.compress(b"\r\n\r\n") + gz.flush())
        if out is not None:
            out.close()
            done.append((path, records_, size))
        paths, counts, sizes = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
            ["archive", "n_records", "n_bytes"],
        )

    manifest = chunk_rows(records, chunk_bytes).mapInArrow(write, "archive string, n_records long, n_bytes long")
    return stage(manifest, "warc-manifest")


class _Stream:
    """Bytes of an archive, decompressed as they are asked for."""

    def __init__(self, source):
        self.source, self.ready, self.gz, self.rest = source, bytearray(), zlib.decompressobj(31), b""

    def fill(self) -> bool:
        data = self.rest or self.source.read(READ_BYTES)
        if not data:
            return False
        if self.gz.eof:
            self.gz = zlib.decompressobj(31)
        self.ready += self.gz.decompress(data, READ_BYTES)
        self.rest = self.gz.unused_data if self.gz.eof else self.gz.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the archive's end."""
        seen = 0
        while True:
            at = self.ready.find(mark, max(0, seen - len(mark)))
            if at >= 0:
                found = bytes(self.ready[: at + len(mark)])
                del self.ready[: at + len(mark)]
                return found
            seen = len(self.ready)
            if not self.fill():
                if self.ready:
                    raise ValueError("the archive ends within a record")
                return None

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self.fill():
                raise ValueError("the archive ends within a record")
        found = bytes(self.ready[:n])
        del self.ready[:n]
        return found


def _unquote(url: str | None) -> str | None:
    if url is None or "%" not in url:
        return url
    from urllib.parse import unquote

    return unquote(url, errors="surrogatepass")


def read_archive(disk: fs.FileSystem, path: str, chunk_bytes: int) -> Iterator[tuple]:
    """Chunk rows of one archive, as ``CHUNKS``."""
    with disk.open_input_stream(path, compression=None) as source:
        stream, number = _Stream(source), 0
        while (head := stream.until(b"\r\n\r\n")) is not None:
            fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:] if line)
            left, start, chunk, digest = int(fields["Content-Length"]), 0, 0, hashlib.sha256()
            page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
            about = (
                path, number, fields["WARC-Record-ID"][1:-1], None if page is None else int(page),
                _unquote(fields.get("WARC-Target-URI")), fields["WARC-Type"], None if refers is None else int(refers),
                fields["WARC-Payload-Digest"].removeprefix("sha256:"),
            )
            while True:
                data = stream.take(min(left, chunk_bytes))
                left -= len(data)
                digest.update(data)
                yield (*about, chunk, start, data, digest.hexdigest(), left == 0)
                start, chunk = start + len(data), chunk + 1
                if not left:
                    break
            if stream.take(4) != b"\r\n\r\n":
                raise ValueError(f"{path}: record {number} does not end where its length says")
            number += 1


def read_archives(manifest: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, batch_bytes: int = 4 << 20) -> DataFrame:
    """The archives' chunk table (``CHUNKS``): each chunk carries the SHA-256 up to its end."""
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(CHUNKS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        disk, _ = filesystem(folder)

        def pack(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], target.names)

        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in read_archive(disk, path, chunk_bytes):
                    rows.append(row)
                    size += len(row[10]) + 500
                    if size >= batch_bytes:
                        yield pack(rows)
                        rows, size = [], 0
        if rows:
            yield pack(rows)

    # Archives, not bytes, are dealt out: each is read as a stream by one task.
    parts = max(manifest.sparkSession.sparkContext.defaultParallelism, min(100_000, manifest.count()))
    return manifest.select("archive").repartition(parts, "archive").mapInArrow(read, schema)


def resolve(chunks: DataFrame) -> DataFrame:
    """One row per record: size and digest of its full payload, taken from the bytes read.

    A revisit takes those of the response it refers to, and its own header must name the same digest.
    """
    ends = chunks.filter("last").select(
        "page_id", "url", "record_type", "refers_to", "header_digest", "sha256",
        (F.col("start") + F.octet_length("data")).alias("bytes"),
    )
    ends = stage(ends, "warc-records")
    responses = ends.filter("record_type = 'response' AND page_id IS NOT NULL").select(
        F.col("page_id").alias("refers_to"), F.col("header_digest"), F.col("sha256").alias("of_sha256"), F.col("bytes").alias("of_bytes")
    )
    # The digest belongs to the key: a page number given twice may have had two payloads.
    rows = ends.join(responses.dropDuplicates(["refers_to", "header_digest"]), ["refers_to", "header_digest"], "left")
    revisit = F.col("record_type") == "revisit"
    digest = F.when(revisit, F.col("of_sha256")).otherwise(F.col("sha256"))
    return rows.select(
        "page_id", "url",
        F.when(revisit, F.col("of_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        digest.alias("payload_digest"), "record_type", "refers_to",
        (digest == F.col("header_digest")).alias("digest_ok"),
    )


def archive_pages(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Write pages to archives and read them back: the manifest and the chunk table.

    A null html is an empty payload. A page without id is a response of its own; rows that share
    the smallest id of a payload are all responses. Payloads below ``MIN_REVISIT_BYTES`` are all
    responses. Long payloads take several chunks, empty ones one empty chunk; a line break or a
    per cent sign in an url is escaped. No rows give no archives and an empty chunk table.
    Columns other than page_id, url and html are not archived.
    """
    folder = new_path(pages.sparkSession, "warc")
    manifest = write_archives(with_records(pages), folder, chunk_bytes)
    return manifest, read_archives(manifest, folder, chunk_bytes)


def op2_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, chunks = archive_pages(table(spark, sf_dir, "pages"))
    return resolve(chunks).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = f"""
WITH p AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest FROM pages
),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= {MIN_REVISIT_BYTES} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

QUERIES = {"op2_warc_chunks": op2_warc_chunks}
ORACLES = {"op2_warc_chunks": OP2_SQL}
