"""WARC: a chunked record table that is written to archives and read back as a stream.

Payloads travel as rows (record identifier, chunk number, bytes), each with the SHA-1 of all bytes up to its end, so the
last chunk's digest is the record's.  The table of pages has a payload in one cell, which Spark holds while it reads the
row; from there on, writing and reading, no process holds more of a record than some chunks.

Defined results: a null payload is an empty one; a null or repeated page_id is kept (equal payload and equal largest
page_id: each such row is a response; a null id is less than any other); a null url gives a record without target;
extra columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, fs_and_path, materialize, prepare

CHUNK_BYTES = 1 << 18
ROLL_BYTES = 256 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
CHUNKS = pa.schema(
    [
        ("page_id", pa.int64()), ("chunk_no", pa.int64()), ("chunk_offset", pa.int64()), ("data", pa.binary()), ("digest_so_far", pa.string()),
        ("is_last", pa.bool_()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()),
    ]
)
CHUNKS_DDL = "page_id long, chunk_no long, chunk_offset long, data binary, digest_so_far string, is_last boolean, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"


def revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, sha, refers_to) of the records that repeat another's payload of at least min_bytes."""
    digests = records.select("page_id", F.sha1(F.col("payload")).alias("sha"), F.length("payload").alias("n_bytes"))
    largest = digests.where(F.col("n_bytes") >= min_bytes).groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 and refers_to is not null").select("sha", "refers_to")
    largest = materialize(largest, "warc-largest")
    again = digests.join(largest, "sha").where("page_id is null or page_id < refers_to")
    return materialize(again.groupBy("page_id", "sha", "refers_to").count().drop("count"), "warc-revisits")


def chunk_table(pages: DataFrame, min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows to write: one for each chunk of a response's payload, one without data for each revisit."""
    records = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), F.coalesce(F.encode(pages["html"].cast("string"), "UTF-8"), F.lit(b"")).alias("payload"))
    again = revisits(records, min_bytes).select(F.col("page_id").alias("_page"), F.col("sha").alias("_sha"), "refers_to")
    held = records.withColumn("sha", F.sha1("payload")).withColumn("n_bytes", F.length("payload").cast("long"))
    held = held.join(again, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("sha") == F.col("_sha")), "left")
    return held.select("page_id", "url", "n_bytes", "sha", "refers_to", F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload")).mapInArrow(_chunker(chunk_bytes), PIECES_DDL)


PIECES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("n_bytes", pa.int64()), ("sha", pa.string()), ("refers_to", pa.int64()), ("chunk_no", pa.int64()), ("chunk_offset", pa.int64()), ("digest_so_far", pa.string()), ("is_last", pa.bool_()), ("data", pa.binary())])
PIECES_DDL = "page_id long, url string, n_bytes long, sha string, refers_to long, chunk_no long, chunk_offset long, digest_so_far string, is_last boolean, data binary"


def _chunker(chunk_bytes: int, most_bytes: int = 4 << 20):
    """A record's payload as chunks, with the digest of all bytes up to each chunk's end."""

    def chunks(batch: pa.RecordBatch) -> Iterator[tuple]:
        columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "n_bytes", "sha", "refers_to")]
        for k, (page, url, n_bytes, sha, refers) in enumerate(zip(*columns, strict=True)):
            payload, so_far = memoryview(batch.column("payload")[k].as_buffer()), hashlib.sha1()
            for at in range(0, max(1, len(payload)), chunk_bytes):
                data = payload[at : at + chunk_bytes]
                so_far.update(data)
                is_last = at + chunk_bytes >= len(payload)
                if is_last and refers is None and so_far.hexdigest() != sha:
                    raise ValueError(f"record {page}: chunks don't add up to the payload")
                yield page, url, n_bytes, sha, refers, at // chunk_bytes, at, base32_of(sha if refers is not None else so_far.hexdigest()), is_last, data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in chunks(batch):
                rows.append((*row[:-1], bytes(row[-1])))
                held += len(row[-1]) + 300
                if held >= most_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECES, strict=True)], schema=PIECES)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECES, strict=True)], schema=PIECES)

    return run


def base32_of(sha_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha_hex)).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    text = name.strip("<>").rpartition(":")[2]
    return None if text == "null" else int(text)


def header_of(row: dict) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n_bytes']}\r\n\r\n".encode()
    revisit = row["refers_to"] is not None
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(row['page_id'])}", f"WARC-Date: {DATE}"]
    if row["url"]:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else "".join(f"%{b:02X}" for b in c.encode()) for c in row["url"]))
    lines.append(f"WARC-Payload-Digest: sha1:{base32_of(row['sha'])}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(row['refers_to'])}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else row['n_bytes'])}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + http


def _writer(folder: str, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = fs_and_path(folder)
        fs.create_dir(top, recursive=True)
        done, out, path, size, records, packer = [], None, "", 0, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, path = fs.open_output_stream(f"{top}/{name}", compression=None), f"{folder}/{name}"
                if row["chunk_no"] == 0:
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    size += out.write(packer.compress(header_of(row)))
                size += out.write(packer.compress(row["data"]))
                if row["is_last"]:
                    size += out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                    records += 1
                    if size >= ROLL_BYTES:
                        out.close()
                        done.append((path, records, size))
                        out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), MANIFEST, strict=True)], schema=MANIFEST)

    return write


def write_archives(rows: DataFrame, level: int = 1) -> DataFrame:
    """Writes the chunk rows to .warc.gz files, a gzip member for each record; returns the files of the tasks that ended well.

    The list of files is dealt by the tasks that wrote them, so that few tasks write it: for each file that the JVM makes in a
    local folder it starts a process (chmod), which for a moment has all of the JVM's memory, as if that were there twice.
    """
    folder = fresh_path(rows.sparkSession, "warc-archives")
    done = rows.mapInArrow(_writer(folder, level), "path string, n_records long, n_bytes long")
    # by the task's number, not its file's name: a task that runs again has another name, and its row must stay where it was
    return materialize(done.withColumn("task", F.spark_partition_id()).repartition("task").drop("task"), "warc-manifest")


class Inflated:
    """The bytes of one gzip member after another, in pieces of bounded size."""

    def __init__(self, stream, piece: int = 1 << 16):
        self.stream, self.piece, self.raw, self.open = stream, piece, b"", None

    def next_member(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(self.piece)
        if not self.raw:
            return False
        self.open = zlib.decompressobj(31)
        return True

    def read(self) -> bytes:
        """Some bytes of the member, none at its end."""
        while not self.open.eof:
            if not self.raw:
                self.raw = self.stream.read(self.piece)
                if not self.raw:
                    raise EOFError("archive ends within a record")
            got = self.open.decompress(self.raw, self.piece)
            self.raw = self.open.unconsumed_tail or self.open.unused_data
            if got:
                return got
        return b""


def records_of(stream) -> Iterator[tuple[dict, int, Iterator[bytes]]]:
    """Headers, payload length and payload pieces of each record; the pieces must be used up before the next record."""
    source = Inflated(stream)
    while source.next_member():
        held = b""
        while held.count(b"\r\n\r\n") < 2 and (got := source.read()):
            held += got
        head, _, rest = held.partition(b"\r\n\r\n")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])}
        http, _, rest = rest.partition(b"\r\n\r\n")
        length = int(next(x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length")))
        left = int(headers["content-length"]) - len(http) - 4

        def pieces(rest: bytes = rest, left: int = left) -> Iterator[bytes]:
            while left:
                rest = rest or source.read()
                if not rest:
                    raise EOFError("record is shorter than it says")
                yield rest[:left]
                left, rest = left - min(left, len(rest)), b""

        yield headers, length, pieces()
        while source.read():
            pass


def _reader(chunk_bytes: int, with_data: bool):
    def rows_of(path: str) -> Iterator[tuple]:
        fs, at = fs_and_path(path)
        with fs.open_input_stream(at, compression=None) as stream:
            for headers, length, pieces in records_of(stream):
                page, kind = page_of(headers["warc-record-id"]), headers["warc-type"]
                refers = page_of(headers["warc-refers-to"]) if kind == "revisit" else None
                said = headers["warc-payload-digest"].removeprefix("sha1:")
                sha, no, offset, held = hashlib.sha1(), 0, 0, bytearray()
                for piece in pieces:
                    sha.update(piece)
                    held += piece
                    while len(held) >= chunk_bytes and offset + len(held) < length:
                        # the running digest covers all that has been read, whole pieces at a time
                        yield page, no, offset, bytes(held) if with_data else None, base64.b32encode(sha.digest()).decode(), False, length, said, kind, refers, headers.get("warc-target-uri")
                        no, offset = no + 1, offset + len(held)
                        held.clear()
                digest = said if kind == "revisit" else base64.b32encode(sha.digest()).decode()
                if digest != said or (kind == "response" and offset + len(held) != length):
                    raise ValueError(f"record {page}: payload doesn't match its header")
                yield page, no, offset, bytes(held) if with_data else None, digest, True, length, digest, kind, refers, headers.get("warc-target-uri")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for row in rows_of(path):
                    rows.append(row)
                    held += len(row[3] or b"") + 200
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), CHUNKS, strict=True)], schema=CHUNKS)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), CHUNKS, strict=True)], schema=CHUNKS)

    return read


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The archives' chunk rows; a record's last one has its final digest."""
    files = max(1, min(manifest.count(), 20_000))
    return manifest.select("path").repartition(files).mapInArrow(_reader(chunk_bytes, with_data), CHUNKS_DDL)


def archive_digests(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the pages to archives, reads those back and returns what the last chunk rows say of each page."""
    prepare(pages.sparkSession)
    manifest = write_archives(chunk_table(pages, min_bytes))
    last = read_archives(manifest, with_data=False).where("is_last")
    return last.select("page_id", "payload_bytes", F.col("digest_so_far").alias("payload_digest"), "record_type", "refers_to", "target_uri")
