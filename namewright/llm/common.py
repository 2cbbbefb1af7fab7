"""Helpers the operators of this subpackage share: table access, the shared folder, Arrow batches, word hashes."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: Maps A-Z to a-z and leaves every other byte alone.
LOWER = bytes(range(256)).lower()
#: The white space that separates words: [\x20\x09-\x0D]; bytes.split() splits on exactly these.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, in one process alone (tests), one made here."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isDefined():
            found = jsc.getCheckpointDir().get()
        elif spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
            found = "file://" + tempfile.mkdtemp(prefix="namewright-")
            spark.sparkContext.setCheckpointDir(found)
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage is cut and lost executors lose nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialize() has written, once nothing reads them any more."""
    for df in tables:
        remove(df.sparkSession, df.written_to)


def remove(spark: SparkSession, path: str) -> None:
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(jsc.hadoopConfiguration()).delete(at, True)


def prepare(spark: SparkSession) -> None:
    """Gives workers the package, and bounds the Arrow batches that they get: rows can be long texts.

    The session keeps the bound, as plans run after this call.
    """
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 2000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key written as text, modulo n; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def fs_and_path(uri: str):
    """A pyarrow file system and the path in it, for file: and other schemes alike."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def release() -> None:
    """Gives memory that numpy and Arrow have freed back to the system, so that a worker process between tasks holds next to nothing."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 8 << 20, most_rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that one piece holds a bounded amount of text, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and (held + n > most_bytes or i - start >= most_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)
    release()


def as_bytes(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_LONG = 256


def span_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of raw[start:end] for each span: eight bytes at a time, all spans at once; long ones by xxHash."""
    padded = np.frombuffer(raw + bytes(8), np.uint8)
    eight = np.ndarray((len(raw) + 1,), "<u8", buffer=padded, strides=(1,))
    lengths = ends - starts
    with np.errstate(over="ignore"):
        value = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        at, left, which = starts, lengths, None
        for k in range(_LONG // 8):
            if which is None:
                value = mix(value + (eight[at] & _KEEP[np.minimum(left, 8)]))
                which = np.flatnonzero(left > 8)
            else:
                value[which] = mix(value[which] * np.uint64(0xD6E8FEB86659FD93) + (eight[at] & _KEEP[np.minimum(left, 8)]))
                which = which[left > 8]
            if not len(which):
                break
            at, left = starts[which] + 8 * (k + 1), lengths[which] - 8 * (k + 1)
    for i in np.flatnonzero(lengths > _LONG).tolist():
        value[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]])
    return value


def word_spans(texts: list[bytes], lower: bool = True) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one buffer, where its words start and end, and how many words each text has."""
    raw = b"\n".join(texts)
    if lower:
        raw = raw.translate(LOWER)
    space = _SPACE[np.frombuffer(raw, np.uint8)]
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    stops = np.cumsum(np.array([len(x) + 1 for x in texts], np.int64))
    return raw, starts, ends, np.diff(np.r_[0, np.searchsorted(starts, stops)])


def hashed_words(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts in a row, and how many words each text has."""
    if not texts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    raw, starts, ends, counts = word_spans(texts, lower)
    return span_hashes(raw, starts, ends), counts


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words within a text, and where each starts; texts are adjacent, counts has their lengths."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    value = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]) if k else hashes[:n].copy()
        value = mix(value + np.uint64(size))
    ends = np.repeat(np.cumsum(counts), counts)[:n]
    starts = np.flatnonzero(np.arange(n) + size <= ends)
    return value[starts], starts


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
