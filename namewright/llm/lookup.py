"""Counts of keys over a whole corpus, brought back to the texts that hold the keys.

Rows are copied to the shared folder in pieces of bounded size (`store`).  Each piece sends the distinct keys of its texts,
with their counts, to the segments of the key space that own them (`ask`); a segment adds up what all pieces sent and
answers each piece's keys; a piece reads its texts again and uses the answers (`answered`).  Neither a table of all keys
nor a group of equal keys is ever in one place: a segment is a slice of the hash space that is as large whatever the
corpus (their number grows), and a key is in a piece's message once, however often its texts have it.

A key is a 64-bit hash: its upper half names the segment, its lower half tells keys of a segment apart.  A segment holds a
few millions of them, so that about one in a thousand falls together with another and counts for both.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import fresh_path, fs_and_path, materialize, release, slices

PIECE_BYTES = 4 << 20
#: Bytes of text for each segment of the key space.
SEGMENT_BYTES = 12 << 20
MANIFEST_DDL = "path string, piece int, n_bytes long"


def _writer(folder: str, column: str, piece_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        fs, top = fs_and_path(folder)
        fs.create_dir(top, recursive=True)
        name, out, sink, sizes = f"{uuid.uuid4().hex}.parquet", None, None, []
        for batch in slices(merged(batches, column, piece_bytes), column, piece_bytes, 1 << 20):
            if out is None:
                sink = fs.open_output_stream(f"{top}/{name}", compression=None)
                out = pq.ParquetWriter(sink, batch.schema, compression="zstd", use_dictionary=False)
            out.write_table(pa.Table.from_batches([batch]), row_group_size=batch.num_rows)
            sizes.append(batch.nbytes)
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"] * len(sizes)), pa.array(range(len(sizes)), pa.int32()), pa.array(sizes, pa.int64())], names=["path", "piece", "n_bytes"])

    return write


def merged(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches of about most_bytes out of smaller ones."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= most_bytes:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def store(rows: DataFrame, name: str, column: str = "text", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Copies the rows to the shared folder; returns (path, piece, n_bytes) of the pieces that tasks which ended well have written."""
    folder = fresh_path(rows.sparkSession, name)
    return materialize(rows.mapInArrow(_writer(folder, column, piece_bytes), MANIFEST_DDL), f"{name}-manifest")


def read_piece(path: str, piece: int) -> pa.RecordBatch:
    import pyarrow.parquet as pq

    fs, at = fs_and_path(path)
    with fs.open_input_file(at) as f:
        table = pq.ParquetFile(f).read_row_group(piece).combine_chunks()
    return table.to_batches()[0]


def placed(keys: np.ndarray, segments: int) -> np.ndarray:
    """Segment and the key's lower half, in order of both."""
    return (((keys >> np.uint64(32)) * np.uint64(segments)) & np.uint64(0xFFFFFFFF00000000)) | (keys & np.uint64(0xFFFFFFFF))


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers by their first, second, ... bytes, which compress well where the upper bytes are alike."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def rising(numbers: np.ndarray) -> bytes:
    """Sorted 32-bit numbers by their steps."""
    return packed(np.diff(numbers, prepend=np.uint32(0)))


def risen(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw), dtype=np.uint32)


def distinct(keys: np.ndarray, weights: np.ndarray | None, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Placed distinct keys and their weights' sums."""
    place = placed(keys, segments)
    if weights is None:
        return np.unique(place, return_counts=True)
    found, which = np.unique(place, return_inverse=True)
    return found, np.bincount(which, weights=weights, minlength=len(found)).astype(np.int64)


def _ask(keys_of: Callable, kinds: int, segments: int):
    """Rows (segment, path, piece, keys and counts of each kind)."""
    names = ["segment", "path", "piece"] + [f"{c}{k}" for k in range(kinds) for c in "kn"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release()
            for path, piece in zip(batch.column("path").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                cols, some = [], np.zeros(segments, bool)
                some[0] = True  # a piece without keys gets an answer, too
                for keys, weights in keys_of(read_piece(path, piece)):
                    found, n = distinct(keys, weights, segments)
                    cuts = np.searchsorted(found >> np.uint64(32), np.arange(segments + 1, dtype=np.uint64))
                    low, n = found.astype(np.uint32), np.minimum(n, 0xFFFFFFFF)
                    some |= np.diff(cuts) > 0
                    cols += [[rising(low[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], [packed(n[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]]
                use = np.flatnonzero(some)
                for a in range(0, len(use), 256):
                    own = use[a : a + 256]
                    yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array([path] * len(own)), pa.array([piece] * len(own), pa.int32())] + [pa.array([c[s] for s in own.tolist()], pa.binary()) for c in cols], names=names)

    return run


def _own(answers: list[Callable]):
    """Answers of a segment to each piece; rows come in the order of segments."""
    names = ["path", "piece", "segment"] + [f"a{k}" for k in range(len(answers))] + ["total", "kinds"]

    def close(segment: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        cols, sums = [], None
        for k, answer in enumerate(answers):
            keys = [risen(r[2 + 2 * k]) for r in rows]
            found, which = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(which, weights=np.concatenate([unpacked(r[3 + 2 * k]) for r in rows]), minlength=len(found)).astype(np.int64)
            value = answer(found.astype(np.uint64) | np.uint64(segment) << np.uint64(32), total)[which]
            ends = np.cumsum([len(x) for x in keys])
            cols.append(pa.array([value[e - len(x) : e].tobytes() for x, e in zip(keys, ends.tolist(), strict=True)], pa.binary()))
            sums = sums or (int(total.sum()), int((total > 0).sum()))
        n = len(rows)
        out = [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int32()), pa.array([segment] * n, pa.int32()), *cols, pa.array([sums[0]] * n, pa.int64()), pa.array([sums[1]] * n, pa.int64())]
        batch = pa.RecordBatch.from_arrays(out, names=names)
        for a in range(0, n, 500):
            yield batch.slice(a, 500)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for segment, own in groupby(rows, key=lambda r: r[0]):
            yield from close(segment, [r[1:] for r in own])
            release()

    return run


def _use(keys_of: Callable, kinds: list, segments: int, use: Callable):
    """Hands each piece's rows, keys and answers to `use`; rows come in the order of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))

        def answered() -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[np.ndarray]]]:
            for (path, piece), own in groupby(rows, key=lambda r: r[:2]):
                own, batch = sorted(own, key=lambda r: r[2]), read_piece(path, piece)
                values, held = [], [keys for keys, _ in keys_of(batch)]
                for k, keys in enumerate(held):
                    found, which = np.unique(placed(keys, segments), return_inverse=True)
                    value = np.frombuffer(b"".join(r[3 + k] for r in own), kinds[k])
                    if len(value) != len(found):
                        raise ValueError(f"piece {piece} of {path}: {len(found)} keys, {len(value)} answers")
                    values.append(value[which] if len(found) else np.empty(0, kinds[k]))
                yield batch, held, values

        yield from use(answered())
        release()

    return run


def tasks_of(manifest: DataFrame) -> int:
    """Tasks for work on all pieces: what a piece costs is known, so they needn't be told by the bytes that are sent."""
    pieces = manifest.count()
    return max(1, min(pieces, max(4 * manifest.sparkSession.sparkContext.defaultParallelism, pieces // 8)))


def asked(manifest: DataFrame, keys_of: Callable, answers: list[Callable], segments: int) -> DataFrame:
    """(path, piece, segment, answers a0, a1, ..., total and kinds: the first kind's sum of counts and number of counted keys in the segment)."""
    tasks, kinds = tasks_of(manifest), len(answers)
    ddl = "segment int, path string, piece int, " + ", ".join(f"k{k} binary, n{k} binary" for k in range(kinds))
    sent = manifest.select("path", "piece").repartition(tasks).mapInArrow(_ask(keys_of, kinds, segments), ddl)
    ddl = "path string, piece int, segment int, " + ", ".join(f"a{k} binary" for k in range(kinds)) + ", total long, kinds long"
    return sent.repartition(segments, "segment").sortWithinPartitions("segment").mapInArrow(_own(answers), ddl)


def used(manifest: DataFrame, owned: DataFrame, keys_of: Callable, kinds: list, segments: int, use: Callable, schema: str) -> DataFrame:
    """What `use` makes of the pieces' rows and answers (arrays of numpy types `kinds`, a value for each key)."""
    cols = ["path", "piece", "segment"] + [f"a{k}" for k in range(len(kinds))]
    back = owned.select(*cols).repartition(tasks_of(manifest), "path", "piece").sortWithinPartitions("path", "piece")
    return back.mapInArrow(_use(keys_of, kinds, segments, use), schema)


def segments_of(manifest: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> int:
    from pyspark.sql import functions as F

    return max(8, -(-int(manifest.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]) // segment_bytes))
