"""Token-id files with Re-Pair grammar compression.

A block's ids are rewritten until no pair of neighbours is frequent (once in FREQUENT symbols of the block, five times at
least): in each pass every frequent pair becomes a nonterminal, whose rule and expansion length are stored; of pairs that
overlap the one on the left is replaced.  Pairs are told apart by bins of a hash, another in each pass; what shares a bin
waits for a later pass, and the passes end when two of them have found nothing.
No pair begins with a symbol that closes a document, so documents start at symbol boundaries and any of them, or any range
of ids, is decoded without what stands before it.

Defined results: a null text is an empty one (its end id alone); documents are in ascending doc_id order, null ids first,
equal ids by text; repeated rows are kept; extra columns, whatever their names, are ignored; an empty table gives no file
and an empty result; a very long text is encoded whole by one task and is a block of its own size.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_path, fs_and_path, materialize, prepare, slices
from .tokens import held_encoder

MAGIC = b"NWRP1\n"
BLOCK_IDS = 4 << 20
BINS = 1 << 20
FREQUENT = 20_000
MANIFEST_DDL = "part int, block int, path string, at long, n_bytes long, n_ids long, n_docs long"


def pair_bins(left: np.ndarray, right: np.ndarray, turn: int = 0) -> np.ndarray:
    """Bins of pairs, others in each turn."""
    with np.errstate(over="ignore"):
        h = left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA6B) + np.uint32(turn)
        return (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(12)


def compress(ids: np.ndarray, vocab: int, end_id: int, frequent: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules (rule r is symbol vocab + r: its two symbols).  ids: uint32."""
    seq, rules = ids.astype(np.uint32), np.empty((0, 2), np.uint32)
    final = np.zeros(vocab, bool)  # symbols whose expansion closes a document
    final[end_id] = True
    least = max(5, len(ids) // frequent)
    turn = idle = 0
    while len(seq) >= 2 and idle < 2:  # a frequent pair may share its bin with another, but hardly twice
        left, right = seq[:-1], seq[1:]
        h = pair_bins(left, right, turn)
        many = np.bincount(h, minlength=BINS) >= least
        at = np.flatnonzero(many[h])
        own, one, two = h[at], left[at], right[at]
        # a bin's pair is one that stands in it
        pick, places = np.zeros(BINS, np.int64), np.flatnonzero(many)
        pick[own] = np.arange(len(own))
        pl, pr = np.full(BINS, 0xFFFFFFFF, np.uint32), np.zeros(BINS, np.uint32)
        pl[places], pr[places] = one[pick[places]], two[pick[places]]
        pl[places[final[pl[places]]]] = 0xFFFFFFFF
        hit = (pl[own] == one) & (pr[own] == two)
        found, own = at[hit], own[hit]
        # of overlapping pairs in a run every other one, from the left
        fresh = np.r_[True, found[1:] != found[:-1] + 1] if len(found) else np.empty(0, bool)
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(found)), 0)) if len(found) else found
        even = (np.arange(len(found)) - run) % 2 == 0
        found, own = found[even], own[even]
        used = np.bincount(own, minlength=BINS)
        kept = np.flatnonzero(used >= least)
        turn, idle = turn + 1, 0 if len(kept) else idle + 1
        if not len(kept):
            continue
        number = np.zeros(BINS, np.uint32)
        number[kept] = vocab + len(rules) + np.arange(len(kept), dtype=np.uint32)
        enough = used[own] >= least
        found, new = found[enough], number[own[enough]]
        final = np.r_[final, final[pr[kept]]]
        rules = np.vstack([rules, np.stack([pl[kept], pr[kept]], 1)])
        seq = seq.copy()
        seq[found] = new
        stay = np.ones(len(seq), bool)
        stay[found + 1] = False
        seq = seq[stay]
    return seq, rules


def expansion_lengths(rules: np.ndarray, vocab: int) -> np.ndarray:
    """The number of ids that each symbol stands for."""
    out = np.ones(vocab + len(rules), np.int64)
    for r, (a, b) in enumerate(rules.tolist()):
        out[vocab + r] = out[a] + out[b]
    return out


class Block:
    """A stored block: documents' ids, each or any range of which can be decoded on its own."""

    def __init__(self, raw: bytes):
        z = np.load(io.BytesIO(raw), allow_pickle=False)
        self.doc_ids, self.known, self.symbol_at, self.id_at = z["doc_ids"], z["known"], z["symbol_at"], z["id_at"]
        self.rules, self.symbols, self.vocab = z["rules"].astype(np.uint32), z["symbols"], int(z["vocab"])
        self.lengths = np.r_[np.ones(self.vocab, np.int64), z["lengths"].astype(np.int64)]
        self.flat_at = np.r_[0, np.cumsum(self.lengths)]
        self.flat = np.empty(self.flat_at[-1], np.uint32)
        self.flat[: self.vocab] = np.arange(self.vocab)
        for r, (a, b) in enumerate(self.rules.tolist()):
            at = self.flat_at[self.vocab + r]
            self.flat[at : at + self.lengths[a]] = self.flat[self.flat_at[a] : self.flat_at[a + 1]]
            self.flat[at + self.lengths[a] : at + self.lengths[a] + self.lengths[b]] = self.flat[self.flat_at[b] : self.flat_at[b + 1]]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        symbols = symbols.astype(np.int64)
        n = self.lengths[symbols]
        first = np.repeat(self.flat_at[symbols] - np.r_[0, np.cumsum(n)[:-1]], n)
        return self.flat[first + np.arange(len(first))]

    def document(self, k: int) -> np.ndarray:
        return self.expand(self.symbols[self.symbol_at[k] : self.symbol_at[k + 1]])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the block; only documents that they touch are looked at."""
        a = max(0, int(np.searchsorted(self.id_at, start, "right")) - 1)
        b = int(np.searchsorted(self.id_at, stop, "left"))
        got = self.expand(self.symbols[self.symbol_at[a] : self.symbol_at[b]])
        return got[start - self.id_at[a] : stop - self.id_at[a]]


def pack_block(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, vocab: int, end_id: int) -> bytes:
    symbols, rules = compress(ids, vocab, end_id)
    size = expansion_lengths(rules, vocab)
    id_at = np.r_[0, np.cumsum(lengths)].astype(np.int64)
    bounds = np.r_[0, np.cumsum(size[symbols])]
    symbol_at = np.searchsorted(bounds, id_at)
    assert (bounds[symbol_at] == id_at).all()  # documents begin where symbols do
    small = np.uint16 if vocab + len(rules) <= 1 << 16 else np.uint32
    out = io.BytesIO()
    np.savez(out, doc_ids=np.array([x or 0 for x in doc_ids], np.int64), known=np.array([x is not None for x in doc_ids]), symbol_at=symbol_at, id_at=id_at, rules=rules.astype(small), lengths=size[vocab:].astype(np.uint32), symbols=symbols.astype(small), vocab=np.int64(vocab))
    return out.getvalue()


def _writer(folder: str, path: str, end_id: int, block_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = held_encoder(path), TaskContext.get().partitionId()
        vocab = bpe.vocab
        fs, top = fs_and_path(folder)
        fs.create_dir(top, recursive=True)
        name, rows, at, out = f"{uuid.uuid4().hex}.nwrp", [], len(MAGIC), None
        doc_ids: list = []
        counts: list[int] = []
        held: list[np.ndarray] = []
        n = 0

        def flush() -> None:
            nonlocal n, at, out
            if out is None:
                out = fs.open_output_stream(f"{top}/{name}", compression=None)
                out.write(MAGIC)
            raw = pack_block(doc_ids, np.array(counts, np.int64), np.concatenate(held).astype(np.uint32), vocab, end_id)
            out.write(raw)
            rows.append((part, len(rows), f"{folder}/{name}", at, len(raw), n, len(doc_ids)))
            at += len(raw)
            doc_ids.clear()
            held.clear()
            counts.clear()
            n = 0

        for batch in slices(batches, "text", 4 << 20):
            ids, own = bpe.encode([x or "" for x in batch.column("text").to_pylist()])
            ends = np.cumsum(own)
            ids = np.insert(ids, ends, bpe.kind(end_id))
            doc_ids += batch.column("doc_id").to_pylist()
            counts += (own + 1).tolist()
            held.append(ids)
            n += len(ids)
            if n >= block_ids:
                flush()
        if held:
            flush()
        if out is not None:
            out.close()
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "block", "path", "at", "n_bytes", "n_ids", "n_docs"), r, strict=True)) for r in rows], schema=pa.schema([("part", pa.int32()), ("block", pa.int32()), ("path", pa.string()), ("at", pa.int64()), ("n_bytes", pa.int64()), ("n_ids", pa.int64()), ("n_docs", pa.int64())]))

    return write


def write_ids(docs: DataFrame, path: str, end_id: int = 2, block_ids: int = BLOCK_IDS, parts: int | None = None) -> DataFrame:
    """Writes all documents' ids in ascending doc_id order; returns the manifest, a row for each block, with `start`: the ids before it."""
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    # ids that many rows share (null, above all) are cut by how their texts begin; tasks' sizes are Spark's to choose
    keys = [F.col("doc_id"), F.substring("text", 1, 64)]
    ordered = (rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)).sortWithinPartitions("doc_id", "text")
    manifest = materialize(ordered.mapInArrow(_writer(fresh_path(spark, "ids"), path, end_id, block_ids), MANIFEST_DDL), "ids-manifest")
    # a row for each block of millions of ids
    before = Window.orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            fs, at = fs_and_path(row["path"])
            with fs.open_input_file(at) as f:
                f.seek(row["at"])
                block = Block(f.read(row["n_bytes"]))
            n = len(block.doc_ids)
            crc = np.empty(n, np.int64)
            for a in range(0, n, 256):  # some documents at a time
                b = min(n, a + 256)
                ids = block.expand(block.symbols[block.symbol_at[a] : block.symbol_at[b]]).astype("<u4")
                base = block.id_at[a]
                for k in range(a, b):
                    crc[k] = zlib.crc32(ids[block.id_at[k] - base : block.id_at[k + 1] - base])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.doc_ids, pa.int64(), mask=~block.known), pa.array(block.id_at[:-1] + row["start"], pa.int64()), pa.array(np.diff(block.id_at), pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_ids(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""
    return manifest.select("path", "at", "n_bytes", "start").repartition(max(1, min(20_000, manifest.count()))).mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_corpus(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    prepare(docs.sparkSession)
    return read_ids(write_ids(docs, path, end_id))
