"""Best-fit packing under conflicts.

Lengths are token counts of a public tokenizer, an end token included.  Documents are cut into pieces of at most a bin's
capacity, which are dealt to shards at random (by a number that is written with them, so that a piece stays where it is
when a task is run again).  Within a shard pieces go, largest first, to the tightest bin that may take them: bins are kept
in order of what is left, the search begins at the first that is large enough and goes on to its successors until one is
compatible.  A bin carries bitmaps of the sources and duplicate clusters in it: at most `per_source` pieces of one source
and one piece of a cluster of copies (so also of a document) may be in it.

Defined results: a null or empty text has length 1 (its end token); a null source never conflicts; rows of one doc_id are
packed each (and conflict where they are copies); of pieces of equal length the smaller doc_id goes first, null before
all, of bins that are as tight the older one is taken; a very long text's tokens are counted by one task, its pieces
go to many shards; extra columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, materialize, prepare, slices
from .tokens import held_encoder

CAPACITY, PER_SOURCE, SHARD_PIECES = 2048, 4, 4096
SCHEMA = "doc_id long, piece int, length int, shard int, bin int, offset int"


def _lengths(path: str):
    """Puts the number of tokens, with an end token, in the place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            _, n = held_encoder(path).encode([x or "" for x in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(n + 1), batch.column("cluster"), batch.column("salt")], names=["doc_id", "source", "n", "cluster", "salt"])

    return run


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int, per_source: int) -> tuple[list[int], list[int]]:
    """The bin of each piece, and where it starts there; pieces are given largest first."""
    many = {c for c, n in Counter(clusters).items() if n > 1 and c is not None}
    cluster_bit = {c: 1 << k for k, c in enumerate(sorted(many))}
    source_bit = {s: 1 << k for k, s in enumerate(sorted({s for s in sources if s is not None}))}
    left: list[tuple[int, int]] = []  # (what is left, bin), in order
    held_clusters: list[int] = []
    held_sources: list[list[int]] = []  # bitmaps: sources with at least 1, 2, ... pieces
    bins, offsets = [], []
    for n, s, c in zip(lengths, sources, clusters, strict=True):
        cb, sb = cluster_bit.get(c, 0), source_bit.get(s, 0)
        at = bisect_left(left, (n, -1))
        while at < len(left) and (held_clusters[left[at][1]] & cb or held_sources[left[at][1]][per_source - 1] & sb):
            at += 1
        if at < len(left):
            room, b = left.pop(at)
        else:
            room, b = capacity, len(held_clusters)
            held_clusters.append(0)
            held_sources.append([0] * per_source)
        bins.append(b)
        offsets.append(capacity - room)
        held_clusters[b] |= cb
        layers = held_sources[b]
        for k in range(per_source):
            if not layers[k] & sb:
                layers[k] |= sb
                break
        if room > n:
            insort(left, (room - n, b))
    return bins, offsets


def _pack(capacity: int, per_source: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "cluster", "salt"], ascending=[False, True, True, True, True], kind="stable", na_position="first")
        nullable = lambda c: [None if pd.isna(x) else x for x in pdf[c].astype(object)]
        bins, offsets = best_fit(pdf["length"].tolist(), nullable("source"), nullable("cluster"), capacity, per_source)
        out = pdf[["doc_id", "piece", "length", "shard"]].copy()
        return out.assign(bin=np.array(bins, np.int32), offset=np.array(offsets, np.int32))

    return run


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, per_source: int = PER_SOURCE, cluster: Column | None = None, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """doc_id, piece, length, shard, bin and offset of each piece.  path: the tokenizer's file; cluster: names a document's copies, by default a hash of its text in lower case, white space as blanks."""
    prepare(docs.sparkSession)
    text = docs["text"].cast("string")
    if cluster is None:
        cluster = F.xxhash64(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"{SPACE_CLASS}+", " ")))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), text.alias("text"), cluster.alias("cluster"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    rows = materialize(rows.mapInArrow(_lengths(path), "doc_id long, source string, n long, cluster long, salt long"), "pack-lengths")
    pieces = F.greatest(F.lit(1), F.ceil(F.col("n") / capacity)).cast("int")
    total = rows.agg(F.coalesce(F.sum(pieces), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_pieces))
    cut = rows.select("doc_id", "source", "cluster", "salt", "n", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    cut = cut.withColumn("length", F.least(F.col("n") - F.col("piece") * capacity, F.lit(capacity)).cast("int"))
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("salt", "piece"), F.lit(shards)).cast("int")).drop("n")
    return cut.groupBy("shard").applyInPandas(_pack(capacity, per_source), SCHEMA)
