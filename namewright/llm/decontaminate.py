"""Benchmark decontamination: items of which a document holds most shingles, found with DataFrame operations only.

Items are partitioned by size: those of up to 1, 2, 4, 8, ... shingles.  An item is represented by its k smallest shingle
hashes, k = floor((1 - threshold) * s) + 1 for its partition's upper size s (a bottom-k MinHash sketch; shingles that
several items have come after all others): a document that lacks at most (1 - threshold) of an item's shingles holds one
of them, so the search loses nothing, however long the document is.  Documents are probed shingle by shingle against the
sketches of each partition; candidates are verified by the exact, whole set of shingles.

Words are runs of letters and digits, in lower case.  An item with fewer words than a shingle has is one shingle of its
words.  Defined results: a null or empty item matches nothing, as does a null or empty text; rows of one doc_id (or
item_id) are one document (one item); null ids are ignored; equal items each match; extra columns, whatever their names,
are ignored; an empty table of either kind gives an empty result; a very long text's words are held by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SIZE, PERCENT = 5, 80
#: Sketches of at most this many hashes are broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_HASHES = 1_000_000
#: The same for the items' shingles as texts (some 60 bytes each).
BROADCAST_SHINGLES = 250_000


def words_of(text: str = "text") -> Column:
    return F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def gram(words: Column, i: Column, size: int) -> Column:
    return F.concat_ws(" ", F.slice(words, i, size))


def gram_hashes(words: str, size: int) -> Column:
    """Hashes of all runs of `size` words, one after the other."""
    w = F.col(words)
    own = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
    return F.when(F.size(w) >= size, own).otherwise(F.array().cast("array<long>"))


def gram_texts(words: str, size: int) -> Column:
    w = F.col(words)
    own = F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: gram(w, i, size))
    return F.when(F.size(w) >= size, own).otherwise(F.array().cast("array<string>"))


def item_shingles(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(item_id, len, gram, hash, n): an item's distinct shingles, n of them, each of len words."""
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), words_of().alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(size))
    own = F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.struct(length.alias("len"), gram(F.col("w"), i, length).alias("gram")))
    rows = items.select("item_id", F.explode(own).alias("e")).select("item_id", "e.len", "e.gram").groupBy("item_id", "len", "gram").count().drop("count")
    parts = F.split("gram", " ")
    by_length = F.coalesce(*[F.when(F.col("len") == k, F.xxhash64(*[F.get(parts, F.lit(j)) for j in range(k)])) for k in range(1, size + 1)])
    sizes = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("hash", by_length).join(sizes, "item_id")


def sketches(shingles: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(item_id, len, hash): of each item the smallest hashes, as many as its size partition asks for."""
    owners = shingles.groupBy("len", "hash").agg(F.count(F.lit(1)).alias("owners"))
    ordered = shingles.join(owners, ["len", "hash"]).withColumn("place", F.struct((F.col("owners") > 1).cast("int"), "hash"))
    held = ordered.groupBy("item_id", "len", "n").agg(F.array_sort(F.collect_set("place")).alias("places"))  # one item's shingles
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("n")))
    k = F.floor(upper * (100 - percent) / 100) + 1
    return held.select("item_id", "len", F.explode(F.slice("places", F.lit(1), k.cast("int"))).alias("place")).select("item_id", "len", "place.hash")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found): the items of which a document holds at least percent of the shingles."""
    shingles = materialize(item_shingles(benchmark, size), "bench-shingles")
    sketch = materialize(sketches(shingles, percent), "bench-sketches")
    lengths = sorted(r[0] for r in sketch.select("len").distinct().collect())  # 1 to size
    small, short = sketch.count() <= BROADCAST_HASHES, shingles.count() <= BROADCAST_SHINGLES
    probes = sketch.select("hash", "len").distinct()
    # equal hashes of several items are one probe; the items come back after it
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).where("doc_id is not null and text is not null").select("doc_id", words_of().alias("w"))
    if not lengths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_shingles long, n_found long")
    by_length = F.array(*[F.struct(F.lit(k).alias("len"), gram_hashes("w", k).alias("hashes")) for k in lengths])
    grams = rows.select("doc_id", F.explode(by_length).alias("e")).select("doc_id", "e.len", F.explode("e.hashes").alias("hash"))
    hits = grams.join(F.broadcast(probes) if small else probes, ["len", "hash"]).groupBy("doc_id", "len", "hash").count().drop("count")
    pairs = materialize(hits.join(F.broadcast(sketch) if small else sketch, ["len", "hash"]).groupBy("doc_id", "item_id").count().drop("count"), "bench-pairs")
    found = pairs.select("doc_id").distinct()
    texts = rows.join(found, "doc_id", "left_semi")
    by_length = F.array(*[F.struct(F.lit(k).alias("len"), F.array_distinct(gram_texts("w", k)).alias("grams")) for k in lengths])
    held = texts.select("doc_id", F.explode(by_length).alias("e")).select("doc_id", "e.len", F.explode("e.grams").alias("gram"))
    wanted = shingles.select("item_id", "len", "gram", F.col("n").alias("n_shingles"))
    exact = held.join(F.broadcast(wanted) if short else wanted, ["len", "gram"]).groupBy("doc_id", "item_id", "n_shingles").agg(F.countDistinct("gram").alias("n_found"))
    return exact.where(100 * F.col("n_found") >= percent * F.col("n_shingles")).join(pairs, ["doc_id", "item_id"], "left_semi").select("doc_id", "item_id", "n_shingles", "n_found")


def without_items(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, whole, that hold no item.

    Defined results: rows without an id are known by their text; null and empty texts stay; repeated rows, and rows that
    share an id with a text that holds an item, go together; extra columns, whatever their names, are kept.
    """
    key = F.coalesce(docs["doc_id"].cast("long"), F.xxhash64(docs["text"]))
    bad = materialize(contamination(docs.select(key.alias("doc_id"), docs["text"]), benchmark, size, percent).select("doc_id").distinct(), "bench-documents")
    return docs.join(bad, key == bad["doc_id"], "left_anti")
