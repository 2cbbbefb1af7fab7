"""N-gram Jaccard self-join with signature trees: documents whose word-shingle sets are alike, as components.

1. Documents become sets of hashed shingles (tokens); equal sets are one node.  For each token the number of documents
   that hold it is looked up (`lookup`).
2. A set of n tokens needs ceil(n * percent / 100) of them in any set that it links with: a set with fewer tokens that
   other documents hold, too, links with nothing.  The forest's roots are tokens: a set's tokens are ordered by how many
   documents hold them, rarest first, and linked sets share a token among the first n - ceil(n * percent / 100) + 1 of
   each.  Those tokens, but for those that no other document has, are the set's roots.
3. Within a root every node is paired with the root's smallest node (per task first, then over all tasks): as many pairs
   as members.  Pairs are verified exactly and give first components.
4. Roots that still hold several components get signature trees: nodes carry OR-combined token bitmaps and size ranges; a
   dual traversal drops node pairs whose largest possible overlap is too small or whose leaves are all one component
   already.  What is left is verified exactly.  Roots of many members are cut into blocks of sets of about one size (sets
   that link are of one size class or of neighbouring ones), joined block by block.

Defined results: a text without words, or null, has an empty set, is linked with nothing and is its own component; a text
with fewer words than a shingle has is one shingle; rows of one doc_id are one document, which links whatever one of its
texts links; null ids count as documents without a name (they link others, their component_id is the smallest id that
there is, null if there is none); repeated rows each get their result; extra columns, whatever their names, are ignored;
an empty table gives an empty result.  Very long texts are held whole by one task.  Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lookup
from .common import as_bytes, discard, hashed_words, materialize, mix, prepare, remove, signed, windows

FANOUT = 32
BLOCK = 512
DEAL_TOKENS = 1 << 20
FLUSH = 1 << 19
ROUNDS = 100


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one text after the other, and their counts."""
    words, counts = hashed_words(texts)
    value, starts = windows(words, counts, size)
    owner = np.repeat(np.arange(len(texts)), counts)
    parts = [(value, owner[starts])]
    for k in range(1, size):  # shorter texts are one shingle
        v, s = windows(words, counts, k)
        own = owner[s]
        short = counts[own] == k
        parts.append((v[short], own[short]))
    value, own = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    if any(len(p[0]) for p in parts[1:]):
        order = np.argsort(own, kind="stable")
        value, own = value[order], own[order]
    bounds = np.searchsorted(own, np.arange(len(texts) + 1))
    sets = [np.unique(value[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return (np.concatenate(sets) if sets else value), np.array([len(x) for x in sets], np.int64)


def set_keys(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set."""
    with np.errstate(over="ignore"):
        total = np.r_[np.uint64(0), np.cumsum(mix(values + np.uint64(0x632BE59BD9B4E019)), dtype=np.uint64)]
        ends = np.cumsum(sizes)
        return mix((total[ends] - total[ends - sizes]) * np.uint64(0x9E3779B97F4A7C15) + sizes.astype(np.uint64))


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes that rise with them, eight steps each time they double; 0 for what one document has."""
    return np.minimum(255, np.ceil(8 * np.log2(np.maximum(counts, 1)))).astype(np.uint8)


def rare_roots(values: np.ndarray, sizes: np.ndarray, held: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The root keys of each set, and the set's number.  held: the level of each token."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    need = (percent * sizes + 99) // 100
    can = np.bincount(owner[held > 0], minlength=len(sizes)) >= need
    at = np.flatnonzero(can[owner])
    values, held, owner = values[at], held[at], owner[at]
    sizes, need = np.where(can, sizes, 0), np.where(can, need, 0)
    mixed = mix(values + np.uint64(0xD1B54A32D192ED03))
    # one key in the order of levels, then hashes; the sort by owner keeps it
    order = np.argsort((held.astype(np.uint64) << np.uint64(56)) | (mixed >> np.uint64(8)), kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    use = order[(rank < (sizes - need + 1)[owner]) & (held[order] > 0)]
    return mixed[use], owner[use]


def _tokens_of(size: int):
    def keys(batch: pa.RecordBatch) -> list:
        return [(shingle_sets(as_bytes(batch.column("text")), size)[0], None)]

    return keys


ROOTED = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("name", pa.string()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("root", pa.int64()), ("hub", pa.int64()), ("tokens", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])
ROOTED_DDL = "kind int, doc_id long, name string, n_shingles long, node long, root long, hub long, tokens array<long>, bits array<long>"


def _rows(n: int, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(n, f.type)) for f in ROOTED], schema=ROOTED)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in parts])].astype(np.int32)), pa.array(signed(np.concatenate(parts))))


def _rooted(size: int, percent: int):
    """Rows of three kinds: 0 a document and its node; 1 a root and one of its nodes (hub: what the task has paired the node with already); 2 a node that has roots, with its set and bitmap."""

    def run(answered: Iterator[tuple[pa.RecordBatch, list, list]]) -> Iterator[pa.RecordBatch]:
        held, n, seen = [], 0, set()

        def flush() -> Iterator[pa.RecordBatch]:
            root, node = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            order = np.lexsort((node, root))
            root, node = root[order], node[order]
            first = np.r_[True, root[1:] != root[:-1]]
            again = np.r_[False, (root[1:] == root[:-1]) & (node[1:] == node[:-1])]
            hub = node[np.maximum.accumulate(np.where(first, np.arange(len(root)), 0))]
            root, node, hub, first = root[~again], node[~again], hub[~again], first[~again]
            for a in range(0, len(root), 200_000):
                s = slice(a, a + 200_000)
                yield _rows(len(root[s]), kind=pa.array(np.ones(len(root[s]), np.int32)), root=pa.array(signed(root[s])), node=pa.array(signed(node[s])), hub=pa.array(signed(hub[s]), mask=first[s]))

        for batch, _, (level,) in answered:
            values, sizes = shingle_sets(as_bytes(batch.column("text")), size)
            node, rows = set_keys(values, sizes), batch.num_rows
            yield _rows(rows, kind=pa.array(np.zeros(rows, np.int32)), doc_id=batch.column("doc_id"), name=batch.column("name"), n_shingles=pa.array(sizes), node=pa.array(signed(node)))
            root, owner = rare_roots(values, sizes, level, percent)
            if not len(root):
                continue
            held.append((root, node[owner]))
            n += len(root)
            if len(seen) > 500_000:
                seen.clear()
            ends, fresh = np.cumsum(sizes), []
            for i in np.unique(owner).tolist():
                if (key := int(node[i])) not in seen:
                    seen.add(key)
                    fresh.append(i)
            for a in range(0, len(fresh), 500):
                own = fresh[a : a + 500]
                sets = [values[ends[i] - sizes[i] : ends[i]] for i in own]
                bits = [np.frombuffer(x, np.uint64) for x in signatures(np.concatenate(sets), sizes[own], 2)]
                yield _rows(len(own), kind=pa.array(np.full(len(own), 2, np.int32)), n_shingles=pa.array(sizes[own]), node=pa.array(signed(node[own])), tokens=_lists(sets), bits=_lists(bits))
            if n >= FLUSH:
                yield from flush()
                held, n = [], 0
        if held:
            yield from flush()

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of root and node: each root's nodes paired with its first, and the pairs that tasks made."""
    last, last_hub = None, None
    for batch in batches:
        root, node = batch.column("root").to_numpy(zero_copy_only=False), batch.column("node").to_numpy(zero_copy_only=False)
        own = batch.column("hub")
        paired = np.asarray(own.is_valid())
        hub = np.where(paired, own.fill_null(0).to_numpy(zero_copy_only=False), 0)
        at = np.flatnonzero(~paired)
        if len(at):
            r, v = root[at], node[at]
            first = np.r_[r[0] != last, r[1:] != r[:-1]]
            starts = np.maximum.accumulate(np.where(first, np.arange(len(r)), -1))
            h = np.where(starts >= 0, v[np.maximum(starts, 0)], last_hub if last_hub is not None else 0)
            last, last_hub = r[-1], h[-1]
            hub[at] = h
        use = hub != node
        yield pa.RecordBatch.from_arrays([pa.array(root[use]), pa.array(node[use]), pa.array(hub[use])], names=["root", "a", "b"])


def components(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(node, component) of all ends of the edges (a, b): alternating large and small stars, written after each round.

    Rounds grow with the logarithm of the longest chain; if they don't end within `rounds`, an error says so.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).groupBy("a", "b").count().drop("count"), "edges")
    state = None
    for _ in range(rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "stars")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").groupBy("a", "b").count().drop("count")
        large = materialize(large, "edges")
        discard(now, least)
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "stars")
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b")
        now = materialize(small.groupBy("a", "b").count().drop("count"), "edges")
        discard(large, least)
        found = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if found == state:
            out = now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
            out.written_to = now.written_to
            return out
        state = found
    raise RuntimeError(f"components aren't found after {rounds} rounds")


def signatures(values: np.ndarray, sizes: np.ndarray, each: int = 8) -> list[bytes]:
    """A token bitmap of each set: at least `each` bits a token, a power of two in all."""
    ends, out = np.cumsum(sizes), []
    for n, e in zip(sizes.tolist(), ends.tolist(), strict=True):
        width = max(512, 1 << (each * max(n, 1) - 1).bit_length())
        bits = np.zeros(width, np.uint8)
        bits[(values[e - n : e] >> np.uint64(8)) & np.uint64(width - 1)] = 1
        out.append(np.packbits(bits, bitorder="little").tobytes())
    return out


def folded(bitmaps: list[bytes], width: int) -> np.ndarray:
    """Bitmaps of one width (bytes): a wider one's bits fall on the bits they have in a narrower one."""
    out = np.zeros((len(bitmaps), width), np.uint8)
    for i, x in enumerate(bitmaps):
        out[i] = np.bitwise_or.reduce(np.frombuffer(x, np.uint8).reshape(-1, width))
    return out.view(np.uint64)


class Tree:
    """A signature tree over sets: levels of nodes with OR- and AND-combined token bitmaps, size ranges and component ranges."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        # size first, then the bitmap: neighbours are alike
        self.order = np.lexsort((bits[:, 1], bits[:, 0], sizes))
        bits, sizes, labels = bits[self.order], sizes[self.order], labels[self.order]
        self.levels = [(bits, bits, sizes, sizes, labels, labels)]
        while len(self.levels[-1][0]) > 1:
            at = np.arange(0, len(self.levels[-1][0]), FANOUT)
            how = (np.bitwise_or, np.bitwise_and, np.minimum, np.maximum, np.minimum, np.maximum)
            self.levels.append(tuple(f.reduceat(x, at) for f, x in zip(how, self.levels[-1], strict=True)))

    def below(self, level: int, k: int) -> tuple[int, np.ndarray]:
        """The level of the node's children and their numbers; a leaf is its own child."""
        if level == 0:
            return 0, np.array([k])
        return level - 1, np.arange(k * FANOUT, min((k + 1) * FANOUT, len(self.levels[level - 1][0])))


def may_link(one: tuple, i: np.ndarray, two: tuple, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of nodes i and j can have a link of two components below them.

    Each bit that all sets of one side have and none of the other side's is a token that isn't common, which bounds the
    overlap; sizes bound it too.
    """
    ors, ands, lo, hi, first, last = (x[i] for x in one)
    ors2, ands2, lo2, hi2, first2, last2 = (x[j] for x in two)
    only, only2 = np.zeros((len(i), len(j)), np.int64), np.zeros((len(i), len(j)), np.int64)
    for w in range(ors.shape[1]):
        only += np.bitwise_count(ands[:, None, w] & ~ors2[None, :, w])
        only2 += np.bitwise_count(ands2[None, :, w] & ~ors[:, None, w])
    overlap = np.minimum(hi[:, None] - only, hi2[None, :] - only2)
    fits = (100 + percent) * overlap >= percent * (lo[:, None] + lo2[None, :])
    same = (first[:, None] == last2[None, :]) & (last[:, None] == first2[None, :])
    return fits & ~same


def tree_pairs(one: Tree, two: Tree, percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of different components that the bitmaps and sizes can't rule out, as positions in the trees' original orders."""
    out, stack = [], [(len(one.levels) - 1, 0, len(two.levels) - 1, 0)]
    while stack:
        p, k, q, m = stack.pop()
        (p2, i), (q2, j) = one.below(p, k), two.below(q, m)
        hit = may_link(one.levels[p2], i, two.levels[q2], j, percent)
        if one is two and p2 == q2:
            hit &= i[:, None] <= j[None, :] if p2 else i[:, None] < j[None, :]
        a, b = np.nonzero(hit)
        if p2 == 0 and q2 == 0:
            if len(a):
                out.append((one.order[i[a]], two.order[j[b]]))
        else:
            stack.extend((p2, x, q2, y) for x, y in zip(i[a].tolist(), j[b].tolist(), strict=True))
    return out


def _tree_join(percent: int, bitmaps: bool):
    """Of roots' members and their sets: verified links, no more than join the components that the members are of.

    bitmaps: sets are bitmaps; returns the members, as pairs of themselves, that can have a link.
    """

    def run(members: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        nodes = sets["key"].to_numpy(np.int64)
        order = np.argsort(nodes)
        nodes, tokens = nodes[order], [np.asarray(sets["tokens"].iloc[i], np.int64) for i in order.tolist()]
        sizes = sets["size"].to_numpy(np.int64)[order]
        bits = [x.tobytes() for x in tokens] if bitmaps else signatures(np.concatenate(tokens).view(np.uint64), sizes) if tokens else []
        members = members[members["node"].isin(nodes)].sort_values(["root", "x", "y"], kind="stable")
        key = members[["root", "x", "y"]].to_numpy()
        which = np.searchsorted(nodes, members["node"].to_numpy())
        block, label = members["block"].to_numpy(), np.zeros(len(nodes), np.int64)
        label[which] = members["component"].to_numpy()
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        cuts = np.unique(np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, len(key)])
        links, unlike, hit = [], set(), np.zeros(len(nodes), bool)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            x, y = key[a, 1], key[a, 2]
            mine, other = which[a:b][block[a:b] == x], which[a:b][block[a:b] == y]
            if not len(mine) or not len(other):
                continue
            width = min(len(bits[i]) for i in which[a:b].tolist())
            now = lambda own: np.array([find(c) for c in label[own].tolist()], np.int64)
            one = Tree(folded([bits[i] for i in mine.tolist()], width), sizes[mine], now(mine))
            two = one if x == y else Tree(folded([bits[i] for i in other.tolist()], width), sizes[other], now(other))
            for i, j in tree_pairs(one, two, percent):
                if bitmaps:
                    hit[mine[i]] = True
                    hit[other[j]] = True
                    continue
                for u, v in zip(mine[i].tolist(), other[j].tolist(), strict=True):
                    cu, cv = find(int(label[u])), find(int(label[v]))
                    pair = (u, v) if u < v else (v, u)
                    if cu == cv or pair in unlike:
                        continue
                    common = len(np.intersect1d(tokens[u], tokens[v], assume_unique=True))
                    if 100 * common >= percent * (len(tokens[u]) + len(tokens[v]) - common):
                        parent[cu] = cv
                        links.append((nodes[u], nodes[v]))
                    else:
                        unlike.add(pair)
        if bitmaps:
            return pd.DataFrame({"deal": members["deal"].iloc[0] if len(members) else 0, "node": nodes[hit]})
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def plausible(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps don't rule out.  Bitmaps of different widths are compared by sizes alone."""
    one = pairs.join(bitmaps.select(F.col("node").alias("a"), F.col("size").alias("na"), F.col("tokens").alias("ta")), "a").where("na is not null")
    two = one.join(bitmaps.select(F.col("node").alias("b"), F.col("size").alias("nb"), F.col("tokens").alias("tb")), "b")
    only = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseAND(F.bitwise_not(v)))), F.lit(0), lambda t, n: t + n)
    same = F.size("ta") == F.size("tb")
    overlap = F.least(F.col("na") - F.when(same, only("ta", "tb")).otherwise(0), F.col("nb") - F.when(same, only("tb", "ta")).otherwise(0))
    return two.where((100 + percent) * overlap >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
    common = F.size(F.array_intersect("ta", "tb"))
    return two.select("a", "b", common.alias("n"), (F.size("ta") + F.size("tb")).alias("both")).where(100 * F.col("n") >= percent * (F.col("both") - F.col("n"))).select("a", "b")


def tree_links(seen: DataFrame, bitmaps: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links within roots that hold several components.  seen: (root, a, b, ca, cb), pairs with their components."""
    # a root of one pair is decided; so is one whose members are all one component
    open_roots = materialize(seen.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min(F.least("ca", "cb")).alias("family"), F.max((F.col("ca") != F.col("cb")).cast("int")).alias("open")).where("open = 1 and n > 1").select("root", "n", "family"), "jaccard-open")
    if open_roots.isEmpty():
        discard(open_roots)
        return None
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("ca").alias("component")), F.struct(F.col("b").alias("node"), F.col("cb").alias("component"))))
    held = seen.join(open_roots, "root").select("root", "n", "family", ends.alias("e")).select("root", "n", "family", "e.*").distinct()
    # a class is a bit wider than the largest ratio of linked sets' sizes; a root of one block has one class
    size_class = F.floor(F.log("size") / (1.0001 * math.log(100 / percent))).cast("int") if percent < 100 else F.col("size").cast("int")
    held = materialize(held.join(bitmaps.select("node", "size"), "node").withColumn("class", F.when(F.col("n") < BLOCK, 0).otherwise(size_class)), "jaccard-held")
    sizes = materialize(held.groupBy("root", "class").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "jaccard-blocks")
    near = sizes.select(F.col("root").alias("of"), "blocks", F.explode(F.array(*[F.struct((F.col("class") + k).alias("to"), F.lit(-k).alias("step")) for k in (-1, 0, 1)])).alias("e")).select("of", "blocks", "e.*")
    near = near.groupBy("of", "to").agg(F.collect_list(F.struct("step", "blocks")).alias("near"))  # three at most
    held = held.join(near, (F.col("root") == F.col("of")) & (F.col("class") == F.col("to")))
    number = lambda level, k: level.cast("long") * (1 << 32) + k
    mine = F.filter("near", lambda e: e["step"] == 0)[0]["blocks"]
    held = held.withColumn("block", number(F.col("class"), F.pmod(F.xxhash64("node"), mine)))
    others = F.flatten(F.transform("near", lambda e: F.transform(F.sequence(F.lit(0), e["blocks"] - 1), lambda k: number(F.col("class") + e["step"], k))))
    both = F.transform(others, lambda k: F.struct(F.least(k, F.col("block")).alias("x"), F.greatest(k, F.col("block")).alias("y")))
    dealt = materialize(held.select("root", "family", "node", "component", "block", "size", F.explode(both).alias("k")).select("root", "family", "node", "component", "block", "size", "k.x", "k.y"), "jaccard-dealt")
    # roots of one family go together, as its sets are needed in each of them, as far as a bounded size allows
    weights = materialize(dealt.groupBy("family").agg(F.ceil(F.sum("size") / DEAL_TOKENS).alias("cuts"), F.sum("size").alias("size")), "jaccard-families")
    deals = max(1, (weights.agg(F.sum("size")).first()[0] or 0) // DEAL_TOKENS)
    cut = F.pmod(F.xxhash64("root", "x", "y"), F.col("cuts"))
    deal = F.when(F.col("cuts") > 1, F.xxhash64("family", cut)).otherwise(F.pmod(F.xxhash64("family"), F.lit(deals)))
    dealt = materialize(dealt.join(weights.select("family", "cuts"), "family").select("root", "node", "component", "block", "x", "y", deal.alias("deal")), "jaccard-deals")
    shipped = lambda at, sets: at.select(F.col("deal").alias("at"), F.col("node").alias("key")).distinct().join(sets.select(F.col("node").alias("key"), "size", "tokens"), "key")
    # bitmaps first: most members can't have a link, and their sets aren't sent
    can = materialize(dealt.groupBy("deal").cogroup(shipped(dealt, bitmaps).groupBy("at")).applyInPandas(_tree_join(percent, True), "deal long, node long"), "jaccard-can")
    left = dealt.join(can.distinct(), ["deal", "node"], "left_semi")
    links = materialize(left.groupBy("deal").cogroup(shipped(can, sets).groupBy("at")).applyInPandas(_tree_join(percent, False), "a long, b long"), "jaccard-tree-links")
    discard(open_roots, sizes, weights, dealt, can)
    return links


def labelled(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, name, n_shingles, node, label, component_id) of each row, written.  label: of the row's component; name: of the row's text where it has no id."""
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    text = docs["text"].cast("string")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.when(docs["doc_id"].isNull(), F.sha2(F.coalesce(text, F.lit("")), 256)).alias("name"), text.alias("text"))
    pieces = lookup.store(rows, "jaccard-texts")
    segments, tokens = lookup.segments_of(pieces), _tokens_of(size)
    owned = lookup.asked(pieces, tokens, [lambda _, n: levels(n)], segments)
    rooted = materialize(lookup.used(pieces, owned, tokens, [np.uint8], segments, _rooted(size, percent), ROOTED_DDL), "jaccard-rooted")
    for path in [r[0] for r in pieces.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1)).distinct().collect()]:  # one folder
        remove(spark, path)
    members = rooted.where("kind = 0").select("doc_id", "name", "n_shingles", "node")
    # rows that are paired already needn't meet others of their root
    deal = F.when(F.col("hub").isNull(), F.col("root")).otherwise(F.xxhash64("root", "node"))
    dealt = rooted.where("kind = 1").select("root", "node", "hub").repartition(deal).sortWithinPartitions("root", "node")
    stars = materialize(dealt.mapInArrow(_stars, "root long, a long, b long"), "jaccard-stars")
    pairs = materialize(stars.groupBy("a", "b").count().drop("count"), "jaccard-pairs")
    # rows of one id are one document, whatever their texts
    same = members.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b <> most").select("doc_id", "b")
    same = members.where("n_shingles > 0").join(same, "doc_id").select(F.col("node").alias("a"), "b").where("a <> b")
    edges = [materialize(same, "jaccard-same")]
    if not pairs.isEmpty():
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        known = rooted.where("kind = 2").join(wanted, "node", "left_semi").groupBy("node").agg(F.any_value("n_shingles").alias("size"), F.any_value("tokens").alias("tokens"), F.any_value("bits").alias("bits"))
        known = materialize(known, "jaccard-sets")
        bitmaps, sets = known.select("node", "size", F.col("bits").alias("tokens")), known.select("node", "size", "tokens")
        near = materialize(plausible(pairs, bitmaps, percent), "jaccard-near")
        edges.append(materialize(verified(near, sets, percent), "jaccard-links"))
        discard(near)
        first = components(edges[-1])
        label = lambda c: first.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
        seen = stars.join(label("a"), "a", "left").join(label("b"), "b", "left").select("root", "a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
        seen = materialize(seen, "jaccard-seen")
        discard(first)
        if (more := tree_links(seen, bitmaps, sets, percent)) is not None:
            edges.append(more)
        discard(seen, known)
    discard(stars, pairs)
    reach = components(edges[0].unionByName(edges[1]).unionByName(edges[2]) if len(edges) == 3 else edges[0].unionByName(edges[1]) if len(edges) == 2 else edges[0])
    named = members.join(reach.select(F.col("node").alias("of"), "component"), F.col("node") == F.col("of"), "left")
    # an empty set is its own component: its row's id or nothing
    named = materialize(named.select("doc_id", "name", "n_shingles", "node", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")).alias("label")), "jaccard-named")
    # written, so that the join is one of two exchanges, of which a skewed one can be split
    least = named.where("label is not null").groupBy(F.col("label").alias("of")).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    least = materialize(least.where("n > 1").select("of", "least"), "jaccard-least")
    out = named.join(least, F.col("label") == F.col("of"), "left")
    out = materialize(out.select("doc_id", "name", "n_shingles", "node", "label", F.coalesce("least", "doc_id").alias("component_id")), "jaccard-labelled")
    discard(rooted, reach, named, least, *edges)
    return out


def jaccard_components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id of each row.  Two rows link when 100 * intersection >= percent * union."""
    return labelled(docs, size, percent).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, whole: of each component one document, that of smallest id.

    Defined results: of rows of one id one stays; a row without an id goes where its component has an id, else the one
    whose text has the smallest hash stays; a text without words is alone in its component, but of rows without an id
    that have equal texts one stays; extra columns, whatever their names, are kept; an empty table gives an empty result.
    """
    found = labelled(docs, size, percent)
    lost = materialize(found.where("doc_id <> component_id").select("doc_id").distinct(), "jaccard-lost")
    kept = docs.join(lost, docs["doc_id"].cast("long") == lost["doc_id"], "left_anti")
    counts = found.agg(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
    if counts[0] == counts[1]:
        return kept
    nameless = found.where("doc_id is null")
    first = nameless.where("label is not null").groupBy("label").agg(F.min("name").alias("first"))
    gone = nameless.join(first.select(F.col("label").alias("of"), "first"), F.col("label") == F.col("of"), "left").where("component_id is not null or name <> first").select("name").distinct()
    gone = materialize(gone, "jaccard-nameless")
    own = f"_{uuid.uuid4().hex}"
    kept = kept.withColumn(own, F.coalesce(kept["doc_id"].cast("string"), F.sha2(F.coalesce(kept["text"].cast("string"), F.lit("")), 256)))
    return kept.join(gone, kept["doc_id"].isNull() & (kept[own] == gone["name"]), "left_anti").dropDuplicates([own]).drop(own)
