"""Each operator against brute force on a small table with nulls, empty and repeated rows, and extra columns."""

import base64
import hashlib
import math
import tracemalloc
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pytest

from namewright.llm import decontaminate, grammar, jaccard_tree, language_mix, lm, packing, quality, queries, tokens, toxicity, warc

LOWER = bytes(range(256)).lower()
SF = "/root/testdata/sf0.001"
BPE = tokens.vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    long = "x" * 3000 + " ähm 12's\n\n  tail <|endoftext|> 日本 " * 60
    more = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", None, 0), (9003, "one", "en", "s", 3), (9004, "one", "en", "s", 3), (9005, long, "en", "s", 9), (9005, long, "en", "s", 9), (None, "no id at all here", "en", "s", 1)], df.schema)
    from pyspark.sql import functions as F

    return df.union(more).withColumns({"score": F.lit(1), "node": F.lit("x"), "hash": F.lit(2), "payload": F.lit(3)}).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def empty(df):
    return df.limit(0)


def words(text):
    return text.encode().translate(LOWER).split()


def test_warc(spark):
    pages = spark.createDataFrame([(1, "u1", "a" * 700_000), (2, "u2", "a" * 700_000), (3, None, None), (4, "u\n4", ""), (5, "ü", "é\r\n\r\nx"), (None, "n", "é\r\n\r\nx"), (7, "r", "rr"), (7, "r", "rr")], "page_id long, url string, html string")
    got = sorted([(r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_digests(pages).collect()])
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    want = [(1, 700_000, digest("a" * 700_000), "revisit", 2), (2, 700_000, digest("a" * 700_000), "response", None), (3, 0, digest(""), "revisit", 4), (4, 0, digest(""), "response", None), (5, 8, digest("é\r\n\r\nx"), "response", None), (-1, 8, digest("é\r\n\r\nx"), "revisit", 5), (7, 2, digest("rr"), "response", None), (7, 2, digest("rr"), "response", None)]
    assert [x[:4] for x in got] == sorted(x[:4] for x in [(w[0], len("é\r\n\r\nx".encode()) if w[2] == digest("é\r\n\r\nx") else w[1], *w[2:]) for w in want])
    table = sorted(warc.chunk_table(pages.where("page_id = 2"), chunk_bytes=1000).collect(), key=lambda r: r.chunk_no)
    assert [r.chunk_offset for r in table] == list(range(0, 700_000, 1000)) and all(r.digest_so_far == digest("a" * (r.chunk_offset + 1000)) for r in table) and [r.is_last for r in table].index(True) == 699
    manifest = warc.write_archives(warc.chunk_table(pages.where("page_id = 2"), chunk_bytes=1000))
    chunks = sorted(warc.read_archives(manifest, chunk_bytes=100_000).collect(), key=lambda r: r.chunk_no)
    assert len(chunks) > 4 and b"".join(bytes(c.data) for c in chunks) == b"a" * 700_000
    assert all(c.digest_so_far == digest("a" * (c.chunk_offset + len(c.data))) for c in chunks)
    assert warc.archive_digests(empty(pages)).count() == 0
    extra = pages.selectExpr("*", "1 as sha", "2 as payload", "3 as refers_to", "4 as n_bytes")
    assert warc.archive_digests(extra).count() == 8

def test_many_tasks_write_archives_and_one_writes_their_list(spark):
    pages = spark.range(40).selectExpr("id as page_id", "cast(null as string) as url", "concat('page ', id % 10) as html").repartition(4)
    manifest = warc.write_archives(warc.chunk_table(pages))
    assert manifest.count() > 1 and len(manifest.inputFiles()) == 1
    assert sum(r.n_records for r in manifest.collect()) == 40 == warc.read_archives(manifest).where("is_last").count()


def brute_lm(toks):
    """(base, score) of each text, of true counts; toks: (id, words and None)."""
    count, pairs, triples = Counter(), Counter(), Counter()
    for i, w in toks:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            count.update(w)
            pairs.update(zip([None, *w], w, strict=False))
            triples.update(zip([None, *w], w, w[1:], strict=False))
    n, v = sum(count.values()), len(count)
    values = lm.VALUES.tolist()
    floor = lambda c: values[bisect_right(values, c) - 1]
    ceil = lambda c: values[bisect_right(values, c)] - 1 if c else 0
    p1 = lambda w: (count[w] + 1) / (n + v + 1)
    p2 = lambda a, w: (floor(pairs[a, w]) + lm.MU2 * p1(w)) / (count[a] + lm.MU2)
    p3 = lambda a, b, w: (min(floor(triples[a, b, w]), ceil(pairs[a, b])) + lm.MU3 * p2(b, w)) / (ceil(pairs[a, b]) + lm.MU3)
    out = []
    for i, w in toks:
        p = [p2(None, w[0])] + [p3(w[k - 2] if k > 1 else None, w[k - 1], w[k]) for k in range(1, len(w))]
        out.append((i, len(w), sum(count[x] > 0 for x in w), n, sum(map(math.log10, map(p1, w))), sum(map(math.log10, p))))
    return out, count, p2, p3, pairs


def test_lm(docs, rows):
    got = sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm.score_corpus(docs).collect())
    toks = [(i, words(t) + [None]) for i, t in rows]
    want, count, p2, p3, pairs = brute_lm(toks)
    want = sorted((i or -1, *w) for i, *w in want)
    assert [g[:4] for g in got] == [w[:4] for w in want] and all(abs(g[4] - w[4]) < 1e-6 * abs(w[4]) for g, w in zip(got, want, strict=True))
    # but for false hits, of which a filter of 10 bits a key has some in a hundred
    assert np.median([abs(g[5] - w[5]) / abs(w[5]) for g, w in zip(got, want, strict=True)]) < 0.01
    known = [*count, "never seen"]
    for a, b in [*list(pairs)[:20], *[p for p, _ in pairs.most_common(20) if p[1] is not None]]:
        if b is not None:
            assert 0.95 < sum(p2(b, w) for w in known) <= 1 + 1e-9 and 0.9 < sum(p3(a, b, w) for w in known) <= 1 + 1e-9
    exact = sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm.score_corpus(docs, segment_bytes=20_000, bits_per_key=60, probes=16).collect())
    assert all(abs(g[5] - w[5]) < 1e-6 * abs(w[5]) for g, w in zip(exact, want, strict=True))
    assert lm.score_corpus(empty(docs)).count() == 0


def test_lm_levels():
    keys, counts = np.arange(1, 5000, dtype=np.uint64), np.arange(1, 5000) % 300 + 1
    flat = lm.build_filter(keys, counts)
    level = lm.probe(flat, keys)
    assert (level >= lm.levels(counts)).all() and (level == lm.levels(counts)).mean() > 0.95
    assert (lm.probe(flat, keys + np.uint64(10_000)) > 0).mean() < 0.03
    counts = np.array([1, 2, 64, 65, 66, 1000, 10**6, 10**12])
    assert (lm.VALUES[lm.levels(counts)] <= counts).all() and (lm.most(lm.levels(counts)) >= counts).all()
    assert (lm.VALUES[lm.levels(counts)] > counts * (1 - 1 / lm.STEPS)).all() and lm.most(np.array([0, 1, 63, 64])).tolist() == [0, 1, 63, 65]


def test_grammar_and_counts(docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    plain = [(i, x, t.encode(x, add_special_tokens=False).ids) for i, x in rows]
    got = sorted([(r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, BPE).collect()])
    assert got == sorted((i or -1, len(x.encode()), len(ids), len(ids) > 512) for i, x, ids in plain)
    start, want = 0, []
    for i, _, ids in sorted(plain, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        own = [*ids, 2]
        want.append((i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    back = sorted([tuple(r) for r in grammar.encode_corpus(docs, BPE).collect()], key=lambda r: r[1])
    assert back == want
    all_ids = np.concatenate([np.array([*ids, 2], np.uint32) for *_, ids in plain])
    block = grammar.Block(grammar.pack_block([i for i, *_ in plain], np.array([len(ids) + 1 for *_, ids in plain]), all_ids, 50257, 2))
    assert len(block.symbols) < len(all_ids) and (block.expand(block.symbols) == all_ids).all()
    assert (block.ids(100, 900) == all_ids[100:900]).all() and block.document(3).tolist() == [*plain[3][2], 2]
    small = tokens.Encoder(BPE, chunk_chars=200, overlap_chars=4)
    assert all([y for p in small.spliced(x) for y in p] == ids for _, x, ids in plain) and small.widened
    assert grammar.encode_corpus(empty(docs), BPE).count() == 0 and tokens.count_tokens(empty(docs), BPE).count() == 0


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_jaccard(spark, docs, rows, size, percent):
    rng = np.random.default_rng(2)
    base = [" ".join(f"w{rng.integers(400)}" for _ in range(rng.integers(12, 120))) for _ in range(6)]
    near = []
    for k in range(240):
        w = base[k % 6].split()
        for _ in range(rng.integers(0, 4)):
            w[rng.integers(len(w))] = f"n{k}"
        near.append((20_000 + k, " ".join(w)))
    table = docs.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id long, text string"))
    all_rows = [*rows, *near]
    sets = {}
    for i, x in all_rows:
        w = words(x)
        sets.setdefault(i, frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    ids = [i for i in sets if i is not None]
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_tree.jaccard_components(table, size, percent).collect() if r.doc_id is not None}
    assert got == {(i, len(sets[i]), find(i)) for i in ids}


def test_jaccard_empty(docs):
    assert jaccard_tree.jaccard_components(empty(docs)).count() == 0
    assert jaccard_tree.one_of_each(empty(docs)).count() == 0


def test_jaccard_joins_the_texts_of_one_id(spark):
    one, two = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    rows = spark.createDataFrame([(0, one), (5, one), (5, two), (7, two), (None, one + " more"), (None, "z y x w v u"), (None, "z y x w v u"), (8, None), (9, "")], "doc_id long, text string")
    got = sorted(((-1 if r.doc_id is None else r.doc_id), r.n_shingles, r.component_id) for r in jaccard_tree.jaccard_components(rows).collect())
    assert got == [(-1, 4, None), (-1, 4, None), (-1, 29, 0), (0, 28, 0), (5, 28, 0), (5, 28, 0), (7, 28, 0), (8, 0, 8), (9, 0, 9)]


def test_one_of_each(spark):
    """Rows without an id, repeated rows, and columns of any name."""
    one = " ".join(f"a{k}" for k in range(60))
    rows = [(3, one, 1), (4, one + " b", 2), (4, one + " b", 2), (None, one + " c", 3), (None, "z y x w v u", 4), (None, "z y x w v u", 5), (6, None, 6), (7, "", 7), (None, None, 8), (None, "", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key int")
    for name in ("_key", "_lost", "node", "component_id", "name"):
        out = jaccard_tree.one_of_each(df.withColumnRenamed("_key", name))
        assert out.columns == ["doc_id", "text", name]
        got = sorted(((-1 if r[0] is None else r[0]), r[1] or "") for r in out.collect())
        assert got == [(-1, ""), (-1, "z y x w v u"), (3, one), (6, ""), (7, "")]


def test_components_say_when_they_do_not_end(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    assert {r.component for r in jaccard_tree.components(chain).collect()} == {0}
    with pytest.raises(RuntimeError):
        jaccard_tree.components(chain, 1)


def test_blocks_of_large_roots(spark, monkeypatch):
    """Many members of one root that stay apart, cut into blocks and dealt to several tasks."""
    monkeypatch.setattr(jaccard_tree, "BLOCK", 8)
    monkeypatch.setattr(jaccard_tree, "DEAL_TOKENS", 500)
    common = [f"c{k}" for k in range(40)]
    rows = [(i, " ".join(common + [f"x{i // 2}y{k}" for k in range(20)] + [f"z{i}"])) for i in range(60)]
    got = {r.doc_id: r.component_id for r in jaccard_tree.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 90).collect()}
    assert got == {i: i // 2 * 2 for i in range(60)}
    # of several sizes, some pairs across the bounds of size classes
    sized = [(i, " ".join([f"c{k}" for k in range(30 + i // 4)] + [f"x{i // 4}y{k}" for k in range(25)] + [f"z{i}q{k}" for k in range(i % 4)])) for i in range(160)]
    sets = {i: set(t.split()) for i, t in sized}
    up = {i: min(j for j in sets if 10 * len(sets[i] & sets[j]) >= 9 * len(sets[i] | sets[j])) for i in sets}
    for _ in range(10):
        up = {i: min(up[j] for j in sets if 10 * len(sets[i] & sets[j]) >= 9 * len(sets[i] | sets[j])) for i in sets}
    got = {r.doc_id: r.component_id for r in jaccard_tree.jaccard_components(spark.createDataFrame(sized, "doc_id long, text string"), 1, 90).collect()}
    assert got == up


def test_language(docs):
    got = {r.doc_id: r for r in language_mix.identify(docs).collect()}
    assert got[9001].lang_pred == got[9002].lang_pred == "und" and all(0 <= r.score <= 1 for r in got.values())
    known = [r for r in docs.collect() if r.lang and r.text and len(r.text) > 200 and r.doc_id != 9005 and got[r.doc_id].held_out]
    assert len(known) > 20 and np.mean([got[r.doc_id].lang_pred == r.lang for r in known]) > 0.95
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1) for r in got.values())
    kept = [r.doc_id for r in language_mix.with_language(docs).collect()]
    assert not {9001, 9002} & set(kept) and set(kept) <= set(got) and language_mix.with_language(empty(docs)).count() == 0
    assert language_mix.identify(empty(docs)).count() == 0


def test_language_learns_every_language(spark):
    """Seventy languages, the last ones with the fewest texts."""
    rng, rows = np.random.default_rng(5), []
    for k in range(70):
        vocabulary = ["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(12)]
        rows += [(len(rows) + i, " ".join(rng.choice(vocabulary, 80 if k < 64 else 40)), f"l{k:02}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, table = language_mix.learn(docs)
    assert names == sorted({r[2] for r in rows}) and table.shape == (70, language_mix.BUCKETS)
    got = {r.doc_id: r.lang_pred for r in language_mix.identify(docs).collect()}
    taught = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1}
    assert len(taught) > 64 and all(got[i] == lang for i, _, lang in rows if lang in taught)


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "solo words"), (3, None), (4, "")], "item_id long, text string")
    texts = spark.createDataFrame([(1, "xx Alpha, beta gamma delta epsilon zeta eta theta iota kappa yy"), (2, "alpha beta gamma delta epsilon"), (3, "the solo; words here"), (4, None), (5, "")], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contamination(texts, bench).collect()) == [(1, 1), (3, 2)]
    more = texts.union(spark.createDataFrame([(None, "solo words of no one"), (1, "other"), (6, "solo words " * 4000)], texts.schema)).selectExpr("*", "1 as _bad", "2 as hash", "3 as w", "4 as item_id")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contamination(more, bench).collect()) == [(1, 1), (3, 2), (6, 2)]
    left = decontaminate.without_items(more, bench)
    assert left.columns == more.columns and sorted(r.doc_id for r in left.collect()) == [2, 4, 5]
    assert decontaminate.contamination(empty(texts), bench).count() == 0 and decontaminate.contamination(texts, empty(bench)).count() == 0


def test_toxicity(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in toxicity.score_texts(docs, labels).collect())
    assert toxicity.score_texts(docs, empty(labels)).count() == docs.count() and toxicity.score_texts(empty(docs), labels).count() == 0
    net = toxicity.Network(kind=np.float64)
    rng = np.random.default_rng(0)
    x, at = rng.normal(size=(9, toxicity.INPUTS)), rng.integers(9, size=(7, 5))
    real = (np.arange(7)[:, None] < np.array([7, 7, 3, 5, 0])).astype(float)
    inside, y = real * (np.arange(7)[:, None] > 0), np.array([0, 1, 1, 0, 1.0])
    _, g = net.gradients(x, at, real, inside, y)
    for k, v in (net.p | {"x": x}).items():
        for _ in range(4):
            place = tuple(rng.integers(s) for s in v.shape)
            held = v[place]
            losses = []
            for e in (1e-5, -1e-5):
                v[place] = held + e
                losses.append(net.gradients(x, at, real, inside, y)[0])
            v[place] = held
            assert abs((losses[0] - losses[1]) / 2e-5 - g[k][place]) < 1e-6
    table, words = toxicity.Embedding(), toxicity.Words([b"one two ones a", b"", b"two b"])
    table.word, table.gram = table.word.astype(float), table.gram.astype(float)
    which, d = np.arange(5), rng.normal(size=(5, toxicity.INPUTS))
    g_word, g_gram = table.gradients(words, which, d)
    for rows, at, g in ((table.word, words.word, g_word), (table.gram, words.grams_of(which)[0], g_gram)):
        for k in range(0, len(at), 3):
            held = rows[at[k], 1]
            sums = []
            for e in (1e-6, -1e-6):
                rows[at[k], 1] = held + e
                sums.append((table.inputs(words, which) * d).sum())
            rows[at[k], 1] = held
            assert abs((sums[0] - sums[1]) / 2e-6 - g[at == at[k], 1].sum()) < 1e-4


def test_toxicity_scores_every_window(monkeypatch):
    """Windows' logits are those of pooling each window's states alone; blocks change next to nothing; a text's neighbours nothing."""
    net, rng = toxicity.Network(), np.random.default_rng(1)
    counts = np.array([100, 0, 5, 32, 33, 700])
    x, at = rng.normal(size=(50, toxicity.INPUTS)).astype(np.float32), rng.integers(50, size=counts.sum())
    logit, starts, owner = toxicity.window_logits(net, x, at, counts)
    assert np.bincount(owner).tolist() == [69, 1, 1, 1, 2, 669]
    monkeypatch.setattr(toxicity, "BLOCK", 100_000)
    whole = toxicity.window_logits(net, x, at, counts)[0]
    assert np.abs(logit - whole).max() < 0.05
    ends = np.cumsum(counts)
    for k, (n, end) in enumerate(zip(counts.tolist(), ends.tolist(), strict=True)):
        if n:
            score, value = net.pooled(net.states(x, at[end - n : end, None], np.ones((n, 1), np.float32)))
            for i, s in enumerate(starts[owner == k] - (end - n)):
                e = np.exp(score[s : s + 32, 0])
                assert abs((e * value[s : s + 32, 0]).sum() / e.sum() + net.p["c"][0] - whole[owner == k][i]) < 1e-4
        assert np.abs(toxicity.window_logits(net, x, at[end - n : end], np.array([n]))[0] - whole[owner == k]).max() < 1e-4


def test_toxicity_scoring_holds_little():
    """What scoring a slice of text holds at once is bounded; outputs are the pooled states to the last bit."""
    rng = np.random.default_rng(3)
    net, table, letters = toxicity.Network(), toxicity.Embedding(), np.array(list("abcdefghijklmnop"))
    words = ["".join(w) for w in letters[rng.integers(16, size=(60_000, 5))]]
    texts = [" ".join(words[i] for i in rng.integers(len(words), size=700)).encode() for _ in range(500)]
    tracemalloc.start()
    toxicity.scores_of(texts, net, table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, texts)) > 2_000_000 and peak < 70e6
    x, at, real = rng.normal(size=(50, toxicity.INPUTS)).astype(np.float32), rng.integers(50, size=(40, 6)), (rng.random((40, 6)) < 0.9).astype(np.float32)
    assert all((a == b).all() for a, b in zip(net.outputs(x, at, real), net.pooled(net.states(x, at, real)), strict=True))


def test_toxicity_learns(spark):
    """Held-out documents with a few bad words among many, which other documents taught."""
    rng = np.random.default_rng(4)
    bad = ["grumpf", "blixed", "norkle"]
    rows = []
    for i in range(400):
        w = [f"w{k}" for k in rng.zipf(1.3, rng.integers(20, 400)) % 5000]
        if i % 4 == 0:
            for k in rng.integers(len(w), size=3):
                w[k] = bad[rng.integers(3)]
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame([*rows, (None, "grumpf x", )], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(4, 0), (4, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    got = [r for r in toxicity.score_texts(docs, labels).collect() if r.doc_id is not None]
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in got if r.held_out]) > 0.95
    left = {r.doc_id for r in toxicity.without_toxic(docs, labels).collect()}
    assert left - {None} == {r.doc_id for r in got if not r.predicted}


def brute_best_fit(pieces, capacity, per_source):
    """Each piece into the bin of least room that has enough and no conflict, the oldest of equals; else a new one."""
    bins, out = [], []
    for n, source, cluster in pieces:
        can = [k for k, b in enumerate(bins) if capacity - sum(x[0] for x in b) >= n and (cluster is None or all(x[2] != cluster for x in b)) and (source is None or sum(x[1] == source for x in b) < per_source)]
        k = min(can, key=lambda k: (capacity - sum(x[0] for x in bins[k]), k), default=len(bins))
        if k == len(bins):
            bins.append([])
        out.append((k, sum(x[0] for x in bins[k])))
        bins[k].append((n, source, cluster))
    return out


def test_best_fit_is_the_tightest_compatible_bin():
    rng = np.random.default_rng(3)
    for _ in range(60):
        pieces = [(int(n), None if s == 4 else f"s{s}", None if c == 9 else int(c)) for n, s, c in zip(sorted(rng.integers(1, 100, 80), reverse=True), rng.integers(0, 5, 80), rng.integers(0, 10, 80), strict=True)]
        got = packing.best_fit(*map(list, zip(*pieces, strict=True)), 100, 2)
        assert list(zip(*got, strict=True)) == brute_best_fit(pieces, 100, 2)


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    got = packing.pack(docs, BPE, capacity=256, per_source=2, shard_pieces=64).toPandas()
    assert got.groupby(["shard", "bin"])["length"].sum().max() <= 256 and (got["offset"] + got["length"] <= 256).all()
    t, want = Tokenizer.from_file(BPE), Counter()
    for i, x in rows:
        want[i] += len(t.encode(x, add_special_tokens=False).ids) + 1
    assert got.fillna({"doc_id": -1}).groupby("doc_id")["length"].sum().to_dict() == {(-1 if k is None else k): v for k, v in want.items()}
    assert packing.pack(empty(docs), BPE).count() == 0


def test_packing_keeps_conflicts_apart(spark):
    """Copies and pieces of one document are in bins of their own, sources are bounded, and equal rows without an id go to many shards."""
    texts = [(k, f"Copy  of text {k // 3}" if k % 2 else f"copy of TEXT {k // 3}", f"s{k % 3}") for k in range(300)] + [(1000, "long " * 900, "s1")] + [(None, "no id", None)] * 400
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").selectExpr("*", "1 as salt", "2 as cluster", "3 as n")
    got = packing.pack(docs, BPE, capacity=300, per_source=4, shard_pieces=50).toPandas()
    source, group = {k: s for k, _, s in texts}, {k: x.lower().split()[-1] for k, x, _ in texts if k is not None and k < 1000}
    assert len(got) == 700 + 4 and got[got["doc_id"].isna()]["shard"].nunique() > 5
    for _, own in got.groupby(["shard", "bin"]):
        ids = own["doc_id"].dropna().astype(int).tolist()
        assert max(Counter(source[i] for i in ids).values(), default=0) <= 4 and len(ids) == len({group.get(i, i) for i in ids}) and own["doc_id"].isna().sum() <= 1


def test_grammar_ends_when_no_pair_is_frequent():
    rng = np.random.default_rng(1)
    passage = rng.integers(3, 90_000, 500).astype(np.uint32)
    ids = np.concatenate([np.r_[passage, rng.integers(3, 90_000, 20).astype(np.uint32), np.uint32(2)] for _ in range(200)])
    for vocab in (90_000, 1 << 20):
        symbols, rules = grammar.compress(ids, vocab, 2)
        assert len(symbols) < 200 * 40 and len(rules) > 400
        assert max(n for (a, _), n in Counter(zip(symbols[:-1].tolist(), symbols[1:].tolist(), strict=True)).items() if a != 2) < 5
        block = grammar.Block(grammar.pack_block(list(range(200)), np.full(200, 521), ids, vocab, 2))
        assert (block.expand(block.symbols) == ids).all() and (block.ids(521 * 7 + 5, 521 * 9) == ids[521 * 7 + 5 : 521 * 9]).all()


def test_quality(spark, docs, rows):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.risk_controlled(docs, labels).collect()}
    want = set()
    for i, text in rows:
        w = [x.decode() for x in text.encode().split()]
        grams = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        hit = {k + j for k in range(len(w) - 7) if grams[tuple(w[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        want.add((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)))
    assert got == want
    assert abs(quality.binomial_tail(1, 10, 0.1) - (0.9**10 + 10 * 0.1 * 0.9**9)) < 1e-12
    assert quality.risk_controlled(empty(docs), labels).count() == 0 and quality.risk_controlled(docs, empty(labels)).count() == docs.count()


def test_quality_against_brute_force(spark):
    """Verdicts of all rows, with cutoffs found by trying every one with exact fractions."""
    from fractions import Fraction

    rng = np.random.default_rng(8)
    texts = []
    for i in range(700):
        w = [f"w{k}" + "x" * int(rng.integers(0, 6)) for k in rng.integers(0, 400, int(rng.choice([30, 60, 150, 500])))]
        for k in rng.integers(0, len(w), int(rng.choice([0, 0, 1, 4, 20]))):
            w[k] = "#$%"
        texts.append("\n".join(" ".join(w[a : a + 10]) for a in range(0, len(w), 10)) + ("\nsame line here" * int(rng.choice([0, 0, 0, 3]))))
    docs = spark.createDataFrame([*enumerate(texts), (None, "x " * 30), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(700)] + [(1, 0), (None, 1), (9999, 1), (2, None)], "doc_id long, quality int")
    risk, delta = 0.05, 0.05
    rows = [r.asDict() for r in quality.features(docs).collect()]
    base = lambda r: r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
    stat = {"symbols": lambda r: 1000 * r["n_symbols"] / r["n_words"], "duplicate_lines": lambda r: 1000 * r["n_dup_lines"] / max(r["n_lines"], 1), "repeated_words": lambda r: 1000 * r["n_repeat_words"] / r["n_words"], "long_words": lambda r: 1000 * r["word_chars"] / r["n_words"], "short_words": lambda r: -1000 * r["word_chars"] / r["n_words"]}
    level = lambda r: sum(r["n_words"] >= n for n in quality.STRATA)
    good = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 700 and r["doc_id"] % 5 > 0 and r["doc_id"] != 1 and not base(r)]
    groups = quality.stratum_groups({s: sum(level(r) == s for r in good) for s in range(4)}, risk, delta)
    assert len(groups) > 1
    cut = {}
    for group in groups:
        own = [r for r in good if level(r) in group]
        p, n = Fraction(1, 20), len(own)
        for rule, (_, ladder) in quality.RULES.items():
            for c in ladder:
                k = sum(stat[rule](r) > c for r in own)
                if sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) > Fraction(1, 20) / len(groups) / 5:
                    break
                cut |= {(s, rule): c for s in group}
    want = Counter((r["doc_id"], r["n_words"], not base(r) and not any(s == level(r) and stat[rule](r) > c for (s, rule), c in cut.items())) for r in rows)
    assert len(cut) > 5 and Counter((r.doc_id, r.n_words, r.kept) for r in quality.risk_controlled(docs, labels, risk, delta).collect()) == want
    assert 0 < sum(n for (_, _, kept), n in want.items() if not kept) < 600


def test_quality_rejects_planted_junk(spark):
    """Strata that hold too few good documents alone share their cutoffs."""
    texts = [" ".join(f"word{i}x{k}" for k in range(30 if i % 2 else 150)) for i in range(2400)]
    junk = [" ".join(f"#*$%& |<>{i} ab{k}" for k in range(15)) for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts + junk)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 2400)) for i in range(2420)], "doc_id long, quality int")
    got = quality.risk_controlled(docs, labels).collect()
    assert not any(r.base_failed for r in got) and {r.doc_id for r in got if not r.kept} == set(range(2400, 2420))
    assert quality.stratum_groups({0: 371, 1: 1835, 2: 992, 3: 104}, 0.002, 0.05) == [(0, 1, 2, 3)]
    assert quality.stratum_groups({0: 3000, 1: 2000, 2: 1200, 3: 10}, 0.002, 0.05) == [(0,), (1, 2, 3)]
    assert not quality.chosen_cutoffs({(0, r): [0] * len(c) for r, (_, c) in quality.RULES.items()}, {0: 2200, 1: 0, 2: 0, 3: 0}, 0.002, 0.05)


def test_mixtures(spark):
    """Shares of a text that is half and half in two languages of other letters."""
    one, two = ("".join(chr(a + k) for k in range(10)) for a in (97, 107))
    rng = np.random.default_rng(3)
    text = lambda own, n: " ".join("".join(rng.choice(list(own), 5)) for _ in range(n))
    rows = [(i, text((one, two)[i % 2], 200), ("aa", "bb")[i % 2]) for i in range(40)]
    names, table = language_mix.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = (text(one, 100) + " " + text(two, 100)).encode()
    folds, starts = language_mix.folded([mixed, text(one, 50).encode(), b""])
    like, owner = language_mix.word_likelihoods(folds, starts, table)
    share = language_mix.proportions(like, owner, 3)
    assert names == ["aa", "bb"] and abs(share[0] - 0.5).max() < 0.05 and share[1].tolist() == [1.0, 0.0] and share[2].sum() == 0


@pytest.mark.parametrize("name", ["op1_warc_archive", "op4_jaccard_signature_tree", "op7_benchmark_containment"])
def test_query_equals_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(want.fetchall()) if name != "op1_warc_archive" else sorted(str(tuple(r[c] for c in cols)) for r in got.collect()) == sorted(map(str, want.fetchall()))


def brute_components(sets, percent):
    up = {i: i for i in sets}
    for _ in range(len(sets)):
        now = {i: min([up[i], *(up[j] for j in sets if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]))]) for i in sets}
        if now == up:
            return up
        up = now
    return up


def test_pipeline(spark):
    """Every stage's result from the one before it: models by their operators' scores, all else by brute force."""
    import re

    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(jaccard_tree.materialize(stage(spark, frames[-1], SF), f"test-{name}"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "decontamination", "packing"] and all(f.columns == columns for f in frames[:5])
    rows = [{r.doc_id: r.text or "" for r in f.collect()} for f in frames[:5]]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert set(rows[1]) == {r.doc_id for r in toxicity.score_texts(docs, labels).collect() if not r.predicted}
    assert set(rows[2]) == {r.doc_id for r in language_mix.identify(frames[1]).collect() if r.lang_pred != "und" and r.score >= 0.4}
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []) for i, t in rows[2].items() for w in [words(t)]}
    found = brute_components(sets, 80)
    assert set(rows[3]) == {i for i, c in found.items() if i == c} and len(rows[3]) < len(rows[2])
    own = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    five = lambda t: {tuple(w[k : k + 5]) for w in [own(t)] for k in range(len(w) - 4)}
    items = [five(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(rows[4]) == {i for i, t in rows[3].items() if not any(100 * len(x & five(t)) >= 80 * len(x) for x in items)} and len(rows[4]) < len(rows[3])
    t, source = Tokenizer.from_file(BPE), {r.doc_id: r.source for r in frames[4].collect()}
    pieces = frames[5].toPandas()
    assert pieces.groupby("doc_id")["length"].sum().to_dict() == {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in rows[4].items()}
    copies = {i: " ".join(x.lower().split()) for i, x in rows[4].items()}
    for _, shard in pieces.groupby("shard"):
        ordered = shard.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        want = brute_best_fit([(n, source[i], copies[i]) for n, i in zip(ordered["length"], ordered["doc_id"], strict=True)], packing.CAPACITY, packing.PER_SOURCE)
        assert list(zip(ordered["bin"], ordered["offset"], strict=True)) == want
    assert corpus_pipeline.run(spark, SF).count() == len(pieces)
