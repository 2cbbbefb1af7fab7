"""Toxicity: a bidirectional GRU with attention pooling over character and word inputs, trained in numpy.

A word's inputs are its own embedding, and the mean and the maximum of the embeddings of its character n-grams (four and
five bytes).  Embeddings start as small random numbers, their first coordinate as shrunken log-odds that one half of the
sample's labels gives; network and embeddings are then trained together on the other half, by backpropagation through
time.  A forward and a backward GRU run over the text in blocks of 256 words, each of which begins 32 words before its
first word (the backward one as many after its last), so that time and memory are bounded however long the text is.
Attention pools the states of each window of 32 words to a logit; the windows at all words of the whole text are scored
(stride 1), as sums over a window are slid along the text.  The highest is the document's score.

The network is fitted on a bounded sample of labelled rows (`per_class` toxic ones and twice as many others, by hash of the
id, texts of at most `sample_bytes`).  A toxic document's label is known, not where the toxic words are: training begins
with its window of largest inputs, then takes the one that the network scores highest.

Defined results: a null or empty text scores as a window without words; without labels of both classes all scores are 0;
rows without a doc_id are scored, not learned from; of several labels for an id the highest counts, of several texts the
first in order; repeated rows and ties are scored each; extra columns, whatever their names, are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, crc_mod, discard, materialize, mix, prepare, slices, span_hashes, word_spans

WINDOW, HIDDEN, SPAN = 32, 16, 4
#: A word's embedding, the mean and the maximum of its n-grams' embeddings, and a constant.
INPUTS = 3 * SPAN + 1
BUCKETS = 1 << 18
BLOCK, CONTEXT = 256, 32
#: Distinct words whose n-grams are made or looked up at once.
SOME = 1 << 13
PER_CLASS, SAMPLE_BYTES = 800, 20_000
#: Bound of the attention's exponents.
STEEP = 20
_T = [(mix(np.arange(256, dtype=np.uint64) + np.uint64(7 + 999 * k)) >> np.uint64(30)).astype(np.uint32) for k in range(5)]


class Words:
    """The distinct words of some texts: where each word of the texts is among them, and their buckets."""

    def __init__(self, texts: list[bytes]):
        raw, starts, ends, self.counts = word_spans(texts)
        found, first, self.at = np.unique(span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        self.word = (found & np.uint64(BUCKETS - 1)).astype(np.int64)
        starts, sizes = starts[first], ends[first] - starts[first]
        # the words one after the other, four blanks before each and one behind it
        room = sizes + 5
        begin = np.cumsum(room) - room
        text = np.full(int(room.sum()) + 4, 32, np.uint8)
        step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        text[np.repeat(begin + 4, sizes) + step] = np.frombuffer(raw, np.uint8)[np.repeat(starts, sizes) + step]
        # n-grams that end at a byte of the word or at the blank behind it
        n = sizes + 1
        self.gram_counts = 2 * n
        self.gram_at = np.cumsum(self.gram_counts) - self.gram_counts
        self.grams = np.empty(2 * int(n.sum()), np.int32)
        for a in range(0, len(n), SOME):
            own, at = slice(a, a + SOME), int(self.gram_at[a])
            grams = self._grams(text, begin[own] + 4, n[own])
            self.grams[at : at + len(grams)] = grams

    @staticmethod
    def _grams(text: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
        stop = np.repeat(begin, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        with np.errstate(over="ignore"):
            four = _T[1][text[stop - 3]] + _T[2][text[stop - 2]] + _T[3][text[stop - 1]] + _T[4][text[stop]]
            five = four + _T[0][text[stop - 4]] * np.uint32(3)
            fold = lambda h: (((h ^ (h >> np.uint32(16))) * np.uint32(0x2C1B3C6D)) >> np.uint32(14)).astype(np.int32)
            return np.stack([fold(four), fold(five)], 1).ravel()

    def grams_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The n-grams of some distinct words one after the other, where each word's begin, and how many they are."""
        n = self.gram_counts[words]
        begin = np.cumsum(n) - n
        return self.grams[np.repeat(self.gram_at[words] - begin, n) + np.arange(int(n.sum()))], begin, n


class Embedding:
    """Tables of words and of character n-grams."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.word, self.gram = (rng.normal(0, 0.05, (BUCKETS, SPAN)).astype(np.float32) for _ in range(2))
        self.paces: list[np.ndarray] = []

    def start(self, texts: list[bytes], toxic: np.ndarray) -> None:
        """Sets the first coordinates to log-odds, each as a lower confidence bound, so that rare coincidences weigh nothing."""
        total = np.array([(toxic == 0).sum(), (toxic == 1).sum()])
        seen = np.zeros((2, 2, BUCKETS))
        for text, label in zip(texts, toxic.tolist(), strict=True):
            words = Words([text])
            seen[0, label, np.unique(words.word)] += 1
            seen[1, label, np.unique(words.grams)] += 1
        for table, (clean, bad) in zip((self.word, self.gram), seen, strict=True):
            a, b = bad + 0.5, clean + 0.5
            log = np.log(a / (total[1] + 1)) - np.log(b / (total[0] + 1))
            table[:, 0] = 0.5 * np.sign(log) * np.maximum(np.abs(log) - 1.5 * np.sqrt(1 / a + 1 / b), 0)

    def inputs(self, words: Words, which: np.ndarray) -> np.ndarray:
        """The inputs of some of the distinct words."""
        out = np.ones((len(which), INPUTS), self.word.dtype)
        for a in range(0, len(which), SOME):
            own, to = which[a : a + SOME], out[a : a + SOME]
            grams, begin, n = words.grams_of(own)
            value = self.gram[grams]
            to[:, :SPAN] = self.word[words.word[own]]
            to[:, SPAN : 2 * SPAN] = np.add.reduceat(value, begin) / n[:, None]
            to[:, 2 * SPAN : 3 * SPAN] = np.maximum.reduceat(value, begin)
        return out

    def gradients(self, words: Words, which: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the word rows and of the n-gram rows (as grams_of gives them), of those of the inputs."""
        grams, begin, n = words.grams_of(which)
        value = self.gram[grams]
        owner = np.repeat(np.arange(len(which)), n)
        d_gram = (d[:, SPAN : 2 * SPAN] / n[:, None])[owner]
        top = value == np.maximum.reduceat(value, begin)[owner]
        d_gram += np.where(top, d[:, 2 * SPAN : 3 * SPAN][owner], 0) / np.maximum(np.add.reduceat(top, begin, dtype=np.int64), 1)[owner]
        return d[:, :SPAN], d_gram

    def learn(self, words: Words, which: np.ndarray, d: np.ndarray, rate: float) -> None:
        """A step of Adagrad, of the rows that the words touch."""
        if not self.paces:
            self.paces = [np.full(BUCKETS, 1e-4), np.full(BUCKETS, 1e-4)]
        for table, pace, at, g in zip((self.word, self.gram), self.paces, (words.word[which], words.grams_of(which)[0]), self.gradients(words, which, d), strict=True):
            rows, own = np.unique(at, return_inverse=True)
            total = np.zeros((len(rows), SPAN))
            np.add.at(total, own, g)
            pace[rows] += (total * total).mean(axis=1)
            table[rows] -= (rate * total / np.sqrt(pace[rows])[:, None]).astype(table.dtype)


def window_starts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where all windows begin, in the row of all texts' words, and whose they are: at every word but the last ones, a short text has one."""
    windows = np.maximum(1, counts - WINDOW + 1)
    owner = np.repeat(np.arange(len(counts)), windows)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    first = np.cumsum(counts) - counts
    return first[owner] + number, owner


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters W (2 x inputs x 3H), U (2 x H x 3H), b (2 x 3H), attention v (2H), output w (2H) and c."""

    def __init__(self, seed: int = 7, kind: type = np.float32):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {"W": rng.normal(0, 0.5, (2, INPUTS, 3 * h)), "U": rng.normal(0, 0.3, (2, h, 3 * h)), "b": np.zeros((2, 3 * h)), "v": rng.normal(0, 0.3, 2 * h), "w": rng.normal(0, 0.3, 2 * h), "c": np.zeros(1)}
        self.p = {k: v.astype(kind) for k, v in self.p.items()}

    def steps(self, x: np.ndarray, at: np.ndarray, real: np.ndarray, keep: list | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
        """Direction, time and state (sequence x H), step by step.  x: inputs of distinct words, at (time x sequence): which stands where, real: whether one does."""
        p, h = self.p, HIDDEN
        steps, n = at.shape
        for k in range(2):
            gates = x @ p["W"][k]
            gates += p["b"][k]
            state, u = np.zeros((n, h), x.dtype), p["U"][k]
            for t in range(steps) if k == 0 else range(steps - 1, -1, -1):
                gx, gh = gates[at[t]], state @ u
                zr = sigmoid(gx[:, : 2 * h] + gh[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(gx[:, 2 * h :] + r * gh[:, 2 * h :])
                if keep is not None:
                    keep.append((k, t, state, z, r, new, gh[:, 2 * h :]))
                state = (new + z * (state - new)) * real[t][:, None]
                yield k, t, state

    def states(self, x: np.ndarray, at: np.ndarray, real: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Both directions' states (2 x time x sequence x H)."""
        out = np.empty((2, *at.shape, HIDDEN), x.dtype)
        for k, t, state in self.steps(x, at, real, keep):
            out[k, t] = state
        return out

    def pooled(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What pooling takes of the states: attention's exponent and the output, of each place."""
        p, h = self.p, HIDDEN
        score = states[0] @ p["v"][:h] + states[1] @ p["v"][h:]
        return np.clip(score, -STEEP, STEEP), states[0] @ p["w"][:h] + states[1] @ p["w"][h:]

    def outputs(self, x: np.ndarray, at: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """pooled(states(x, at, real)), without keeping the states: they are 16 times what is taken of them."""
        p, h = self.p, HIDDEN
        score, value = np.zeros((2, *at.shape), x.dtype)
        for k, t, state in self.steps(x, at, real):
            score[t] += state @ p["v"][k * h : k * h + h]
            value[t] += state @ p["w"][k * h : k * h + h]
        return np.clip(score, -STEEP, STEEP), value

    def gradients(self, x: np.ndarray, at: np.ndarray, real: np.ndarray, inside: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of one window for each sequence, of the places `inside`, and its gradients; those of x too, as "x"."""
        p, h, kept = self.p, HIDDEN, []
        states = self.states(x, at, real, kept)
        score, value = self.pooled(states)
        weight = np.exp(score) * inside
        total = weight.sum(axis=0)
        share = weight / np.where(total > 0, total, 1)
        logit = (share * value).sum(axis=0) + p["c"]
        loss = float(np.mean(np.logaddexp(0, logit) - label * logit))
        d = ((sigmoid(logit) - label) / len(label)).astype(x.dtype)
        g = {k: np.zeros_like(v) for k, v in p.items()} | {"x": np.zeros_like(x)}
        g["c"] = np.array([d.sum()], x.dtype)
        d_value = share * d
        d_score = share * (value - (share * value).sum(axis=0)) * d * (np.abs(score) < STEEP)
        for k in range(2):
            part = slice(k * h, k * h + h)
            g["v"][part] = np.einsum("tn,tnh->h", d_score, states[k])
            g["w"][part] = np.einsum("tn,tnh->h", d_value, states[k])
        carry = None
        for k, t, before, z, r, new, uh in reversed(kept):
            if t == (at.shape[0] - 1 if k == 0 else 0):
                carry, d_gates = np.zeros_like(before), np.zeros((len(x), 3 * h), x.dtype)
            part = slice(k * h, k * h + h)
            dh = (d_score[t][:, None] * p["v"][part] + d_value[t][:, None] * p["w"][part] + carry) * real[t][:, None]
            d_new = dh * (1 - z) * (1 - new * new)
            dz, dr = dh * (before - new) * z * (1 - z), d_new * uh * r * (1 - r)
            gh = np.concatenate([dz, dr, d_new * r], axis=1)
            np.add.at(d_gates, at[t], np.concatenate([dz, dr, d_new], axis=1))
            g["U"][k] += before.T @ gh
            carry = dh * z + gh @ p["U"][k].T
            if t == (0 if k == 0 else at.shape[0] - 1):
                g["W"][k], g["b"][k] = x.T @ d_gates, d_gates.sum(axis=0)
                g["x"] += d_gates @ p["W"][k].T
        return loss, g


def spread(starts: np.ndarray, stops: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of words from starts to stops as (time x sequence), and which places hold words."""
    steps = np.arange(max(1, int((stops - starts).max(initial=1))))[:, None]
    real = steps < (stops - starts)[None, :]
    place = np.where(real, starts[None, :] + steps, 0)
    return (at[place] if len(at) else np.zeros(place.shape, np.int64)), real


def window_logits(net: Network, x: np.ndarray, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits of all windows, where they begin and whose they are.  x: inputs of distinct words, at: which each word is."""
    first = np.cumsum(counts) - counts
    blocks = -(-counts // BLOCK)
    text = np.repeat(np.arange(len(counts)), blocks)
    number = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = first[text] + number * BLOCK
    end = np.minimum(begin + BLOCK, first[text] + counts[text])
    start, stop = np.maximum(begin - CONTEXT, first[text]), np.minimum(end + CONTEXT, first[text] + counts[text])
    exponent, value = np.empty(len(at), x.dtype), np.empty(len(at), x.dtype)
    order = np.argsort(stop - start, kind="stable")
    sizes = (stop - start)[order]
    cut = 0
    while cut < len(order):  # sequences of much the same length go together
        most = max(24, int(sizes[cut] * 1.25))
        to = min(int(np.searchsorted(sizes, most, "right")), cut + 2048)
        own = order[cut:to]
        places, real = spread(start[own], stop[own], at)
        score, out = net.outputs(x, places, real.astype(x.dtype))
        step = np.arange(places.shape[0])[:, None] + start[own][None, :]
        inside = (step >= begin[own]) & (step < end[own])
        exponent[step[inside]], value[step[inside]] = score[inside], out[inside]
        cut = to
    # a row of words in which each text has a window's places at least
    places = np.maximum(counts, WINDOW)
    shift = np.cumsum(places - counts) - (places - counts)
    put = np.arange(len(at)) + np.repeat(shift, counts)
    weight, product = np.zeros((2, int(places.sum()) + WINDOW), x.dtype)
    weight[put] = np.exp(exponent)
    product[put] = weight[put] * value
    for k in (1, 2, 4, 8, 16):  # sums of 2, 4, ..., 32 places from each on
        weight, product = weight[: len(weight) - k] + weight[k:], product[: len(product) - k] + product[k:]
    starts, owner = window_starts(counts)
    here = starts + shift[owner]
    total = weight[here]
    return np.where(total > 0, product[here] / np.where(total > 0, total, 1), 0) + net.p["c"], starts, owner


def train(net: Network, table: Embedding, words: Words, starts: np.ndarray, owner: np.ndarray, label: np.ndarray, epochs: int, rate: float = 0.02, batch: int = 128, seed: int = 3) -> None:
    """Adam for the network, Adagrad for the embeddings, over shuffled batches of windows, each with some words of context."""
    rng, ends = np.random.default_rng(seed), np.cumsum(words.counts)
    m, s, step = {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(starts))
        for a in range(0, len(order), batch):
            own = order[a : a + batch]
            low, high = ends[owner[own]] - words.counts[owner[own]], ends[owner[own]]
            begin, end = np.maximum(starts[own] - 8, low), np.minimum(starts[own] + WINDOW + 8, high)
            at, real = spread(begin, end, words.at)
            place = np.arange(len(at))[:, None] + begin[None, :]
            inside = real & (place >= starts[own]) & (place < starts[own] + WINDOW)
            which, at = np.unique(at, return_inverse=True)
            x = table.inputs(words, which) if len(words.word) else np.ones((1, INPUTS), np.float32)
            _, g = net.gradients(x, at.reshape(real.shape), real.astype(x.dtype), inside.astype(x.dtype), label[own].astype(x.dtype))
            step += 1
            if len(words.word):
                table.learn(words, which, g.pop("x"), 0.05)
            for k in net.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] * g[k]
                net.p[k] = (net.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-7)).astype(net.p[k].dtype)


def fit(texts: list[bytes], toxic: np.ndarray, rounds: int = 2, epochs: int = 5) -> tuple[Network, Embedding]:
    """Embeddings start from every other document of each class, all training is on the rest (on all, where classes are too small)."""
    net, table = Network(), Embedding()
    half = np.zeros(len(texts), bool)
    for c in (0, 1):
        half[np.flatnonzero(toxic == c)[::2]] = True
    parts = (half, ~half) if min((toxic[~half] == c).sum() for c in (0, 1)) >= 20 else (half | True, half | True)
    table.start([t for t, use in zip(texts, parts[0], strict=True) if use], toxic[parts[0]])
    texts, toxic = [t for t, use in zip(texts, parts[1], strict=True) if use], toxic[parts[1]]
    words = Words(texts)
    every = np.arange(len(words.word))
    starts, owner = window_starts(words.counts)
    x = table.inputs(words, every)
    worth = np.maximum(x[:, 0], 0) + np.maximum(x[:, 2 * SPAN], 0)
    total = np.r_[0, np.cumsum(worth[words.at])] if len(x) else np.zeros(1)
    stop = np.minimum(starts + WINDOW, np.cumsum(words.counts)[owner])
    score = total[stop] - total[np.minimum(starts, stop)]
    rng = np.random.default_rng(11)
    for turn in range(rounds):
        # of each document its highest window, and of clean ones another
        order = np.lexsort((-score, owner))
        best = order[np.r_[True, owner[order][1:] != owner[order][:-1]]]
        clean = np.flatnonzero(toxic[owner] == 0)
        chosen = np.unique(np.r_[best, rng.choice(clean, min(len(clean), int((toxic == 0).sum())), replace=False)])
        label = toxic[owner[chosen]]
        again = chosen[label == 1]
        chosen = np.r_[chosen, np.repeat(again, max(0, (label == 0).sum() // max(len(again), 1) - 1))]
        train(net, table, words, starts[chosen], owner[chosen], toxic[owner[chosen]], epochs)
        if turn < rounds - 1:
            score = window_logits(net, table.inputs(words, every), words.at, words.counts)[0]
    table.paces = []
    return net, table


def scores_of(texts: list[bytes], net: Network, table: Embedding) -> np.ndarray:
    words = Words(texts)
    x = table.inputs(words, np.arange(len(words.word))) if len(words.word) else np.ones((1, INPUTS), np.float32)
    at, counts = words.at, words.counts
    del words  # the rest isn't needed any more
    logit, _, owner = window_logits(net, x, at, counts)
    return sigmoid(np.maximum.reduceat(logit, np.searchsorted(owner, np.arange(len(texts)))).astype(np.float64))


def _scorer(model: Broadcast, held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            texts = as_bytes(batch.column("text"))
            score = np.zeros(len(texts)) if model.value is None else scores_of(texts, *model.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.compute.equal(batch.column("part"), held), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def sample(rows: DataFrame, labels: DataFrame, held: int, modulus: int, per_class: int, sample_bytes: int) -> tuple[list[bytes], np.ndarray]:
    """At most per_class toxic texts and twice as many others, of at most sample_bytes each.  rows: doc_id and text."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    known = known.where(crc_mod(F.col("doc_id"), modulus) != held)
    short = rows.where((F.octet_length("text") <= sample_bytes) & F.col("doc_id").isNotNull())
    there = materialize(short.select("doc_id").join(known, "doc_id").distinct(), "toxicity-labelled")
    order = F.xxhash64("doc_id")
    chosen = there.where("toxic = 1").orderBy(order).limit(per_class).unionByName(there.where("toxic <> 1").orderBy(order).limit(2 * per_class))
    chosen = materialize(chosen, "toxicity-sample")
    got = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).toPandas()
    discard(there, chosen)
    got = got.sort_values("doc_id", kind="stable")
    return [t.encode("utf-8", "surrogatepass") for t in got["text"]], (got["toxic"].to_numpy() == 1).astype(np.int64)


def trained(rows: DataFrame, labels: DataFrame, modulus: int, held: int, per_class: int, sample_bytes: int) -> Broadcast:
    """Network and embeddings (8 MB), or nothing, given to workers."""
    texts, toxic = sample(rows, labels, held, modulus, per_class, sample_bytes)
    return rows.sparkSession.sparkContext.broadcast(fit(texts, toxic) if len(set(toxic.tolist())) == 2 else None)


def without_toxic(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, per_class: int = PER_CLASS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """The rows of docs, whole, that aren't predicted to be toxic.

    Defined results are those of `score_texts`: a null or empty text stays unless empty windows are toxic to the network;
    all rows stay where there are no labels of both classes; repeated rows stay or go together; extra columns are kept.
    """
    prepare(docs.sparkSession)
    model = trained(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")), labels, modulus, held, per_class, sample_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            yield batch if model.value is None else batch.filter(pa.array(scores_of(as_bytes(batch.column("text")), *model.value) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def score_texts(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, per_class: int = PER_CLASS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, held_out, score and predicted of each row; learns from labels of ids whose crc32 mod `modulus` is not `held`."""
    prepare(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), crc_mod(docs["doc_id"], modulus).cast("int").alias("part"))
    model = trained(rows, labels, modulus, held, per_class, sample_bytes)
    return rows.mapInArrow(_scorer(model, held), "doc_id long, held_out boolean, score double, predicted int")
