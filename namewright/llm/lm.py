"""Language-model scoring with a log-frequency Bloom filter.

Counts of pairs and triples of words in the training texts are quantised to levels (every count up to EXACT is a level,
then STEPS of them each time counts double); a Bloom filter holds each n-gram with every level up to its own, so that a
count is read by probing levels until one is missing: 1, 2, 4, ... and then between the last two.  With q for a quantised
count (never above the true one), c for a true one and m for the largest count that the context's level stands for,

    p1(w)     = (c(w) + 1) / (N + V + 1)
    p2(w | v) = (q(v w) + MU2 * p1(w)) / (c(v) + MU2)
    p3(w | u v) = (min(q(u v w), m(u v)) + MU3 * p2(w | v)) / (m(u v) + MU3)

so that a context's probabilities never add up to more than 1, but for the filter's false hits, and to 1 where counts are
up to EXACT: beyond, a share of at most 1 / STEPS of the counted mass is lost to rounding.  A text is its words and an end
token; its first word follows an end token and has p2, all others have p3.  Unknown words are one word.

The filter grows with the corpus, so it isn't given to workers whole: the n-grams of all texts travel to the segments of
the key space (`lookup`), where a segment's filter is built, probed for every n-gram that a text has, and dropped.  Word
counts are exact and looked up in the same way.  That is one way for every size; no table or key is in one place.

Defined results: a null text is an end token alone; a null doc_id is hashed as an empty text; rows, repeated ones and
ties too, are scored each; extra columns, whatever their names, are ignored; without training texts N and V are 0 and
every token has base probability 1; an empty table gives an empty result; a very long text is held whole by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lookup
from .common import as_bytes, crc_mod, hashed_words, materialize, mix, prepare

EXACT, STEPS = 64, 16
BITS_PER_KEY, PROBES = 10, 5
#: Weights of the lower order, of those tried the ones of highest likelihood of held-out texts (sf0.1: -3.63 a token, log10; p1 alone: -4.20).
MU2, MU3 = 5000.0, 20.0
#: Bytes of text for each segment: a text has some n-grams for each word.
SEGMENT_BYTES = 8 << 20
END = np.uint64(0x5851F42D4C957F2D)


def _values() -> np.ndarray:
    """The count that each level stands for; level 0 is none."""
    out = list(range(EXACT + 1))
    while out[-1] < 1 << 48:
        out.append(int(EXACT * 2 ** ((len(out) - EXACT) / STEPS)))
    return np.array(out, np.int64)


VALUES = _values()


def levels(counts: np.ndarray) -> np.ndarray:
    """The highest level that stands for no more than each count."""
    return np.searchsorted(VALUES, counts, "right") - 1


def most(level: np.ndarray) -> np.ndarray:
    """The largest count of a level."""
    return np.where(level > 0, VALUES[np.minimum(level + 1, len(VALUES) - 1)] - 1, 0)


def token_stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The token hashes of all texts in a row, an end token after each, and how many tokens each has."""
    words, counts = hashed_words(texts)
    return np.insert(words, np.cumsum(counts), END), counts + 1


def chained(context: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """A hash of each context followed by a token."""
    with np.errstate(over="ignore"):
        return mix(mix(context * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) + tokens)


def pairs_and_triples(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the pair that ends at each token, of the triple, and which tokens have one: all but each text's first."""
    pair = chained(np.r_[END, tokens[:-1]], tokens)
    triple = chained(np.r_[END, pair[:-1]], tokens)
    later = np.ones(len(tokens), bool)
    later[np.cumsum(counts) - counts] = False
    return pair, triple, later


def bit_places(keys: np.ndarray, level: np.ndarray | int, bits: int, probes: int = PROBES) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        h = mix(keys + np.uint64(level) * np.uint64(0xD1B54A32D192ED03) if np.isscalar(level) else keys + level.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        step = (h >> np.uint64(32)) | np.uint64(1)
        for i in range(probes):
            yield ((((h + np.uint64(i) * step) & np.uint64(0xFFFFFFFF)) * np.uint64(bits)) >> np.uint64(32)).astype(np.int64)


def build_filter(keys: np.ndarray, counts: np.ndarray, bits_per_key: int = BITS_PER_KEY, probes: int = PROBES) -> np.ndarray:
    """The bits (as booleans) of a filter that holds the keys with all levels up to their counts'."""
    level = levels(counts)
    bits = max(64, int(level.sum()) * bits_per_key)
    if bits >= 1 << 32:
        raise ValueError(f"a segment of {len(keys)} n-grams is too large for its filter; more segments are needed")
    flat = np.zeros(bits, bool)
    for k in range(1, int(level.max(initial=0)) + 1):
        keys, level = keys[level >= k], level[level >= k]
        for at in bit_places(keys, k, bits, probes):
            flat[at] = True
    return flat


def has(flat: np.ndarray, keys: np.ndarray, level: np.ndarray, probes: int = PROBES) -> np.ndarray:
    """Whether the filter has each key at its level."""
    here = np.arange(len(keys))
    for at in bit_places(keys, level, len(flat), probes):
        here = here[flat[at[here]]]
    out = np.zeros(len(keys), bool)
    out[here] = True
    return out


def probe(flat: np.ndarray, keys: np.ndarray, probes: int = PROBES) -> np.ndarray:
    """The level that the filter has for each key; 0: none."""
    low, high = np.zeros(len(keys), np.int64), np.ones(len(keys), np.int64)
    here = np.arange(len(keys))
    while len(here):  # doubled as long as there is a hit
        hit = has(flat, keys[here], high[here], probes)
        here = here[hit]
        low[here] = high[here]
        high[here] *= 2
        here = here[high[here] < len(VALUES)]
    here = np.flatnonzero(high - low > 1)
    while len(here):  # halved
        middle = (low[here] + high[here]) // 2
        hit = has(flat, keys[here], middle, probes)
        low[here] = np.where(hit, middle, low[here])
        high[here] = np.where(hit, high[here], middle)
        here = here[high[here] - low[here] > 1]
    return low


def _words(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.int64)


def _ngrams(bits_per_key: int, probes: int):
    def answer(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        known = counts > 0
        return probe(build_filter(keys[known], counts[known], bits_per_key, probes), keys, probes).astype(np.uint16)

    return answer


def _keys_of(held: int):
    """Words, and pairs and triples, of a piece's texts; only those of training texts count."""

    def keys(batch: pa.RecordBatch) -> list:
        tokens, counts = token_stream(as_bytes(batch.column("text")))
        teaches = np.repeat(batch.column("part").to_numpy(zero_copy_only=False) != held, counts).astype(np.int64)
        pair, triple, later = pairs_and_triples(tokens, counts)
        return [(mix(tokens), teaches), (np.r_[pair, triple[later]], np.r_[teaches, teaches[later]])]

    return keys


def log_scores(counts: np.ndarray, n: np.ndarray, pair: np.ndarray, triple: np.ndarray, total: int, distinct: int, weights: tuple[float, float] = (MU2, MU3)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Known tokens, base score and model score of each text.  n: the words' counts; pair, triple: levels at each token (first tokens have no triple)."""
    first = np.cumsum(counts) - counts
    p1 = (n + 1) / (total + distinct + 1)
    before = np.r_[0, n[:-1]]
    before[first] = n[np.cumsum(counts) - 1]  # an end token's own, which texts begin after
    p2 = (np.minimum(VALUES[pair], before) + weights[0] * p1) / (before + weights[0])
    context = most(np.r_[0, pair[:-1]])
    p3 = (np.minimum(VALUES[triple], context) + weights[1] * p2) / (context + weights[1])
    p3[first] = p2[first]
    per_text = lambda x: np.add.reduceat(x, first)
    return per_text((n > 0).astype(np.int64)), per_text(np.log10(p1)), per_text(np.log10(p3))


def _scorer(total: int, distinct: int, held: int, weights: tuple[float, float]):
    def run(answered: Iterator[tuple[pa.RecordBatch, list, list]]) -> Iterator[pa.RecordBatch]:
        for batch, (words, _), (n, level) in answered:
            counts = np.diff(np.r_[np.flatnonzero(np.r_[True, words[:-1] == mix(np.array([END]))[0]]), len(words)])
            pair, triple = level[: len(words)].astype(np.int64), np.zeros(len(words), np.int64)
            later = np.ones(len(words), bool)
            later[np.cumsum(counts) - counts] = False
            triple[later] = level[len(words) :]
            known, base, score = log_scores(counts, n, pair, triple, total, distinct, weights)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.compute.equal(batch.column("part"), held), pa.array(counts), pa.array(known), pa.array(np.full(len(counts), total, np.int64)), pa.array(base), pa.array(score)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


SCORE_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_corpus(docs: DataFrame, modulus: int = 7, held: int = 2, segment_bytes: int = SEGMENT_BYTES, bits_per_key: int = BITS_PER_KEY, probes: int = PROBES, weights: tuple[float, float] = (MU2, MU3)) -> DataFrame:
    """Learns from the rows whose crc32(doc_id as text) mod `modulus` is not `held`, and scores all rows.  weights: of the lower order, in tokens."""
    prepare(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), crc_mod(docs["doc_id"], modulus).cast("int").alias("part"))
    pieces = lookup.store(rows, "lm-texts")
    segments, keys = lookup.segments_of(pieces, segment_bytes), _keys_of(held)
    owned = materialize(lookup.asked(pieces, keys, [_words, _ngrams(bits_per_key, probes)], segments), "lm-levels")
    sums = owned.groupBy("segment").agg(F.first("total").alias("total"), F.first("kinds").alias("kinds")).agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    return lookup.used(pieces, owned, keys, [np.int64, np.uint16], segments, _scorer(int(sums[0]), int(sums[1]), held, weights), SCORE_DDL)
