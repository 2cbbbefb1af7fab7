"""Language identification by mixture inference.

A language is a distribution over hashed character n-grams (two and three bytes of lower-cased words, with word borders),
learned from all labelled texts.  A document's words come from a mixture of languages: expectation-maximisation finds the
proportions that make the words' n-gram likelihoods largest.  The set of languages is chosen by penalised likelihood:
languages join in the order of their share as long as log-likelihood minus PENALTY times the number of free proportions
times the log of the number of words grows (half of it would be the Bayesian criterion; words aren't independent).  The prediction is the language of largest share; the score is that share.

Defined results: a null text, or one without a letter, is `und` with score 0; so is any text when nothing was learned;
rows with a null lang teach nothing; ties go to the name first in order; repeated rows each get their result; extra
columns, whatever their names, are ignored; an empty table gives an empty result; a very long text is held whole by one
task; the driver and each worker hold 128 KB for each language that there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, crc_mod, discard, materialize, mix, prepare, slices

BUCKETS = 1 << 15
ROUNDS = 12
PENALTY = 2.0
#: Longest stretch of a word that votes as one.
PIECE = 24
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True


def _gram_table() -> list[np.ndarray]:
    """Random values for bytes at three places, to be added up to hashes of n-grams."""
    with np.errstate(over="ignore"):
        return [(mix(np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * k)) >> np.uint64(32)).astype(np.uint32) for k in range(3)]


_TABLES = _gram_table()
#: White space of any kind is one border; ASCII digits and punctuation say nothing of a language.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32
_FOLD[list(range(65, 91))] += 32


def folded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, borders around each, and where each starts."""
    raw = np.frombuffer(b" " + b"  ".join(texts) + b"  ", np.uint8)
    starts = np.r_[0, np.cumsum([len(x) + 2 for x in texts])]
    return _FOLD[raw], starts


def gram_buckets(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the two- and three-byte n-grams that start at each byte."""
    with np.errstate(over="ignore"):
        two = _TABLES[0][text[:-2]] + _TABLES[1][text[1:-1]]
        three = two + _TABLES[2][text[2:]]
        fold = lambda h: ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(17)
        return fold(two * np.uint32(3)), fold(three)


def _learner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, bucket, n): what the task has counted, once for each."""
    found: dict[str, np.ndarray] = {}
    for batch in slices(batches, "text", 2 << 20):
        langs, texts = batch.column("lang").to_pylist(), as_bytes(batch.column("text"))
        for lang in sorted(set(langs)):
            own, _ = folded([t for t, x in zip(texts, langs, strict=True) if x == lang])
            two, three = gram_buckets(own)
            inside = (own[:-2] != 32) | (own[1:-1] != 32)
            count = np.bincount(two[inside], minlength=BUCKETS) + np.bincount(three[inside], minlength=BUCKETS)
            found[lang] = found.get(lang, 0) + count
    for lang, count in found.items():
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(count[at].astype(np.int64))], names=["lang", "bucket", "n"])


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Names and log-probabilities (language x bucket) of all languages.  docs: text and lang.  The model goes to each worker, 128 KB a language."""
    counted = materialize(docs.where("lang is not null and text is not null").select("text", "lang").mapInArrow(_learner, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-grams")
    names = sorted(r[0] for r in counted.select("lang").distinct().collect())
    place, table = {name: k for k, name in enumerate(names)}, np.empty((len(names), BUCKETS), np.float32)
    for r in counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("e")).select("lang", "e.bucket", "e.n").toLocalIterator():  # buckets at most in a row
        row = np.full(BUCKETS, 0.5)
        row[r["bucket"]] += r["n"]
        table[place[r["lang"]]] = np.log(row / row.sum())
    discard(counted)
    return names, table


def slice_bytes(languages: int) -> int:
    """Texts that are worked on at once: each word has a likelihood for each language."""
    return (1 << 26) // max(64, languages)


def word_likelihoods(text: np.ndarray, starts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihoods of each word (or stretch of a long one) under each language, and whose text it is of."""
    two, three = gram_buckets(text)
    border = text == 32
    begin = np.flatnonzero(~border[1:] & border[:-1]) + 1
    end = np.flatnonzero(border[1:] & ~border[:-1]) + 1
    long = np.flatnonzero(end - begin > PIECE)
    if len(long):
        cuts = [np.arange(a, b, PIECE) for a, b in zip(begin[long].tolist(), end[long].tolist(), strict=True)]
        keep = np.ones(len(begin), bool)
        keep[long] = False
        begin = np.sort(np.concatenate([begin[keep], *cuts]))
        end = np.minimum(np.r_[begin[1:], len(text)], end[np.searchsorted(end, begin, "right")])
    out = np.empty((len(begin), len(table)), np.float32)
    for k, row in enumerate(table):
        # n-grams from the border before the word to its last byte
        total = np.r_[0.0, np.cumsum(row[two] + row[three], dtype=np.float64)]
        out[:, k] = total[np.minimum(end, len(two))] - total[begin - 1]
    return out, np.searchsorted(starts, begin, "right") - 1


def proportions(like: np.ndarray, owner: np.ndarray, texts: int, rounds: int = ROUNDS) -> np.ndarray:
    """Shares of the languages in each text (texts x languages); all 0 for a text without words."""
    words = np.bincount(owner, minlength=texts)
    k = like.shape[1]
    chance = np.exp(like - like.max(axis=1, keepdims=True)).astype(np.float32)
    base = np.bincount(owner, weights=like.max(axis=1), minlength=texts)

    def fit(allowed: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM for the words `which`, with the allowed languages of each text: shares and log-likelihood."""
        own, c = owner[which], chance[which]
        share = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.empty(0, np.int64)
        at = own[first]
        for step in range(rounds + 1):
            joint = c * share[own].astype(np.float32)
            total = np.maximum(joint.sum(axis=1), 1e-30)
            if step == rounds:
                break
            share = share.copy()
            share[at] = np.add.reduceat(joint / total[:, None], first, axis=0) / words[at][:, None] if len(first) else share[at]
        log = base.copy()
        log += np.bincount(own, weights=np.log(total), minlength=texts)
        return share, log

    out = np.zeros((texts, k))
    every = np.arange(len(owner))
    full, full_log = fit(np.repeat((words > 0)[:, None], k, 1).astype(float), every)
    order = np.argsort(-full, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    best, best_score, going = np.zeros((texts, k)), np.full(texts, -np.inf), words > 0
    for m in range(1, k + 1):
        which = every[going[owner]] if m > 1 else every
        if not len(which):
            break
        if m == 1:
            share = (rank == 0).astype(float)
            log = base + np.bincount(owner, weights=np.log(np.maximum(chance[every, order[owner, 0]], 1e-30)), minlength=texts)
        elif m == k:
            share, log = full, full_log
        else:
            share, log = fit((rank < m).astype(float), which)
        score = log - PENALTY * (m - 1) * np.log(np.maximum(words, 2))
        better = going & (score > best_score)
        best[better], best_score[better] = share[better], score[better]
        going = better
    out[words > 0] = best[words > 0]
    return out


def predictions(text: pa.Array, names: list[str], table: np.ndarray) -> tuple[list[str], np.ndarray]:
    texts = as_bytes(text)
    letters = np.asarray(pa.compute.fill_null(pa.compute.match_substring_regex(text, r"\p{L}"), False))
    top, score = np.zeros(len(texts), int), np.zeros(len(texts))
    if names:
        folds, starts = folded(texts)
        like, owner = word_likelihoods(folds, starts, table)
        if len(owner):
            share = proportions(like, owner, len(texts))
            top, score = share.argmax(axis=1), share.max(axis=1)
    known = letters & (score > 0)
    return [names[t] if ok else "und" for t, ok in zip(top.tolist(), known.tolist(), strict=True)], np.where(known, np.clip(score, 0, 1), 0.0)


def _predictor(names: list[str], table: np.ndarray, held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", slice_bytes(len(names))):
            pred, score = predictions(batch.column("text"), names, table)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.compute.equal(batch.column("part"), held), pa.array(pred, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def with_language(docs: DataFrame, least_share: float = 0.4, modulus: int = 3, held: int = 1) -> DataFrame:
    """The rows of docs, whole, that have a language: one that holds least_share of the text.

    Defined results are those of `identify`: rows that are `und` there (null and empty texts, texts without a letter, all
    rows where nothing was learned) go; repeated rows stay or go together; extra columns, whatever their names, are kept.
    """
    prepare(docs.sparkSession)
    rows = docs.select(docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"), crc_mod(docs["doc_id"], modulus).alias("part"))
    names, table = learn(rows.where(F.col("part") != held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", slice_bytes(len(names))):
            pred, score = predictions(batch.column("text"), names, table)
            yield batch.filter(pa.array([p != "und" and s >= least_share for p, s in zip(pred, score.tolist(), strict=True)]))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    """Learns from the rows whose crc32(doc_id as text) mod `modulus` is not `held`; predicts for all rows."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), crc_mod(F.col("doc_id"), modulus).cast("int").alias("part"))
    names, table = learn(rows.where(F.col("part") != held))
    return rows.select("doc_id", "text", "part").mapInArrow(_predictor(names, table, held), "doc_id long, held_out boolean, lang_pred string, score double")
