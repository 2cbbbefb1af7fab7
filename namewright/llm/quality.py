"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose statistic is above a cutoff.  The cutoff of a rule in a stratum is the strictest one
for which labelled good documents show, by an exact binomial test, that at most `rule_risk` of good documents are
rejected.  Cutoffs are tried from the loosest on and the first that fails ends the search, which needs no correction
along the ladder; over rules and groups of strata the error level is divided (Bonferroni).  So with probability 1 - delta
no rule rejects more than rule_risk of a group's good documents, and all rules together at most rule_risk times their number.

Strata are classes of text length, so neither language nor source is needed.  Neighbouring strata share cutoffs where one
alone holds too few good labelled documents to certify any: groups are chosen by these numbers only, never by what rules
reject, as many groups as can each certify a cutoff.  With fewer documents in all than one group takes (2300 at the
defaults) nothing can be certified and only the base rule rejects.

Defined results: a null text has no words (and fails the base rule); labels of ids that are null or unknown are ignored,
of several labels for an id the worst counts; repeated rows and ties each get their result; a statistic equal to a cutoff
isn't above it; extra columns, whatever their names, are ignored; an empty table gives an empty result, empty labels leave
the base rule alone; a very long text is held whole by one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, hashed_words, materialize, mix, prepare, slices, windows

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
STRATA = (100, 400, 1600)  # words
#: Rules: name, statistic (per mille of features) and the ladder of cutoffs, loosest first.
RULES = {
    "symbols": ("1000 * n_symbols / greatest(n_words, 1)", [3000, 2000, 1500, 1000, 800, 600, 500, 400, 300, 250, 200, 150, 100, 70, 50]),
    "duplicate_lines": ("1000 * n_dup_lines / greatest(n_lines, 1)", [900, 800, 700, 600, 500, 400, 300, 250, 200, 150, 100]),
    "repeated_words": ("1000 * n_repeat_words / greatest(n_words, 1)", [900, 800, 700, 600, 500, 400, 350, 300, 250, 200, 150, 100]),
    "long_words": ("1000 * word_chars / greatest(n_words, 1)", [40000, 30000, 20000, 16000, 14000, 12000, 11000, 10000, 9000, 8500, 8000]),
    "short_words": ("-1000 * word_chars / greatest(n_words, 1)", [-1000, -1500, -2000, -2500, -3000, -3250, -3500, -3750, -4000]),
}
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def repeated_words(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each text, the words in windows that it holds twice or more."""
    n, out = len(words), np.zeros(len(counts), np.int64)
    value, starts = windows(words, counts, WINDOW)
    if not len(value):
        return out
    owner = np.repeat(np.arange(len(counts)), counts)
    with np.errstate(over="ignore"):
        key = mix(value + owner[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    bins = (key >> np.uint64(43)).astype(np.int64)
    some = np.flatnonzero(np.bincount(bins, minlength=1 << 21)[bins] > 1)  # others can't be equal
    order = some[np.argsort(key[some], kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    hit = np.zeros(len(key), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    at = starts[hit]
    change = np.bincount(at, minlength=n + 1) - np.bincount(at + WINDOW, minlength=n + 1)
    covered = np.cumsum(change)[:n] > 0
    return np.bincount(owner[covered], minlength=len(counts)).astype(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        texts = as_bytes(batch.column("text"))
        words, counts = hashed_words(texts, lower=False)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(x) for x in texts])
        starts = np.r_[0, ends[:-1]]

        def per_text(mask: np.ndarray, starts: np.ndarray = starts, ends: np.ndarray = ends) -> pa.Array:
            total = np.r_[0, np.cumsum(mask, dtype=np.int64)]
            return pa.array(total[ends] - total[starts])

        lines = [[x for x in text.split(b"\n") if x.strip()] for text in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts), per_text(((raw & 0xC0) != 0x80) & ~_SPACE[raw]), per_text(_SYMBOL[raw]), pa.array([len(x) for x in lines], pa.int64()), pa.array([len(x) - len(set(x)) for x in lines], pa.int64()), pa.array(repeated_words(words, counts))],
            names=["doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"],
        )


def features(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(_features, SCHEMA)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p), exact up to rounding."""
    if n == 0 or k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def stratum_groups(good: dict[int, int], rule_risk: float, delta: float) -> list[tuple[int, ...]]:
    """Runs of neighbouring strata: as many as each hold enough good documents to certify a cutoff that rejects none, of these the most even; one run where none does."""
    strata = sorted(good)
    for cuts in range(len(strata) - 1, 0, -1):
        splits = [[tuple(strata[a:b]) for a, b in pairwise((0, *at, len(strata)))] for at in combinations(range(1, len(strata)), cuts)]
        least, best = max((min(sum(good[s] for s in group) for group in split), split) for split in splits)
        if binomial_tail(0, least, rule_risk) <= delta / len(best) / len(RULES):
            return best
    return [tuple(strata)]


def chosen_cutoffs(rejected: dict[tuple[int, str], list[int]], good: dict[int, int], rule_risk: float, delta: float) -> dict[tuple[int, str], int]:
    """The strictest certified cutoff's place in its ladder, for each stratum and rule that has one.  rejected: good documents above each cutoff."""
    groups, out = stratum_groups(good, rule_risk, delta), {}
    level = delta / len(groups) / len(RULES)
    for group in groups:
        n = sum(good[s] for s in group)
        for rule, (_, ladder) in RULES.items():
            for place in range(len(ladder)):
                k = sum(rejected[s, rule][place] for s in group if (s, rule) in rejected)
                if k > 2 * rule_risk * n + 50 or binomial_tail(k, n, rule_risk) > level:
                    break
                out |= {(s, rule): place for s in group}
    return out


def stratum() -> Column:
    return sum((F.when(F.col("n_words") >= n, 1).otherwise(0) for n in STRATA), F.lit(0))


def exceeded(rule: str) -> Column:
    """How many cutoffs of the rule's ladder the document's statistic is above."""
    statistic, ladder = RULES[rule]
    return sum((F.when(F.expr(statistic) > c, 1).otherwise(0) for c in ladder), F.lit(0))


def risk_controlled(docs: DataFrame, labels: DataFrame, rule_risk: float = 0.002, delta: float = 0.05) -> DataFrame:
    """Features and verdict of each document; labels: (doc_id, quality), 1 for good."""
    rows = materialize(features(docs), "quality-features")
    good = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    held = rows.where("n_words >= 20 and 100 * n_repeat_words <= 30 * n_words").join(good, "doc_id", "left_semi")
    # a ladder is loosest first: who is above the cutoff at a place is above all cutoffs after it
    levels = held.select(stratum().alias("stratum"), F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), exceeded(r).alias("places")) for r in RULES])).alias("e")).select("stratum", "e.*")
    found = levels.groupBy("stratum", "rule", "places").count().collect()  # at most strata x rules x cutoffs rows
    sizes = {s: sum(r["count"] for r in found if r["stratum"] == s and r["rule"] == next(iter(RULES))) for s in range(len(STRATA) + 1)}
    rejected = {(s, r): [sum(x["count"] for x in found if x["stratum"] == s and x["rule"] == r and x["places"] >= len(RULES[r][1]) - place) for place in range(len(RULES[r][1]))] for s in sizes for r in RULES if sizes[s]}
    cutoffs = chosen_cutoffs(rejected, sizes, rule_risk, delta)
    reject = F.lit(False)
    for (s, r), place in cutoffs.items():
        statistic, ladder = RULES[r]
        reject = reject | ((stratum() == s) & (F.expr(statistic) > ladder[place]))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & ~reject).alias("kept"), stratum().cast("int").alias("stratum"))
