"""Best choices by similarity, with bounds that spare most comparisons."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np

from ..functions.similarity import jaro_winkler, ratio, token_sort

_PLACES = {c: i for i, c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 ")}


def letter_counts(texts: list[str]) -> np.ndarray:
    """How often each text has each character; all others are one."""
    out = np.zeros((len(texts), len(_PLACES) + 1), np.uint16, order="F")  # a character's counts lie together
    for i, text in enumerate(texts):
        for c, n in Counter(text).items():
            out[i, _PLACES.get(c, len(_PLACES))] += n
    return out


class Choices:
    """Texts to choose from; the first of equals wins."""

    def __init__(self, texts: list[str]):
        self.texts, self.counts = texts, letter_counts(texts)
        self.sizes = np.array([len(x) for x in texts], np.int64)
        self.single = np.array([x.split() == [x] for x in texts], bool)
        self.shapes, self.shape = np.unique(2 * self.sizes + self.single, return_inverse=True)

    def common(self, query: str) -> np.ndarray:
        """At most so many characters of each text can be matched with the query's."""
        out = np.zeros(len(self.texts), np.uint16 if len(query) < 1 << 16 else np.int64)
        for at, n in enumerate(letter_counts([query])[0].tolist()):
            if n:
                out += np.minimum(self.counts[:, at], n)
        return out

    def bounds(self, scorer: Callable, query: str, common: np.ndarray, sizes: np.ndarray, single: np.ndarray) -> np.ndarray:
        """The highest scores of texts of such sizes that share so many characters with the query; they grow with these."""
        n = len(query)
        if scorer is jaro_winkler:
            jaro = np.where((common > 0) | (sizes + n == 0), (common / max(n, 1) + common / np.maximum(sizes, 1) + 1) / 3, 0) + (sizes + n == 0)
            return jaro + 0.4 * (1 - jaro)
        # sorting tokens may drop blanks only
        spare = ~single | (query.split() != [query])
        return np.minimum(100.0, 200 * (common + spare) / np.maximum(n + sizes - query.count(" "), 1)) if scorer in (ratio, token_sort) else np.full(len(sizes), np.inf)

    def least(self, scorer: Callable, query: str, cutoff: float) -> np.ndarray:
        """For each text, of how many common characters on its bound is at least cutoff; by its shape, of which there are few."""
        shapes, n = self.shapes, len(query) + 1
        common = np.tile(np.arange(n, dtype=np.int64), len(shapes))
        sizes, single = np.repeat(shapes >> 1, n), np.repeat((shapes & 1).astype(bool), n)
        reached = (self.bounds(scorer, query, common, sizes, single) >= cutoff).reshape(len(shapes), n)
        return (n - reached.sum(axis=1)).astype(np.int32)[self.shape]

    def best(self, query: str, scorer: Callable, cutoff: float, allowed: np.ndarray | None = None, most: int = 1) -> list[tuple[float, int]]:
        """The best `most` texts of at least cutoff, as (score, place), best first, the earlier of equals first."""
        common = self.common(query)
        may = common >= self.least(scorer, query, max(cutoff, 0))
        own = np.flatnonzero(may if allowed is None else may & allowed)
        bound = self.bounds(scorer, query, common[own].astype(np.int64), self.sizes[own], self.single[own])
        found: list[tuple[float, int]] = []
        order = np.argsort(-bound, kind="stable")
        for i, bound_ in zip(own[order].tolist(), bound[order].tolist(), strict=True):
            if len(found) >= most and bound_ < found[most - 1][0]:
                break
            if (score := scorer(query, self.texts[i])) >= cutoff:
                found.append((score, i))
                found.sort(key=lambda x: (-x[0], x[1]))
                del found[most:]
        return found
