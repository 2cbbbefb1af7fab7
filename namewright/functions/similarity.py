"""String similarities that Spark lacks, for use in Arrow batches; each is written from its published definition."""

from __future__ import annotations

from difflib import SequenceMatcher


def osa(a: str, b: str, most: int = 1 << 30) -> int:
    """Optimal string alignment: edits and swaps of neighbours, no part edited twice; most + 1 where it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        before, last = last, now
        if min(last) > most and (not before or min(before) > most):
            return most + 1
    return min(last[-1], most + 1)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        u = row & at.get(y, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - bin(row).count("1")


def ratio(a: str, b: str) -> float:
    """Indel similarity from 0 to 100."""
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """The best of the shared words against each side, and of both sides with the shared words first."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, one, two = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not one or not two):
        return 100.0
    left, right = f"{both} {one}".strip(), f"{both} {two}".strip()
    return max([ratio(left, right)] + ([ratio(both, left), ratio(both, right)] if both else []))


def jaro(a: str, b: str) -> float:
    if not a or not b:
        return float(a == b)
    reach = max(len(a), len(b)) // 2 - 1
    used, mine = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                mine.append(x)
                break
    if not mine:
        return 0.0
    other = [b[j] for j in range(len(b)) if used[j]]
    m, t = len(mine), sum(x != y for x, y in zip(mine, other, strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - t) / m) / 3


def jaro_winkler(a: str, b: str, weight: float = 0.1, least: float = 0.7) -> float:
    j = jaro(a, b)
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(len(a), len(b), 4))
    return j + prefix * weight * (1 - j) if j > least else j


def ratcliff(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()
