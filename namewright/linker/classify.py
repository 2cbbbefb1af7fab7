"""Whether a row is a product, garbage, or maybe a product."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np

from ..functions.similarity import osa, ratcliff
from .forms import coarse_forms
from .lexicon import DEFAULT, FORM_SIGNAL, QUANTITY_SIGNAL, Lexicon
from .words import compact, tokens, upper

_FORM, _QUANTITY = re.compile(FORM_SIGNAL, re.I), re.compile(QUANTITY_SIGNAL, re.I)
KINDS = ("1-substitution", "1-insertion", "1-deletion", "1-transposition", "2-edit")


@dataclass(frozen=True)
class Match:
    brand: str
    text: str
    kind: str


@dataclass(frozen=True)
class Verdict:
    """0 product, 1 garbage, or MAYBE_PRODUCT, with what was matched."""

    kind: str
    brand: str = ""
    text: str = ""
    match: str = ""
    phrase: str = ""
    phrase_match: str = ""


def spans(value: object, longest: int | None = None) -> list[tuple[int, int, str, str]]:
    """(start, end, words, words as one) of runs of words; runs of several words only up to `longest` characters."""
    own, out = tokens(value), []
    for i in range(len(own)):
        joined = ""
        for j in range(i, len(own)):
            joined += own[j]
            if j > i and longest is not None and len(joined) > longest:
                break
            out.append((i, j, " ".join(own[i : j + 1]), joined))
    return out


def edit_kind(a: str, b: str) -> str | None:
    """What makes a of b in one edit, or exact, or nothing."""
    if a == b:
        return "exact"
    if abs(len(a) - len(b)) > 1:
        return None
    head = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return KINDS[0] if a[head + 1 :] == b[head + 1 :] else None
    return (KINDS[1] if a[head:] == b[head + 1 :] else None) if len(a) < len(b) else (KINDS[2] if a[head + 1 :] == b[head:] else None)


def shortened(text: str, edits: int) -> set[str]:
    """A text without up to so many letters: texts that are near each other share one of these."""
    out = level = {text}
    for _ in range(edits):
        level = {t[:i] + t[i + 1 :] for t in level for i in range(len(t))}
        out = out | level
    return out


def _table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_CRC = _table()


def crcs(rows: np.ndarray) -> np.ndarray:
    """crc32 of each row of bytes."""
    out = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in rows.T:
        out = _CRC[(out ^ column) & 0xFF] ^ (out >> np.uint32(8))
    return out ^ np.uint32(0xFFFFFFFF)


class Deletions:
    """Compact texts by checksums of what is left without up to some letters: eight bytes for each, so that many brands fit."""

    def __init__(self, texts: list[tuple[int, str, int]]):
        """texts: (number, text, edits)."""
        by_shape: dict[tuple[int, int], list[tuple[int, str]]] = {}
        for k, text, edits in texts:
            by_shape.setdefault((len(text), edits), []).append((k, text))
        keys, owners = [np.zeros(0, np.uint32)], [np.zeros(0, np.int32)]
        for (n, edits), own in by_shape.items():
            rows, numbers = np.frombuffer("".join(t for _, t in own).encode(), np.uint8).reshape(len(own), n), np.array([k for k, _ in own], np.int32)
            for gone in (g for d in range(min(edits, n) + 1) for g in combinations(range(n), d)):
                keys.append(crcs(np.delete(rows, gone, axis=1)))
                owners.append(numbers)
        order = np.argsort(key := np.concatenate(keys))
        self.keys, self.owners = key[order], np.concatenate(owners)[order]
        sizes = [len(t) for _, t, _ in texts]
        self.least, self.most = min(sizes, default=1), max(sizes, default=-3)

    def like(self, text: str, edits: int) -> list[int]:
        """Numbers of texts that may be within so many edits, two at most, in order."""
        if not self.least - 2 <= len(text) <= self.most + 2:
            return []
        wanted = np.array(sorted(zlib.crc32(t.encode()) for t in shortened(text, edits)), np.uint32)
        first, last = np.searchsorted(self.keys, wanted), np.searchsorted(self.keys, wanted, "right")
        return sorted({k for i, j in zip(first.tolist(), last.tolist(), strict=True) if i < j for k in self.owners[i:j].tolist()})


class Vocabulary:
    """Brands in the order of their priority, found by spelling or by deletions of letters."""

    def __init__(self, brands: list[str]):
        self.brands = [(b, compact(b)) for b in brands]
        self.exact: dict[str, int] = {}
        for k, (_, n) in enumerate(self.brands):
            self.exact.setdefault(n, k)
        self.longest = max((len(n) for _, n in self.brands), default=0)

    @cached_property
    def near(self) -> Deletions:
        return Deletions([(k, n, self.edits(len(n))) for k, (_, n) in enumerate(self.brands) if len(n) >= 4])

    @cached_property
    def far(self) -> Deletions:
        """For two edits of brands of eight letters or more."""
        return Deletions([(k, n, 2) for n, k in self.exact.items() if len(n) >= 8])

    @staticmethod
    def edits(n: int) -> int:
        return 2 if n >= 10 else 1

    def first_exact(self, own: list[tuple]) -> Match | None:
        """The brand of highest priority that is a span; of three letters or less only one word."""
        hits = [(k, i, j, text) for i, j, text, joined in own if (k := self.exact.get(joined)) is not None and (len(joined) > 3 or i == j)]
        return Match(self.brands[(m := min(hits))[0]][0], m[3], "exact") if hits else None

    def best_near(self, own: list[tuple]) -> Match | None:
        """The brand within one edit or swap (two for brands of ten letters on): by kind of edit, longer span, priority, place."""
        hits = []
        for i, j, text, joined in own:
            for k in self.near.like(joined, self.edits(len(joined) + 2)):
                norm = self.brands[k][1]
                kind = edit_kind(joined, norm)
                if kind is None and (d := osa(joined, norm, self.edits(len(norm)))) <= self.edits(len(norm)):
                    kind = KINDS[3] if d == 1 else KINDS[4]
                if kind not in (None, "exact"):
                    hits.append((KINDS.index(kind), -len(joined), k, i, j, text, kind))
        if not hits:
            return None
        _, _, k, _, _, text, kind = min(hits)
        return Match(self.brands[k][0], text, kind)


class Evidence:
    """What the catalogue says of the vocabulary's brands: products as (variant, strength, forms)."""

    def __init__(self, named: dict[str, str], rows, lexicon: Lexicon = DEFAULT):
        """named: the vocabulary's brands by their letters and digits; rows: (brand, product, variant, sub-variant), in the catalogue's order."""
        self.names, self.products, self.variants, self.strengths = {}, {}, {}, {}
        for brand, product, variant, sub in rows:
            if (norm := compact(brand)) in named:
                self.names[norm] = named[norm]
                variant, sub = ("" if upper(x).strip() == "PLAIN" else compact(x) for x in (variant or "", sub or ""))
                self.products.setdefault(norm, []).append((variant, sub, coarse_forms(product, lexicon)))
                self.variants.setdefault(norm, set()).update({variant} - {""})
                self.strengths.setdefault(norm, set()).update({sub} if re.search(r"\d", sub) else ())

    @cached_property
    def order(self) -> dict[str, int]:
        return {norm: k for k, norm in enumerate(self.products)}

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.names), default=0)

    @cached_property
    def by_size(self) -> dict[int, list[str]]:
        out: dict[int, list[str]] = {}
        for norm in self.names:
            out.setdefault(len(norm), []).append(norm)
        return out

    def within(self, row: str) -> list[str]:
        """Brands of four letters or more in a compact row, in the catalogue's order."""
        found = {row[i : i + n] for i in range(len(row)) for n in range(4, min(self.longest, len(row) - i) + 1)}
        return sorted((n for n in found if n in self.order), key=self.order.__getitem__)

    def product(self, value: object, own: list[tuple], lexicon: Lexicon = DEFAULT) -> Match | None:
        """A brand in the row of one of whose products variant, strength and form are there, too, one of them said."""
        row, words, forms, text = compact(value), set(tokens(value)), coarse_forms(value, lexicon), upper(value)
        for norm in self.within(row):
            for variant, dose, made in self.products[norm]:
                has_variant = bool(variant) and (norm + variant in row or variant in words or (len(variant) > 1 and variant in row))
                has_dose = bool(dose) and bool(
                    re.search(rf"{norm}{dose}(?!\d)", row) or re.search(rf"(?<!\d){dose}\s*(?:MG|MCG|GM|ML|IU|G|K)\b", text) or dose in words or (not dose.isdigit() and dose in row)
                )
                has_form = bool(made & forms)
                if (has_variant or not variant) and (has_dose or not dose) and (has_form or not made) and (has_variant or has_dose or has_form):
                    return Match(self.names[norm], self.shown(norm, value), "master-product")
        return None

    def shown(self, norm: str, value: object) -> str:
        """The shortest beginning of the row that has the brand."""
        own, joined = tokens(value), ""
        for k, t in enumerate(own):
            joined += t
            if norm in joined:
                return " ".join(own[: k + 1])
        return self.names[norm]

    def glued(self, own: list[tuple]) -> Match | None:
        """A word that is a brand and one of its variants; the longest brand of the first such word."""
        for i, j, text, joined in own:
            if i == j:
                for n in range(min(len(joined) - 1, self.longest), 0, -1):
                    if joined[n:] in self.variants.get(joined[:n], ()):
                        return Match(self.names[joined[:n]], text, "master-variant")
        return None

    def misspelt(self, value: object, own: list[tuple]) -> Match | None:
        """A word within two edits of a brand of eight letters or more, with one of its strengths in the row; none if two fit as well."""
        row, found = compact(value), []
        for i, j, text, joined in own:
            near = [norm for n in range(max(8, len(joined) - 2), len(joined) + 3) for norm in self.by_size.get(n, ())] if i == j else []
            for norm in near:
                if norm.startswith(joined) or joined.startswith(norm) or len(set(joined) - set(norm)) > 2:
                    continue
                if (d := osa(joined, norm, 2)) in (1, 2) and any(re.search(rf"(?<!\d){s}(?!\d)", row) for s in self.strengths[norm]):
                    found.append((d, -len(norm), self.names[norm], text))
        found.sort()
        if not found or (len(found) > 1 and found[0][:2] == found[1][:2]):
            return None
        return Match(found[0][2], found[0][3], "master-2-edit")

    def fused(self, value: object, lexicon: Lexicon = DEFAULT) -> Match | None:
        """Rows that as a whole are known spellings of a brand's variant, if the catalogue has that."""
        brand, variant = lexicon.fused.get(compact(value), ("", ""))
        return Match(self.names[brand], str(value), "master-new-family-exact") if variant and variant in self.variants.get(brand, ()) else None

    def match(self, value: object, own: list[tuple], lexicon: Lexicon = DEFAULT) -> Match | None:
        if found := self.fused(value, lexicon):
            return found
        form, quantity = has_form(value), has_quantity(value)
        if not form and not quantity:
            return None
        return self.product(value, own, lexicon) or self.glued(own) or (self.misspelt(value, own) if form and quantity else None)


def has_form(value: object) -> bool:
    return bool(_FORM.search(str(value)))


def has_quantity(value: object) -> bool:
    return bool(_QUANTITY.search(str(value)))


def garbage_phrases(lexicon: Lexicon = DEFAULT) -> dict[str, str]:
    """Compact phrases, the empty one among them, and how they are written."""
    return {"": ""} | {compact(p): p for p in reversed(lexicon.phrases)}


def is_garbage_phrase(value: object, phrases: dict[str, str]) -> bool:
    return compact(value) in phrases


def is_garbage_pattern(value: object, lexicon: Lexicon = DEFAULT) -> bool:
    text = str(value).strip()
    return any(p.match(text) for p in lexicon.garbage_patterns)


def is_metadata(value: object, lexicon: Lexicon = DEFAULT) -> bool:
    own = re.findall("[A-Z]+", upper(value))
    return bool(own) and all(t in lexicon.meta_words for t in own)


def near_phrase(value: object, phrases: dict[str, str]) -> tuple[str, str] | None:
    """The phrase one edit away, and the kind of edit: by kind, longer phrase, spelling."""
    own = compact(value)
    hits = [(KINDS.index(k), -len(n), n, k) for n in phrases if n and own and (k := edit_kind(own, n)) in KINDS]
    return (phrases[(m := min(hits))[2]], m[3]) if hits else None


def may_be_product(value: object, lexicon: Lexicon = DEFAULT) -> bool:
    """A form, a quantity or a known product, and no word of reports."""
    text = str(value)
    known = any(re.search(rf"\b{re.escape(p)}\b", text, re.I) for p in lexicon.known_products)
    return not lexicon.guard_pattern.search(text) and (has_form(text) or has_quantity(text) or known)


def corrected(match: Match | None, value: object, lexicon: Lexicon = DEFAULT) -> tuple[Match | None, bool]:
    """A match after the brands' exceptions, in order, and whether the row is garbage by one of them."""
    if match and compact(match.brand) in lexicon.exact_only and match.kind != "exact":
        match = None
    for e in lexicon.exceptions:
        if match is None or compact(match.brand) != e.brand:
            continue
        text = {"name": upper(value), "compact": compact(value), "matched": upper(match.text)}[e.within]
        if bool(re.search(e.pattern, text)) != e.absent:
            if e.action == "garbage":
                return None, True
            match = Match(e.to, match.text, match.kind) if e.action == "rename" else None
    return match, False


class Classifier:
    """The whole cascade over one row; built once, used for all."""

    def __init__(self, brands: list[str], catalogue=(), lexicon: Lexicon = DEFAULT):
        self.lexicon, self.vocabulary, self.phrases = lexicon, Vocabulary(brands), garbage_phrases(lexicon)
        self.evidence = Evidence({n: b for b, n in self.vocabulary.brands}, catalogue, lexicon)

    def said(self, value: object, own: list[tuple]) -> tuple[Match | None, bool, bool]:
        """What the vocabulary says: a match, whether the row is garbage by it, and whether the catalogue is to be asked."""
        first = self.vocabulary.first_exact(own) or self.vocabulary.best_near(own)
        match, garbage = corrected(first, value, self.lexicon)
        return match, garbage, not garbage and match is None and (first is None or compact(first.brand) in self.lexicon.weak_brands)

    def wanted(self, value: object) -> list[str]:
        """The brands, by letters and digits, of which the verdict of a row needs what the catalogue says."""
        own = spans(value, self.vocabulary.longest + 2)
        if not self.said(value, own)[2]:
            return []
        exact, row, (fused, _) = self.vocabulary.exact, compact(value), self.lexicon.fused.get(compact(value), ("", ""))
        found, form, quantity = {fused}, has_form(value), has_quantity(value)
        if form or quantity:
            found |= {row[i : i + n] for i in range(len(row)) for n in range(4, min(self.vocabulary.longest, len(row) - i) + 1)}
            words = {joined for i, j, _, joined in own if i == j}
            found |= {w[:n] for w in words for n in range(1, min(len(w) - 1, self.vocabulary.longest) + 1)}
            if form and quantity:
                found |= {self.vocabulary.brands[k][1] for w in words for k in self.vocabulary.far.like(w, 2)}
        return sorted(n for n in found if n in exact and n)

    def __call__(self, value: object) -> Verdict:
        own = spans(value, self.vocabulary.longest + 2)
        match, garbage, ask = self.said(value, own)
        if garbage:
            return Verdict("1")
        return self.verdict(value, self.evidence.match(value, own, self.lexicon) if ask else match)

    def verdict(self, value: object, match: Match | None) -> Verdict:
        if match and compact(match.brand) not in self.lexicon.review_brands:
            return Verdict("0", match.brand, match.text, match.kind)
        if is_garbage_phrase(value, self.phrases) or is_garbage_pattern(value, self.lexicon) or is_metadata(value, self.lexicon):
            return Verdict("1")
        if near := near_phrase(value, self.phrases):
            return Verdict("1", phrase=near[0], phrase_match=near[1])
        return Verdict("MAYBE_PRODUCT", match="form+qty match" if may_be_product(value, self.lexicon) else "no-brand-fallback")


def words_and_pairs(value: object) -> list[str]:
    """Words of three letters or more, and neighbours as one."""
    own = re.findall("[A-Z]{3,}", upper(value))
    return own + [a + b for a, b in zip(own, own[1:], strict=False)]


def brand_candidates(value: object, brands: list[str], most: int = 3, least: float = 0.6) -> list[tuple[str, str, float]]:
    """The brands most like one of a row's words: (brand, word, score)."""
    own = words_and_pairs(value)
    best = [(b, *max((ratcliff(w, upper(b)), w) for w in own)[::-1]) for b in brands] if own else []
    return [c for c in sorted(best, key=lambda c: -c[2])[:most] if c[2] >= least]


def prompt_line(number: int, value: object, found: list[tuple[str, str, float]]) -> str:
    return f"{number}. {value} || candidates: " + (", ".join(f'{b} (word "{w}", {s:.2f})' for b, w, s in found) or "no close brand")


def answers(text: str | None, rows: int) -> list[str]:
    """A model's answers, a line `n=0` or `n=1` for each row; one row may be answered by the digit alone."""
    if text is None:
        return ["ERROR"] * rows
    found = {int(m[1]): m[2] for m in re.finditer(r"^\s*(\d+)\s*=\s*([01])\s*$", text, re.M)}
    if rows == 1 and 1 not in found and (m := re.search(r"\b([01])\b", text.strip())):
        found[1] = m[1]
    return [found.get(k, "BAD_OUTPUT") for k in range(1, rows + 1)]


