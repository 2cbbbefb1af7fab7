"""The catalogue: products, brands, and what is looked up in them for every name."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np

from .lexicon import DEFAULT, Lexicon
from .scores import Choices
from .words import COMBO, NUMBER, clean, clean_attribute, clean_code, comparable, compact, dose_of, full_strengths, is_dose, joined_thousands, letters, strengths_in_compact, upper


@dataclass(frozen=True)
class Item:
    """A product of the catalogue."""

    product: str
    pack: str = ""
    variant: str = "PLAIN"
    sub: str = "PLAIN"
    code: str = ""
    brand: str = ""


def repaired_fields(variant: object, sub: object, lexicon: Lexicon = DEFAULT) -> tuple[str, str]:
    """Variant and sub-variant with strengths where they belong: in the sub-variant.  The first rule that holds counts."""
    sub = clean_attribute(sub)
    variant = " ".join(t for t in clean_attribute(variant).split() if t not in lexicon.oral_words) or "PLAIN"
    unit = r"(?:MG|GM|ML|MCG|G|M|IU|UNIT)"
    if sub == "PLAIN" and (m := re.fullmatch(rf"({NUMBER})\s*-?\s*(?:PFS|VIAL|AMP|AMPS|SYR|SYRINGE|PEN|IU|INJ|INJECTION)", joined_thousands(variant))):
        return "PLAIN", m[1]
    if sub in lexicon.dose_noise and (dose := dose_of(variant)):
        return "PLAIN", dose
    if re.fullmatch(COMBO, variant) and re.search("[A-Z]", sub) and sub != "PLAIN" and not is_dose(sub) and sub not in lexicon.dose_noise:
        return sub, variant
    if sub != "PLAIN":
        return variant, sub
    if m := re.fullmatch(rf"({COMBO})(?:\s*{unit})?", variant):
        return "PLAIN", m[1]
    if m := re.fullmatch(rf"(.+?)[\s\-]+({COMBO})", variant):
        return m[1].strip(), m[2]
    if (m := re.fullmatch(rf"([A-Z]+(?:\s+[A-Z]+)*?)({COMBO})", variant)) and ("/" in m[2] or len(m[2].replace(".", "")) >= 2):
        return m[1].strip(), m[2]
    if (m := re.fullmatch(rf"({COMBO})\s+([A-Z]+(?:\s+[A-Z0-9]+)*)", variant)) and m[2] not in lexicon.dose_noise:
        return m[2], m[1]
    if m := re.fullmatch(rf"(.+?)[\s\-]+({COMBO})\s*{unit}", variant):
        return m[1].strip(), m[2]
    return variant, sub


class Brand:
    """A brand's spellings, ready to be searched for."""

    def __init__(self, name: str, items: list[Item]):
        self.name, self.items = name, items
        self.text = upper(name).replace("-", " ").strip()
        self.words = full_strengths(self.text.split())
        self.first = self.text.split()[0] if self.text.split() else ""
        self.compact = strengths_in_compact(compact(name))
        self.plain = compact(name)

    @cached_property
    def pattern(self) -> re.Pattern:
        return re.compile(rf"\b{re.escape(self.text)}\b")


class Catalogue:
    """Brands in order, each with its products (in order, one for a name and pack)."""

    def __init__(self, brands: dict[str, list[Item]], lexicon: Lexicon = DEFAULT):
        self.lexicon = lexicon
        self.brands = {name: Brand(name, items) for name, items in brands.items()}
        self.order = {name: i for i, name in enumerate(self.brands)}
        self.by_first: dict[str, list[Brand]] = {}
        self.by_compact: dict[str, list[Brand]] = {}
        self.by_plain: dict[str, list[Brand]] = {}
        for b in self.brands.values():
            self.by_first.setdefault((re.findall(r"[A-Z0-9]+", b.first) or [""])[0], []).append(b)
            self.by_compact.setdefault(b.compact, []).append(b)
            self.by_plain.setdefault(b.plain, []).append(b)
        self.longest = max((len(b.plain) for b in self.brands.values()), default=0)

    @classmethod
    def of_rows(cls, rows, lexicon: Lexicon = DEFAULT) -> Catalogue:
        """rows: (brand, product, pack, variant, sub-variant, code) in the catalogue's order.  A brand is named as in its first row."""
        names, items, seen = {}, {}, set()
        for brand, product, pack, variant, sub, code in rows:
            brand, product, pack = clean(brand), clean(product), clean(pack)
            if not brand or not product:
                continue
            name = names.setdefault(comparable(brand), brand)
            if (name, product, pack) not in seen:
                seen.add((name, product, pack))
                items.setdefault(name, []).append(Item(product, pack, *repaired_fields(variant, sub, lexicon), clean_code(code), name))
        return cls({name: items[name] for _, name in sorted(names.items())}, lexicon)

    def key(self, hint: object) -> str | None:
        """The brand that a hint names, in any case."""
        hint = upper(hint).strip()
        if hint in self.brands:
            return hint
        return self.by_upper.get(hint) if hint else None

    @cached_property
    def by_upper(self) -> dict[str, str]:
        return {name.upper(): name for name in reversed(self.brands)}

    @cached_property
    def words(self) -> tuple[frozenset[str], frozenset[str]]:
        """Words of two letters or more of all variants, and of all sub-variants."""
        of = lambda f: frozenset(w for b in self.brands.values() for i in b.items for w in re.findall("[A-Z]{2,}", upper(f(i))))
        return of(lambda i: i.variant), of(lambda i: i.sub)

    @cached_property
    def variants(self) -> frozenset[str]:
        return frozenset({"PLAIN"} | {upper(i.variant) for b in self.brands.values() for i in b.items})

    @cached_property
    def sub_variants(self) -> frozenset[str]:
        return frozenset({"PLAIN"} | {upper(i.sub) for b in self.brands.values() for i in b.items})

    @cached_property
    def long_letters(self) -> frozenset[str]:
        return frozenset(x for b in self.brands if len(x := letters(b)) >= 4)

    @cached_property
    def names(self) -> Choices:
        return Choices(list(self.brands))

    @cached_property
    def single_words(self) -> np.ndarray:
        return np.array([len(b.name.split()) == 1 or not b.first for b in self.brands.values()], bool)

    @cached_property
    def of_words(self) -> dict[str, list[int]]:
        """Places of the brands of several words, by their first."""
        out: dict[str, list[int]] = {}
        for i, b in enumerate(self.brands.values()):
            if not self.single_words[i]:
                out.setdefault(b.first, []).append(i)
        return out

    @cached_property
    def longest_first(self) -> int:
        return max(map(len, self.of_words), default=0)

    @cached_property
    def norms(self) -> tuple[Choices, list[str]]:
        """Comparable forms of the brands, one of each, and the brands they are of."""
        found: dict[str, str] = {}
        for b in self.brands:
            found.setdefault(comparable(b), b)
        return Choices(list(found)), list(found.values())

    def strong(self, token: object) -> bool:
        """Whether a token is a brand, or one with a digit behind it."""
        own = compact(token)
        return own in self.by_plain or any(own[i].isdigit() and own[:i] in self.by_plain for i in range(1, len(own)))

    def tags(self, hint: object) -> set[str]:
        """Variants of up to four letters of the brand that a hint names."""
        name = self.key(hint) if hint else None
        return {i.variant for i in self.brands[name].items if i.variant != "PLAIN" and re.fullmatch("[A-Z]{1,4}", i.variant)} if name else set()


def attributes(items: list[Item]) -> tuple[set[str], set[str], set[str]]:
    """Variants, sub-variants and packs that there are; PLAIN always is."""
    known = lambda x: upper(x).strip() not in ("", "NAN", "NONE")
    return {"PLAIN"} | {upper(i.variant).strip() for i in items if known(i.variant)}, {"PLAIN"} | {upper(i.sub).strip() for i in items if known(i.sub)}, {i.pack.strip() for i in items if known(i.pack)}
