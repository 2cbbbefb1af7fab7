"""Narrowing of a brand's products to those that a name can mean.

Every step keeps the products' order and gives back what it was given (or what its docstring says) rather than nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from .catalogue import Item
from .forms import forms_in_name, forms_of_product, groups, share_group
from .lexicon import DEFAULT, Lexicon
from .packs import has_combination, pack_value
from .rank import by_name
from .words import bounded, is_dose, joined_thousands, repaired, tokens, upper, variant_key

Items = list[Item]


def keep_if_any(items: Items, hit: Callable[[Item], object]) -> Items:
    return [i for i in items if hit(i)] or items


def narrower(items: Items, hit: Callable[[Item], object]) -> Items:
    """What is hit, if that is some but not all."""
    return [i for i in items if hit(i)] or items


def by_compound(items: Items, compound: list[str]) -> Items:
    """Products with one of the compound tokens: one of letters and digits is one to three words, another begins a word or, if it begins none, may be any part of the name."""

    def hits(token: str) -> set[int]:
        key = variant_key(token)
        if re.fullmatch(r"[A-Z]+\d+|\d+[A-Z]+", token):
            return {k for k, own in enumerate(spelled) if any(key == "".join(own[i : i + n]) for n in (1, 2, 3) for i in range(len(own) - n + 1))}
        begun = {k for k, own in enumerate(spelled) if any("".join(own[i:]).startswith(key) for i in range(len(own)))} if key else set()
        return begun or {k for k, name in enumerate(names) if token in name or key in variant_key(name)}

    names = [upper(i.product).replace("-", " ").replace("_", " ") for i in items]
    spelled = [tokens(n) for n in names]
    found = set().union(*(hits(t) for t in compound if t)) if compound else set()
    return [i for k, i in enumerate(items) if k in found] or items


def by_abbreviation(items: Items, value: object, brand: object, lexicon: Lexicon = DEFAULT) -> Items:
    """For each word behind the brand: products with the one longer word that begins with it, unless some has the word itself."""
    own = upper(brand).replace("-", " ").strip()
    at = next(bounded(upper(value), own), None)
    if at is None or not items:
        return items
    skip = lexicon.skip | set(own.split())
    words = lambda i: [w for w in re.findall(r"\b[A-Z]{2,}\b", upper(i.product).replace("-", " ")) if w not in skip]
    for short in re.findall("[A-Z]{2,}", upper(value)[at + len(own) :]):
        said = {w for i in items for w in words(i)}
        longer = {w for w in said if w.startswith(short)}
        if short not in lexicon.skip and short not in said and len(longer) == 1:
            items = narrower(items, lambda i, w=next(iter(longer)): re.search(rf"\b{w}\b", upper(i.product).replace("-", " ")))
    return items


def by_exact_brand(items: Items, value: object, brand: object, lexicon: Lexicon = DEFAULT) -> Items:
    """Without products whose first word is the brand with more letters that the name doesn't have, if others are left."""
    first = upper(brand).replace("-", " ").split()[:1]
    if not first:
        return items
    said, own = set(re.findall("[A-Z]+", repaired(value, lexicon))), first[0]

    def glued(i: Item) -> bool:
        lead = (re.findall("[A-Z]+", upper(i.product)) or [""])[0]
        return lead != own and lead.startswith(own) and lead not in said and lead[len(own) :] not in said

    return keep_if_any(items, lambda i: not glued(i))


def half(text: object) -> bool:
    return bool(re.search(r"\b(?:SEMI|HALF)\b", upper(text)))


def by_half(items: Items, value: object, lexicon: Lexicon = DEFAULT) -> Items:
    """Half doses if the name says so, else the others."""
    wanted = half(repaired(value, lexicon))
    return keep_if_any(items, lambda i: half(i.product) == wanted)


def most_specific(variants: Iterable[str]) -> set[str]:
    """Without variants whose words are some of another's."""
    found = set(variants)
    words = {v: set(upper(v).split()) for v in found - {"PLAIN", ""}}
    kept = {v for v, own in words.items() if not any(own < other for other in words.values())}
    return found if len(words) <= 1 else kept | (found & {"PLAIN"})


def by_variant(items: Items, variants: Iterable[str], scope: Items | None = None) -> Items:
    """Products of the most specific variants, else of any of them, else those of the brand's scope, else plain ones."""
    found, exact = set(variants), most_specific(variants)
    of = lambda pool, wanted: [i for i in pool if i.variant.upper() != "PLAIN" and i.variant.upper() in wanted]
    plain = lambda pool: [i for i in pool if i.variant.upper() == "PLAIN"]
    tries = [of(items, exact), of(items, found), *([of(scope, exact | found)] if scope else []), plain(items), *([plain(scope)] if scope else [])]
    return next((t for t in tries if t), items)


def in_name(item: Item, dose: str) -> int:
    """How surely a product's name says a dose: 100 with a unit, 90 as a number but no pack, 75 behind a letter, 0 else."""
    name, own = upper(item.product), re.escape(dose)
    if re.search(rf"(?<![\d.]){own}\s*(?:MG|GM|ML|MCG|IU)\b", name):
        return 100
    if re.search(rf"(?<![\d.]){own}(?![\d.])", name):
        return 0 if re.search(rf"(?<![\d.]){own}\s*[X*×]", name) else 90
    return 75 if re.search(rf"[A-Z]{own}\b", name) else 0


def by_dose_in_name(items: Items, subs: Iterable[str]) -> Items:
    """Products whose names say one of the doses most surely, 75 at least."""
    doses = [s for s in subs if s != "PLAIN" and "/" not in s]
    scores = [max((in_name(i, d) for d in doses), default=0) for i in items]
    top = max(scores, default=0)
    return [i for i, s in zip(items, scores, strict=True) if s == top] if top >= 75 else items


def by_combination(items: Items, combos: set[str], value: object, lexicon: Lexicon = DEFAULT) -> Items | None:
    """Products of a combination; where none says it: of two parts against three the lowest middle part, else the first part that is a strength or in a name, else the last."""
    if said := [i for i in items if any(has_combination(i.product, c) for c in combos)]:
        return said
    split = [[p.strip() for p in c.split("/") if p.strip()] for c in sorted(combos)]
    parts = [{s[k] for s in split if k < len(s)} for k in range(max(map(len, split)))]
    longer = [i for i in items if i.sub.count("/") >= 2]
    middles = {i: float(m) for i in longer if re.fullmatch(r"\d+(?:\.\d+)?", m := i.sub.split("/")[1].strip())}
    if len(parts) == 2 and middles:
        return by_name([i for i in longer if middles.get(i) == min(middles.values())], value, lexicon)
    for own in parts:
        hits = [i for i in items if i.sub.upper() in own] or [i for i in items if any(re.search(rf"\b{re.escape(p)}\b", upper(i.product)) for p in own)]
        if hits:
            return by_name(hits, value, lexicon)
    return None


def by_strength(items: Items, subs: Iterable[str], value: object, lexicon: Lexicon = DEFAULT) -> Items:
    """Products of the strengths that a name states; without any, plain ones, else all."""
    found = set(subs)
    wanted = found - {"PLAIN"}
    numbers = {s for s in wanted if is_dose(s)}
    ordered = lambda pool: by_name(pool, value, lexicon)
    if (combos := {s for s in wanted if "/" in s}) and (hits := by_combination(items, combos, value, lexicon)):
        return hits
    words = {s for s in wanted if re.search("[A-Z]", s) and not is_dose(s)}
    if hits := [i for i in items if i.sub.upper() in words]:
        return ordered(by_dose_in_name(hits, found))
    plain = [i for i in items if i.sub.upper() == "PLAIN"]
    if hits := [i for i in items if i.sub.upper() in (wanted or found)]:
        forms = forms_in_name(value, lexicon)
        if not wanted and forms and (formed := [i for i in hits if (f := forms_of_product(i.product, lexicon)) & forms or share_group(f, forms, lexicon)]):
            return ordered(formed)
        if value and len({i.sub.strip() for i in hits if is_dose(i.sub)}) > 1:  # the strength is what stands first, the pack comes later
            text = repaired(value, lexicon)
            at = {s: m.start() if (m := re.search(rf"(?<![\d.]){re.escape(s)}(?![\d.])", text)) else 10**6 for s in {i.sub.strip() for i in hits}}
            first = min(n for s, n in at.items() if is_dose(s))
            hits = [i for i in hits if at[i.sub.strip()] == first] or hits
        return ordered(hits)
    if numbers:
        first = [i for i in items if "/" in i.sub and i.sub.split("/")[0].strip().upper() in numbers]
        if first and len(first) < len(items) and len({i.sub.upper() for i in first}) == 1:
            return ordered(first)
        if len(hits := by_dose_in_name(items, found)) < len(items):
            return ordered(hits)
        if plain and len(hits := by_dose_in_name(plain, found)) < len(plain):
            return hits
    return plain or items


def by_form(items: Items, forms: set[str], lexicon: Lexicon = DEFAULT) -> Items:
    """Products of one of the forms, else without those of another group."""
    if not forms:
        return items
    exact = [i for i in items if forms_of_product(i.product, lexicon) & forms]
    return exact or (keep_if_any(items, lambda i: i in compatible([i], forms, lexicon)) if groups(forms, lexicon) else items)


def compatible(items: Items, forms: set[str], lexicon: Lexicon = DEFAULT) -> Items:
    """Products whose form's group is one of the forms', or that name none."""
    wanted = groups(forms, lexicon)
    return [i for i in items if not wanted or not (own := groups(forms_of_product(i.product, lexicon), lexicon)) or own & wanted]


def again_if_incompatible(step: Callable[[Items], Items], items: Items, forms: set[str], lexicon: Lexicon = DEFAULT) -> Items:
    """A step's result; if the name's form rules all of it out, the step's result on products of fitting form."""
    out = step(items)
    if forms and out and not compatible(out, forms, lexicon) and (pool := compatible(items, forms, lexicon)):
        return step(pool) or out
    return out


def by_named_dose(items: Items, value: object, lexicon: Lexicon = DEFAULT) -> Items:
    """Products whose names have one of the name's doses with its unit."""
    said = re.findall(r"(\d+(?:\.\d+)?)\s*(MG|MCG|GM|IU|ML|UNIT)\b", joined_thousands(repaired(value, lexicon)))
    return narrower(items, lambda i: any(re.search(rf"(?<![\d.]){re.escape(n)}\s*{u}", joined_thousands(upper(i.product))) for n, u in said)) if said else items


def by_pack(items: Items, pack: str) -> Items:
    """Without a pack in the name unpacked products, else the one of smallest pack.  With one: equal packs, else unpacked, else the closest if it is close."""
    sizes = [(i, pack_value(i.pack)) for i in items]
    bare, sized = [i for i, n in sizes if n is None], [(i, n) for i, n in sizes if n is not None]
    if not pack:
        return bare or [i for i, _ in sorted(sized, key=lambda x: x[1])[:1]] or items
    try:
        wanted = float(pack)
    except ValueError:
        return bare or items
    if equal := [i for i, n in sized if n == wanted]:
        return equal
    if not bare and sized:
        item, n = min(sized, key=lambda x: abs(x[1] - wanted))
        if abs(n - wanted) <= max(20, 0.5 * wanted):
            return [item]
    return bare or items


def ambiguous_strength(items: Items, subs: Iterable[str]) -> bool:
    """Whether products of one variant differ in combinations of which the name says no more than the first part, if that."""
    there = {upper(i.sub).strip() for i in items} - {"", "PLAIN"}
    combos = {s for s in there if "/" in s}
    if len(there) <= 1 or not all(map(is_dose, there)) or len({i.variant.upper() for i in items}) != 1 or len(combos) < 2 or any("/" in s for s in subs):
        return False
    first, said = {c.split("/")[0].strip() for c in combos}, set(subs) - {"PLAIN"}
    return len(first) == 1 or bool(said and said <= first)


def letters_of(compound: list[str]) -> set[str]:
    return {x for t in compound if (x := re.sub(r"\d", "", t))}


def by_pin(items: Items, brand: str, value: object, raw: object, lexicon: Lexicon = DEFAULT) -> Items:
    """The product that a brand's pin names for what the name has, if it is there."""
    text, said = repaired(value, lexicon), upper(raw)
    code = next((p.code for p in lexicon.pins if p.brand == brand and all(re.search(x, text) for x in p.include) and not any(re.search(x, text) or re.search(x, said) for x in p.exclude)), "")
    return keep_if_any(items, lambda i: i.code == code) if code else items


def by_kept_variant(items: Items, brand: str, value: object, compound: list[str], lexicon: Lexicon = DEFAULT) -> Items:
    """Products of the one variant of those a brand keeps that stands right behind it."""
    kept = set(lexicon.kept_variants.get(brand, ())) & set(re.findall("[A-Z]+", repaired(value, lexicon)))
    return keep_if_any(items, lambda i: i.variant in kept) if len(kept) == 1 and kept & set(compound) else items


def by_scope(items: Items, brand: str, value: object, lexicon: Lexicon = DEFAULT) -> Items:
    """Without products that a brand's scopes rule out for this name."""
    text = repaired(value, lexicon)
    for s in lexicon.scopes:
        found = all(re.search(p, text) for p in s.patterns)
        if s.brand == upper(brand) and s.codes & {i.code for i in items} and found != s.only:
            items = keep_if_any(items, lambda i, s=s: i.code not in s.codes)
    return items


def by_flavor(items: Items, scope: Items, brand: str, value: object, raw: object, variants: set[str], subs: set[str], pack: str, lexicon: Lexicon = DEFAULT) -> Items:
    """For brands that come in flavours: the flavour that a name says (with its pack, else unpacked), else by pack, else the usual flavour."""
    if upper(brand) not in lexicon.flavored:
        return items
    word, usual = lexicon.flavored[upper(brand)]
    text = repaired(raw or value, lexicon)
    pool = [i for i in scope or items if variant_key(i.variant) == word or word[:6] in upper(i.product)]
    if not pool:
        return items
    said = {lexicon.flavors[w] for w in [*re.findall("[A-Z]+", text), *re.findall(r"\(([A-Z]{1,9})\)", upper(raw))] if w in lexicon.flavors}
    said |= {f for f in said if f in text}
    sizes = {n for i in pool if (n := pack_value(i.pack)) is not None}
    if not pack and len(hit := {float(n) for n in re.findall(r"\d+(?:\.\d+)?", text)} & sizes) == 1:
        pack = str(hit.pop())
    fits = lambda own: [i for i in own if pack and pack_value(i.pack) == float(pack)]
    if said and (own := [i for i in pool if i.variant.upper() == min(said)]):
        return fits(own) or [i for i in own if not i.pack.strip()] or own
    doses, others = subs - {"PLAIN"}, {v for v in variants if v not in ("", "PLAIN")}
    if not pack:
        base = [i for i in pool if not i.pack.strip() and i.sub.upper() == "PLAIN"]
        return base if base and not doses and (word[:6] in text or word in others) else items
    own = fits(pool)
    if own and not doses and others <= {word}:
        return [i for i in own if i.sub.upper() == usual] or own
    return own or items


