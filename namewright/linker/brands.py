"""Which brand a name is of: repairs that need the catalogue's brands, and the search for the best one."""

from __future__ import annotations

import re

from ..functions.similarity import jaro_winkler, ratio, token_sort
from .catalogue import Brand, Catalogue, Item
from .lexicon import DEFAULT, Lexicon
from .words import brand_query, comparable, compact, full_strengths, joined_tokens, letters, match_word, spaced_pattern, squeezed, strengths_in_compact, tokens, upper

#: Fixed limits: ratio of the whole query, of its words, Jaro-Winkler, and edits.
SURE, SIMILAR, ALIKE, EDITS, RECOVERED_EDITS = 99, 80, 0.85, 2, 1
FAR = 10**6
_UNIT, _FORM = "MG|MCG|ML|GM|IU", "TABLETS|TABLET|TABS|TAB|CAPSULES|CAPSULE|CAPS|CAP|INJECTION|INJ|SYRUP|SYP|DROPS|GRANULES|SUSPENSION"


def levenshtein(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def like_maker(token: object, lexicon: Lexicon = DEFAULT) -> bool:
    """Whether a token is a maker's name, as scanners may have read it (0 for O)."""
    own = letters(upper(token).replace("0", "O"))
    return len(own) >= 3 and any(own[:3] == m[:3] and (m.startswith(own) or own.startswith(m) or levenshtein(own, m) <= 3) for m in lexicon.makers)


def without_maker(text: object, catalogue: Catalogue) -> str:
    """Drops a maker's name, apart or glued on by digits, in front of what surely is a brand."""
    words = ("" if text is None else str(text)).split()
    if not words:
        return ""
    first, like = words[0].upper(), lambda t: like_maker(t, catalogue.lexicon)
    if (m := re.fullmatch(r"([A-Z]{2,5}\d+)([A-Z]{3,})", first)) and like(m[1]) and catalogue.strong(m[2]):
        return " ".join([m[2], *words[1:]])
    if len(words) > 1 and like(first) and not catalogue.strong(first) and catalogue.strong(words[1]):
        return " ".join(words[1:])
    return str(text).strip()


def split_brand(token: str, catalogue: Catalogue) -> str:
    """Cuts a token behind the longest brand of four letters or more that its letters begin with; a hyphen there goes."""
    lead = re.match("[A-Za-z]*", token)[0].upper()
    n = next((n for n in range(len(lead), 3, -1) if lead[:n] in catalogue.long_letters), 0)
    if not n or n == len(token):
        return token
    return f"{lead if n == len(lead) else token[:n]} {token[n:].lstrip('-')}"


def split_variant(token: str, variants: frozenset[str], subs: frozenset[str]) -> str:
    """Cuts a token that is a variant and a sub-variant."""
    own = token.upper()
    if token.isalpha() and len(own) >= 4 and own not in variants and own not in subs:
        for i in range(2, len(own) - 1):
            if own[:i] in variants and own[i:] in subs:
                return f"{token[:i]} {token[i:]}"
    return token


def unglued(text: object, catalogue: Catalogue) -> str:
    """A name whose words scanning has run together, or cut, word by word again: noise, then the brand, then the rest."""
    text = "" if text is None else str(text)
    for pattern, to in ((r"[Xx]{2,}(?=\s*-{2,})", ""), (r"(?<!\S)[Xx]{2,}(?!\S)", " "), (r"\s*-+\s*$", ""), (r"(\d)\.\s+(\d)", r"\1.\2")):
        text = re.sub(pattern, to, text)
    words = text.split()
    if not words:
        return squeezed(text)
    if len(words) > 1 and len(words[0]) == 1 and words[0].isalpha() and catalogue.strong(words[0] + words[1]):
        words[:2] = [words[0] + words[1]]
    words[0] = split_brand(words[0], catalogue)
    variants, subs = catalogue.words
    out = []
    for word in " ".join(words).split():
        # the longest brand first, so that the order of brands doesn't matter
        cut = next((n for n in range(min(len(word) - 1, catalogue.longest), 0, -1) if word[:n] in catalogue.by_plain and (word[n:] in variants or word[n:] in subs)), 0)
        out += [word[:cut], word[cut:]] if cut else [word]
    text = " ".join(out)
    for pattern, to in ((r"\bIN[- ](\d+)", r"INJ \1"), (r"\bSY[- ](\d+)", r"SYP \1"), (r"\bSUSP[- ](\d+)", r"SUSPENSION \1")):
        text = re.sub(pattern, to, text)
    first, *rest = text.split()
    text = " ".join([first, *(split_variant(w, variants, subs) for w in rest)])
    for pattern, to in (
        (r"\b(AMPOULEP?|AMPS?)(\d)", r"\1 \2"), (r"\bM(\d+)FORT(?:E|S?)\b", r"M \1 FORTE"), (r"\bTRIO\s*F\b", "TRIO FORTE"),
        (rf"(?i)(\d)\s*({_UNIT})({_FORM})", r"\1 \2 \3"), (r"(?<=[A-WYZa-wyz])(?=\d)", " "), (rf"(?i)(\d)({_FORM})\b", r"\1 \2"),
    ):
        text = re.sub(pattern, to, text)
    return squeezed(text)


def is_part(query: object, candidate: object) -> bool:
    """Whether the candidate's letters are a part, not all, of the query's: another, shorter brand."""
    q, c = letters(query), letters(candidate)
    return bool(c) and c != q and c in q


def candidates(text: str, catalogue: Catalogue) -> list[Brand]:
    """Brands that can be in a text, in the catalogue's order: by a first word, by neighbours written as one, by how the text begins."""
    found = {b.name: b for t in set(tokens(text)) for b in catalogue.by_first.get(t, [])}
    for t in full_strengths(tokens(text)):
        found |= {b.name: b for b in catalogue.by_first.get(t, [])}
    for run in re.findall(r"[A-Z0-9]+(?:[\s\-]+[A-Z0-9]+)*", text):
        own = re.findall("[A-Z0-9]+", run)
        for i in range(len(own)):
            joined = ""
            for t in own[i:]:
                joined += t
                if len(joined) > catalogue.longest:
                    break
                found |= {b.name: b for b in catalogue.by_plain.get(joined, [])}
    start = strengths_in_compact(compact(text))
    for n in range(1, min(len(start), catalogue.longest + 8) + 1):
        if n == len(start) or start[n].isdigit():
            found |= {b.name: b for b in catalogue.by_compact.get(start[:n], [])}
    return sorted(found.values(), key=lambda b: catalogue.order[b.name])


def begins(start: str, brand: Brand) -> bool:
    rest = start[len(brand.compact) :]
    return bool(brand.compact) and start.startswith(brand.compact) and (not rest or rest[0].isdigit())


def fit(brand: Brand, text: str, words: set[str], start: str) -> int | None:
    """How well a brand is in a text: 4 spaced out, 3 in words or at the start, 2 all its words, 1 in part of words, 0 its first word."""
    if brand.pattern.search(text):
        return 3 if brand.words <= words else 1
    if (pattern := spaced_pattern(brand.name)) and re.search(pattern, text):
        return 4
    if begins(start, brand):
        return 3
    if brand.words <= words:
        return 2
    return 0 if brand.first and brand.first in words else None


def potential_brands(value: object, catalogue: Catalogue) -> list[tuple[str, int]]:
    """Brands in a name with how well they fit, best first, the shorter of equals first."""
    text = upper(value)
    words, start = full_strengths(re.findall(r"\b[A-Z0-9]+\b", text)), strengths_in_compact(compact(text))
    found = [(b.name, f) for b in candidates(text, catalogue) if (f := fit(b, text, words, start)) is not None]
    return sorted(found, key=lambda x: (-x[1], len(x[0])))


def place(brand: Brand, text: str, start: str) -> int:
    if brand.text and (m := brand.pattern.search(text)):
        return m.start()
    at = start.find(brand.compact) if brand.compact else -1
    return at if at >= 0 else FAR


def promoted(value: object, brand: str, catalogue: Catalogue) -> str | None:
    """The one longer brand whose next word and the name's next word begin alike: CORA MET is of CORA METO."""
    own = upper(brand).replace("-", " ").strip()
    m = re.search(rf"\b{re.escape(own)}\b[\s\-]*([A-Z]{{2,}})\b", upper(value)) if own else None
    if not m or m[1] in catalogue.lexicon.skip:
        return None
    longer = []
    for b in catalogue.by_first.get((re.findall(r"[A-Z0-9]+", own) or [""])[0], []):
        rest = b.text[len(own) + 1 :].split() if b.text.startswith(own + " ") else []
        if rest and len(rest[0]) >= 2 and (rest[0].startswith(m[1]) or m[1].startswith(rest[0])):
            longer.append(b.name)
    return longer[0] if len(longer) == 1 else None


def related(brand: str, value: object, catalogue: Catalogue) -> list[str]:
    """The brand, and those of its root whose other words the name has or that only name a form."""
    own = upper(brand).replace("-", " ").strip()
    words = full_strengths(re.findall(r"\b[A-Z0-9]+\b", upper(value)))
    found = []
    for b in catalogue.by_first.get((re.findall(r"[A-Z0-9]+", own) or [""])[0], []):
        if b.text == own:
            found.append(b.name)
        elif b.text.startswith(own + " "):
            if b.words - full_strengths(own.split()) - catalogue.lexicon.skip <= words:
                found.append(b.name)
        elif b.first and b.first == own.split()[0]:
            extra = full_strengths(b.text.split()[1:]) - catalogue.lexicon.skip
            if extra and extra <= words:
                found.append(b.name)
    return found


def family(brand: str, value: object, catalogue: Catalogue) -> list[Item]:
    return [i for b in related(brand, value, catalogue) for i in catalogue.brands[b].items]


def alike(value: object, catalogue: Catalogue) -> str | None:
    """The brand that is most like the name's words where none is in it; none if it is a part of them or too many edits away."""
    lexicon, text = catalogue.lexicon, upper(value).replace("-", " ")
    query = comparable(brand_query(value, lexicon))
    root, long = query.split()[:1], [t for t in query.split() if len(t) >= 4]
    allowed = catalogue.single_words.copy()
    for first in {text[i : i + n] for i in range(len(text)) for n in range(1, min(catalogue.longest_first, len(text) - i) + 1)}:
        allowed[catalogue.of_words.get(first, [])] = True
    allowed = allowed if allowed.any() else None
    best = catalogue.names.best(query, ratio, SURE, allowed) if query else []
    tries = [(q, token_sort, SIMILAR) for q in (query, *root, *long, comparable(value))] + [(q, jaro_winkler, ALIKE) for q in (query, *root, *long)]
    for q, scorer, cutoff in tries:
        if not best and q:
            best = catalogue.names.best(q, scorer, cutoff, allowed)
    if not best:
        return None
    found, said = catalogue.names.texts[best[0][1]], brand_query(value, lexicon)
    near = [levenshtein(compact(q), compact(found)) for q in (said, *root, *long) if compact(q)]
    if is_part(said, found) or (near and min(near) > EDITS):
        return None
    return promoted(value, found, catalogue) or found


def best_brand(value: object, catalogue: Catalogue) -> str | None:
    """The brand that a name is of: of those in it without words that the name lacks the first, the longer of equals; else the one most like it."""
    said = potential_brands(value, catalogue)
    text = upper(value).replace("-", " ")
    words, start, joins = full_strengths(re.findall(r"\b[A-Z0-9]+\b", text)), strengths_in_compact(compact(value)), joined_tokens(value)
    whole = [b for name, _ in said if begins(start, b := catalogue.brands[name]) or all(compact(w) in joins for w in b.words - words)]
    if whole:
        first = min(whole, key=lambda b: (place(b, text, start), -len(b.name))).name
        return promoted(value, first, catalogue) or first
    return None if said else alike(value, catalogue)


def nearest_brands(value: object, catalogue: Catalogue, most: int = 3) -> list[tuple[str, float]]:
    """Brands most like the name's words, with their scores, but parts of them."""
    said = brand_query(value, catalogue.lexicon)
    query = comparable(said) or comparable(value)
    if not query:
        return []
    choices, names = catalogue.norms
    return [(names[i], round(score, 1)) for score, i in choices.best(query, token_sort, 0.0, most=most) if not is_part(said, names[i])]


def within_edits(value: object, brands: list[str], most: int = RECOVERED_EDITS, lexicon: Lexicon = DEFAULT) -> tuple[str | None, int | None]:
    """Of some brands the one with fewest edits from the name's words, if they are at most `most`; and the fewest."""
    query = compact(brand_query(value, lexicon))
    edits = [(levenshtein(query, compact(b)), i) for i, b in enumerate(brands) if compact(b)] if query else []
    if not edits:
        return None, None
    n, i = min(edits)
    return (brands[i] if n <= most else None), n


def unknown_words(value: object, brand: str, variants, subs, items: list[Item], lexicon: Lexicon = DEFAULT) -> list[str]:
    """Words behind the brand, before the first number or form, that the brand's products don't know; and a lone SEMI or HALF before it."""
    text, own = upper(value).replace("-", " "), upper(brand).replace("-", " ").strip()

    def found(needle: str) -> int:
        at = text.find(needle) if needle else -1
        while at >= 0 and (text[max(0, at - 1) : at].isalnum() or text[at + len(needle) : at + len(needle) + 1].isalnum()):
            at = text.find(needle, at + 1)
        return at

    first, query = own.split()[:1], brand_query(value, lexicon).split()[:1]
    at = found(own)
    tail = next((text[i + len(n) :] for n in (own, *first, *query) if (i := found(n)) >= 0), "")
    known = lexicon.skip | {"PLAIN"} | {upper(v) for v in variants or ()} | {upper(s) for s in subs or ()}
    named = {w for i in items for w in re.findall("[A-Z]+", upper(i.product))}
    longer = (named | known) - {"PLAIN"} - lexicon.hints
    spelled, out = tokens(tail), []
    stem = letters(own)
    for k, token in enumerate(spelled):
        if token in lexicon.hints or any(c.isdigit() for c in token):
            break
        joins = [spelled[k - 1] + token] * (k > 0) + [token + w for w in spelled[k + 1 : k + 2]]
        if token in known or match_word(token, lexicon) in known or token in named or stem + token in named or any(j in known or j in named for j in joins):
            continue
        if len(token) < 3 or not any(w != token and w.startswith(token) for w in longer):
            out.append(token)
    if at > 0:
        out += [w for w in dict.fromkeys(re.findall("[A-Z]+", text[:at])) if w in ("SEMI", "HALF") and w not in named and w not in out]
    return out
