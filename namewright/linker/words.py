"""Cleaning of names: normal forms, spelling, numbers, and what can be taken out of a name before it is linked."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

from .lexicon import DEFAULT, Lexicon

NUMBER = r"\d+(?:\.\d+)?"
COMBO = rf"{NUMBER}(?:/{NUMBER})*"
_ALNUM = re.compile(r"[A-Z0-9]+")
_MAGNITUDE = {"K": 1_000, "M": 1_000_000}


def upper(value: object) -> str:
    return "" if value is None else str(value).upper()


def squeezed(text: str) -> str:
    return " ".join(text.split())


def compact(value: object) -> str:
    """Letters and digits only."""
    return "".join(_ALNUM.findall(upper(value)))


def tokens(value: object) -> list[str]:
    return _ALNUM.findall(upper(value))


def letters(value: object) -> str:
    return "".join(c for c in upper(value) if "A" <= c <= "Z")


def comparable(value: object) -> str:
    """+ and & as words, a lone X and all punctuation gone, dotted pairs of initials joined."""
    text = upper(value).strip().replace("+", " PLUS ")
    text = re.sub(r"\bX\b", " ", re.sub(r"[-/*]", " ", text)).replace("&", " AND ")
    return " ".join(_ALNUM.findall(re.sub(r"\b([A-Z])\.([A-Z])\b", r"\1\2", text)))


def variant_form(value: object) -> str:
    return " ".join(_ALNUM.findall(upper(value).replace("+", " PLUS ")))


def variant_key(value: object) -> str:
    return variant_form(value).replace(" ", "")


def bounded(text: str, part: str) -> Iterator[int]:
    r"""The places of \bpart\b.  A pattern for each brand would drive all others out of the cache of patterns."""
    word = lambda i: 0 <= i < len(text) and (text[i].isalnum() or text[i] == "_")
    at = text.find(part) if part else -1
    while at >= 0:
        end = at + len(part)
        hit = word(at - 1) != word(at) and word(end - 1) != word(end)
        if hit:
            yield at
        at = text.find(part, end if hit else at + 1)


def without_bounded(text: str, part: str, most: int | None = None) -> str:
    r"""A text without \bpart\b, all of them or the first ones."""
    out, done = [], 0
    for at in islice(bounded(text, part), most):
        out.append(text[done:at])
        done = at + len(part)
    return "".join(out) + text[done:]


def full_strength(token: str) -> str:
    """1.5K is 1500, 2M is 2000000; any other token stays."""
    if found := re.fullmatch(rf"({NUMBER})([KM])", upper(token)):
        return str(int(float(found[1]) * _MAGNITUDE[found[2]]))
    return token


def full_strengths(words) -> set[str]:
    return {full_strength(w) for w in words}


def strengths_in_compact(text: str) -> str:
    """The same within a compact text, where a digit or the end follows."""
    return re.sub(rf"({NUMBER})([KM])(?=\d|$)", lambda m: full_strength(m[0]), upper(text))


def joined_tokens(value: object) -> set[str]:
    """Two and three neighbours written as one."""
    own = tokens(value)
    return {"".join(own[i : i + n]) for n in (2, 3) for i in range(len(own) - n + 1)}


def skeleton(value: object) -> str:
    own = letters(value)
    return "".join(c for c in own if c not in "AEIOU") or own


def joined_thousands(text: object) -> str:
    """10 000 is 10000, until nothing is left to join."""
    text = "" if text is None else str(text)
    while (out := re.sub(r"\b(\d{1,3})\s+(\d{3})\b", r"\1\2", text)) != text:
        text = out
    return text


def plain_upper(value: object) -> str:
    """For people and rerankers: upper case, initials joined, - as blank, + as PLUS."""
    return squeezed(re.sub(r"\b([A-Z])\.([A-Z])\b", r"\1\2", upper(value)).replace("-", " ").replace("+", " PLUS "))


def without_repeats(text: object) -> str:
    """Drops a word that repeats the one before it in any case, then a pair, then a triple, that repeats the one before it."""
    words = [] if text is None else str(text).split()
    kept = [w for i, w in enumerate(words) if i == 0 or w.upper() != words[i - 1].upper()]
    for n in (2, 3):
        out, at = [], 0
        while at < len(kept):
            again = len(kept[at : at + n]) == n and kept[at : at + n] == kept[at + n : at + 2 * n]
            out += kept[at : at + n] if again else kept[at : at + 1]
            at += 2 * n if again else 1
        kept = out
    return " ".join(kept)


def without_tags(text: object, tags: frozenset[str] | set[str] = frozenset()) -> str:
    """Drops short words in parentheses; one of `tags` stays, as a word, if the name doesn't say it elsewhere."""
    text = "" if text is None else str(text)
    pattern = re.compile(r"\(\s*([A-Za-z]{1,4})\s*\)")
    outside = set(tokens(pattern.sub(" ", text))) if tags else set()
    keeps = lambda tag: tag in tags and tag not in outside
    return squeezed(pattern.sub(lambda m: f" {m[1].upper()} " if keeps(m[1].upper()) else " ", text))


def repaired(value: object, lexicon: Lexicon = DEFAULT) -> str:
    """Spellings in one way, thousands written out, numbers of a combination joined by /, packs cut from strengths."""
    return _repaired(upper(value), lexicon)


@lru_cache(maxsize=1 << 10)
def _repaired(text: str, lexicon: Lexicon) -> str:
    """One link asks for the same text many times."""
    text = text.replace("+", " PLUS ")
    text = lexicon.rewrite_pattern.sub(lambda m: lexicon.spelled[m[0]], text)

    def thousand(m: re.Match) -> str:
        n = float(m[1]) * 1000
        return str(int(n)) if n.is_integer() else str(n)

    text = re.sub(rf"\b({NUMBER})\s*K\b", thousand, text)
    text = re.sub(r"(?<=\d)[/\\-](?=\d)", "/", text)
    text = re.sub(r"\b(\d+)(10|15|20|30|14|28)S\b", lambda m: f"{m[1]} {m[2]}S" if int(m[1] + m[2]) > 100 else m[0], text)
    return squeezed(text)


def match_word(token: object, lexicon: Lexicon = DEFAULT) -> str:
    token = upper(token).strip()
    return lexicon.match_words.get(token, token)


def match_words(text: object, lexicon: Lexicon = DEFAULT) -> set[str]:
    """A text's words for comparison with variants: no numbers, packs, doses, units."""
    number = re.compile(rf"{NUMBER}|\d+[X*]\d+(?:MG|GM|ML|MCG|IU|UNIT|G|L|KG)?|\d+(?:MG|GM|ML|MCG|IU|UNIT|G|L|KG)|\d+[STCP]|X|PACK|OF")
    found = {match_word(t, lexicon) for t in tokens(repaired(text, lexicon)) if not number.fullmatch(t)}
    return found - set(lexicon.units)


def clean(value: object, default: str = "") -> str:
    """Missing in any of its spellings is the default."""
    if value is None or value != value:  # noqa: PLR0124  nan
        return default
    value = str(value).strip()
    return default if value in ("nan", "NaN", "None") else value


def clean_code(value: object) -> str:
    return clean(value)


def clean_attribute(value: object, default: str = "PLAIN") -> str:
    return clean(value).upper() or default


def dose_of(value: object) -> str:
    """The number, or combination, that is all of the value but for a unit or form."""
    text = re.sub(r"\s*(?:MG|GM|ML|MCG|G|M|IU|UNIT|TAB|TABS|TABLET|TABLETS|INJ|INJECTION)\s*$", "", clean_attribute(value, "")).strip()
    return text if re.fullmatch(COMBO, text) else ""


def is_dose(value: object) -> bool:
    return bool(re.fullmatch(COMBO, upper(value).strip()))


def dose_variant(value: object) -> str:
    """The number that a variant is but for a tag: 10 000 - PFS is 10000."""
    text = re.sub(r"[\s\-]*(?:PFS|IU|UNIT|MG|MCG|ML|GM)\.?$", "", joined_thousands(upper(value).strip())).strip()
    return text if re.fullmatch(NUMBER, text) else ""


def product_code(value: object) -> str:
    """Blank and zero are 0, numbers lose their fraction, other codes stay."""
    text = clean(value)
    if text.upper() in ("", "NAN", "NONE"):
        return "0"
    try:
        number = float(text)
        return str(int(number)) if abs(number) < 1e18 else text
    except ValueError:
        return text


def brand_query(value: object, lexicon: Lexicon = DEFAULT) -> str:
    """The words before the first form, unit or number; a first word that is glued to a number gives its letters."""
    out: list[str] = []
    stops = lexicon.hints | set(lexicon.units) | set("PACK OF PCS PC NOS NO VIAL AMP AMPS PFS SYR".split())
    for token in re.findall(r"[A-Z0-9.]+", repaired(value, lexicon)):
        if token in stops or re.search(r"\d", token):
            glued = re.match(r"[A-Z]{2,}(?=\d)", token)
            return glued[0] if glued and not out and token not in stops else " ".join(out)
        out.append(token)
    return " ".join(out)


def spaced_pattern(brand: object) -> str:
    """A pattern of the brand's characters with blanks and hyphens between them, not within a word."""
    own = compact(brand)
    return rf"(?<![A-Z0-9]){r'[\s\-]*'.join(own)}(?![A-Z0-9])" if own else ""


def removable_brand(brand: object, variants=frozenset(), lexicon: Lexicon = DEFAULT) -> str:
    """The brand without those of its later words that are forms or variants."""
    own = re.findall(r"[A-Z0-9]+", upper(brand).replace("+", " PLUS "))
    if len(own) <= 1:
        return upper(brand).strip()
    keys = {variant_key(v) for v in variants or () if v and upper(v) != "PLAIN"}
    said = lambda i: own[i] in lexicon.hints or own[i] in keys or (i + 1 < len(own) and own[i] + own[i + 1] in keys)
    return " ".join([own[0]] + [w for i, w in enumerate(own) if i and not said(i)])


def without_brand(text: object, brand: object, variants=frozenset(), lexicon: Lexicon = DEFAULT) -> str:
    """A name without its brand: as words with blanks or hyphens between them, then wherever it is written so, else spaced out."""
    text = upper(text).strip()
    own = removable_brand(brand, variants, lexicon).replace("-", " ").strip() if brand else ""
    if not own:
        return squeezed(text)
    loose = r"[-\s]+".join(map(re.escape, own.split()))
    first = without_bounded(text, own, 1) if own.split() == [own] else re.sub(rf"\b{loose}\b", "", text, count=1)
    out = without_bounded(first.strip(), own).strip()
    if out == text and (pattern := spaced_pattern(own)):
        out = re.sub(pattern, "", text, count=1)
    return squeezed(out)


def flavors_of(text: object, variants, lexicon: Lexicon = DEFAULT) -> set[str]:
    text = upper(text)
    return {f for w, f in lexicon.flavors.items() if f in variants and w in text}
