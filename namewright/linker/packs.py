"""Packs: where a name says one, how large it is, and combinations of doses."""

from __future__ import annotations

import re

from .lexicon import DEFAULT, Lexicon
from .words import NUMBER, repaired, squeezed, upper

Span = tuple[int, int]
_BY = rf"\b(\d+)\s*[X*×]\s*({NUMBER})"
COMBO_IN_TEXT = rf"(?<![\d./]){NUMBER}(?:/{NUMBER})+(?![\d./])"
_TABLETS = r"(?:TA|TABS?|TABLETS?|STRIPS?|CAPS?|CAPSULES?)"
_SIZED = re.compile(_BY + r"(?:\s*(?:ML|GM|MG|MCG|IU|G|L|KG|TA|TABS?|TABLETS?|CAPS?|CAPSULES?|STRIPS?))?")
_POSITIONS = [_SIZED, re.compile(r"\bX\s*\d+\b"), re.compile(r"\b\d+[STCP]\b"), re.compile(r"\b\d+\s+(?:S|T|PCS)\b")]
_COUNTED = re.compile(rf"(?<![\d.])(\d+)\s*{_TABLETS}\b")
_AFTER = re.compile(rf"\b{_TABLETS}\s*(\d+)\b")


def reasonable(value: object) -> bool:
    """A whole number from 1 to 100."""
    try:
        n = float(str(value).strip())
    except ValueError:
        return False
    return n.is_integer() and 0 < n <= 100


def pack_value(value: object) -> float | None:
    """a X b is a * b; else the first number."""
    text = upper(value).strip()
    if text in ("", "NAN", "NONE"):
        return None
    if found := re.search(r"(\d+)\s*[X*]\s*(\d+)", text):
        return float(int(found[1]) * int(found[2]))
    found = re.search(NUMBER, text)
    return float(found[0]) if found else None


def counted(text: str) -> list[re.Match]:
    """Counts of tablets, capsules or strips that can be packs."""
    return [m for m in _COUNTED.finditer(text) if reasonable(m[1])]


def pack_spans(text: str) -> list[Span]:
    """Where a text in upper case says packs; a count of tablets is one only where there is no other, and then the last."""
    spans = [m.span() for p in _POSITIONS for m in p.finditer(text)]
    return spans or [m.span() for m in counted(text)[-1:]]


def in_pack(span: Span, packs: list[Span]) -> bool:
    """Whether an end of the span lies in one of the packs."""
    return any(a <= span[0] < b or a < span[1] <= b for a, b in packs)


def _number(x: float) -> str:
    return str(int(x)) if x.is_integer() else str(x)


def _product(m: re.Match) -> str | None:
    a, b = float(m[1]), float(m[2])
    return _number(a * b) if a <= 10 and b <= 100 and a * b <= 500 else None


def pack_size(value: object, lexicon: Lexicon = DEFAULT) -> str:
    """The pack that a name states; the first rule that holds counts.

    strength X strips X 15; a X b; a X 1 X b; a X b with a unit; PACK OF n; n with S, T, C or P right behind it; n PCS; the
    last n TABLETS or TABLETS n; a volume or weight, never a dose.
    """
    text = repaired(value, lexicon)
    if re.search(rf"(?<![.\d]){NUMBER}\s*[X*×]\s*\d+\s*[X*×]\s*15\b", text):
        return "15"
    for m in re.finditer(_BY + r"\s*[STCP]?\b", text):
        if (size := _product(m)) is not None:
            return size
    if m := re.search(rf"\b\d+\s*[X*×]\s*1\s*[X*×]\s*({NUMBER})\s*[STCP]?\b", text):
        return _number(float(m[1]))
    if (m := re.search(_BY + r"(?:\s*(?:ML|GM|MG|MCG|IU|G|L|KG|TA|TABS?|TABLETS?|CAPS?|CAPSULES?|T|C))?\b", text)) and (size := _product(m)) is not None:
        return size
    for pattern in (r"\bPACK\s*(?:OF\s*)?(\d+)\b", r"(?<!\d)(\d+)(?=[STCP])", r"\b(\d+)\s+(?:S|T|PCS)\b"):
        if m := re.search(pattern, text):
            return m[1]
    around = [(m.start(), m[1]) for m in counted(text)] + [(m.start(), m[1]) for m in _AFTER.finditer(text) if reasonable(m[1])]
    if around:
        return max(around, key=lambda x: x[0])[1]
    m = re.search(rf"\b({NUMBER})\s*(?:ML|GM|G|L|KG)\b", text)
    return m[1] if m else ""


def pack_notation(value: object, lexicon: Lexicon = DEFAULT) -> str:
    """The pack as a name writes it."""
    text = repaired(value, lexicon)
    if m := re.search(_BY + r"(?=[A-Z]?\b)", text):
        tail = re.match(r"[STCP]|PCS?|AB", text[m.end() :])
        return f"{m[1]}X{m[2]}{tail[0] if tail else ''}"
    if m := re.search(_BY + r"\s*(PCS?)\b", text):
        return f"{m[1]}X{m[2]}{m[3]}"
    if m := re.search(r"\b(\d+)\s*([STCP])\b", text):
        return m[1] + m[2]
    m = re.search(rf"\b(\d+)\s*{_TABLETS}\b", text) or _AFTER.search(text)
    return f"{m[1]}T" if m else ""


def with_pack(product: str, pack: object) -> str:
    """The product's name and its pack, unless the name says a pack, count, dose or volume."""
    says = r"\d+[Xx*]\d+|\d+[STCP]|\d+PC|\d+NO|\d+\s*(?:ML|GM|MG|MCG|G|L|KG)\b|\d+\s*[TCSP]\b|\d+\s*[Xx]\s*\d+\s*[A-Z]"
    own = "".join(("" if pack is None else str(pack)).split())
    if re.search(says, product) or own.lower() in ("", "nan") or own.upper() in product.upper().replace(" ", ""):
        return product
    return f"{product} {own}"


def combination(value: object, lexicon: Lexicon = DEFAULT) -> str:
    """The first combination of doses, a/b or more, that isn't followed by a pack's X."""
    text = re.sub(r"\s*/\s*", "/", repaired(value, lexicon))
    found = re.search(rf"(?<![\d./])({NUMBER}(?:/{NUMBER})+)(?![\d./])(?![X*×])", text)
    return found[1] if found else ""


def has_combination(product: object, combo: object) -> bool:
    """Whether the product says the combination, not as part of longer numbers."""
    tight = lambda x: upper(x).replace(" ", "").replace("-", "")
    return bool(tight(combo)) and bool(re.search(rf"(?<![\d.]){re.escape(tight(combo))}(?![\d.])", tight(product)))


def without_packs(value: object, lexicon: Lexicon = DEFAULT) -> str:
    """The repaired name without the words that packs touch."""
    text = repaired(value, lexicon)
    packs = pack_spans(text)
    return squeezed(" ".join(m[0] for m in re.finditer(r"\S+", text) if not in_pack(m.span(), packs)))
