"""Dosage forms of names and products."""

from __future__ import annotations

import re
from functools import lru_cache

from .lexicon import DEFAULT, Lexicon
from .packs import in_pack, pack_spans
from .words import compact, repaired, upper

_INJECTED = ("AMP", "INJ", "ING", "VIAL", "PFS", "X4ML", "X2ML", "X1ML", "X5ML", "X10ML")


def forms_in_name(value: object, lexicon: Lexicon = DEFAULT) -> set[str]:
    return set(_forms(repaired(value, lexicon), lexicon))


@lru_cache(maxsize=1 << 10)
def _forms(text: str, lexicon: Lexicon) -> frozenset[str]:
    found = {form for form, pattern in lexicon.input_form_patterns if pattern.search(text)}
    if not found & {"SUSPENSION", "DROPS", "SOLUTION", "TONIC"} and re.search(r"\bSY\b", text) and re.search(r"\b\d+(?:\.\d+)?\s*ML\b", text):
        found.add("SUSPENSION")
    if any(re.search(rf"\b{re.escape(b)}\s+\d+MG\b", text) for b in lexicon.dosed_tablets) and not any(x in text for x in _INJECTED):
        found.add("TABLET")
    if {"TABLET", "CAPSULE"} <= found:  # one that only counts a pack isn't the form
        packs = pack_spans(text)
        only = {f: all(in_pack(m.span(), packs) for m in p.finditer(text)) for f, p in lexicon.input_form_patterns if f in ("TABLET", "CAPSULE")}
        if only["TABLET"] != only["CAPSULE"]:
            found.discard("TABLET" if only["TABLET"] else "CAPSULE")
    return frozenset(found)


@lru_cache(maxsize=1 << 16)
def forms_of_product(product: str, lexicon: Lexicon = DEFAULT) -> frozenset[str]:
    text = upper(product)
    return frozenset(form for form, pattern in lexicon.product_form_patterns if pattern.search(text))


def groups(forms, lexicon: Lexicon = DEFAULT) -> set[str]:
    return {lexicon.form_groups[f] for f in forms if f in lexicon.form_groups}


def share_group(one, two, lexicon: Lexicon = DEFAULT) -> bool:
    return bool(groups(one, lexicon) & groups(two, lexicon))


def coarse_forms(value: object, lexicon: Lexicon = DEFAULT) -> set[str]:
    """Forms whose spelling is anywhere in the compact text."""
    text = compact(value)
    return {form for form, spelled in lexicon.coarse_forms if any(s in text for s in spelled)}
