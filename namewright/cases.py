"""Queries of the linker's single operators, over inputs whose right result is known by how they are made.

A case has the operator's arguments, as SQL over the table `part`, and the result, as SQL of its own: Spark builds the
arguments and applies the operator, the oracle only ever builds results.  Part k is input to case k modulo their number.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import similarity as sim
from .linker import attributes as A
from .linker import brands as B
from .linker import catalogue as C
from .linker import classify as K
from .linker import decide as D
from .linker import forms as O
from .linker import narrow as N
from .linker import packs as P
from .linker import rank as R
from .linker import words as W
from .linker.lexicon import DEFAULT, Exception_, Family, Lexicon, Pin, Scope
from .linker.scores import Choices
from .shipping import ship, tasks

#: Letters that tell family number f: brands of ten letters, unlike each other in several of them.
_C, _V = "'BCDFGHJKLMNPRSTV'", "'AEIOU'"
_CODE = "substr({c}, cast({f} % 16 as int) + 1, 1) || substr({v}, cast(floor({f} / 16) as int) % 5 + 1, 1) || substr({c}, cast(floor({f} / 80) as int) % 16 + 1, 1) || substr({v}, cast(floor({f} / 1280) as int) % 5 + 1, 1) || substr({c}, cast(floor({f} / 6400) as int) % 16 + 1, 1)"
BRAND = "(" + _CODE.format(c=_C, v=_V, f="f") + " || " + _CODE.format(c=_C, v=_V, f="((f * 7919 + 4321) % 102400)") + ")"
#: k: the part, f: its family of eight products, s: a strength, d: twice it, h: a hundred more, b: the family's brand.
_FIELDS = {"b": BRAND, "s": "cast(p_size as string)", "d": "cast(p_size * 2 as string)", "h": "cast(p_size + 100 as string)"}
PARTS = f"(select p_partkey as k, f, {', '.join(f'{x} as {n}' for n, x in _FIELDS.items())} from (select p_partkey, p_size, cast(floor(p_partkey / 8) as bigint) as f from part) q) p"
#: The family: code ending, product, pack, variant, sub-variant.
PRODUCTS = [
    ("1", "5 TABLET", "", "PLAIN", "5"), ("2", "10 TABLET", "", "PLAIN", "10"), ("3", "FORTE 10 TABLET", "", "FORTE", "10"), ("4", "XR 10 TABLET", "1X15", "XR", "10"),
    ("5", "XR 10 TABLET", "1X10", "XR", "10"), ("6", "AM 5/20 TABLET", "", "AM", "5/20"), ("7", "SYRUP", "100 ML", "PLAIN", "PLAIN"), ("8", "DS SYRUP", "60 ML", "DS", "PLAIN"),
]
FAMILY = "(" + " || ';' || ".join(f"'{c}|' || b || ' {p}|{k}|{v}|{s}'" for c, p, k, v, s in PRODUCTS) + ")"


@lru_cache(maxsize=1 << 10)
def items(text: str) -> tuple[C.Item, ...]:
    """code|product|pack|variant|sub;... as products."""
    return tuple(C.Item(p, k, v, s, c) for c, p, k, v, s in (x.split("|") for x in text.split(";"))) if text else ()


@lru_cache(maxsize=1 << 8)
def brands(text: str, makers: str = "") -> C.Catalogue:
    """brand:products/... as a catalogue."""
    rows = []
    for part in text.split("//"):
        name, _, own = part.partition(":")
        rows += [(name, i.product, i.pack, i.variant, i.sub, i.code) for i in items(own)] if own else [(name, name + " 1 TABLET", "", "", "1", name)]
    return C.Catalogue.of_rows(rows, Lexicon(makers=tuple(makers.split())) if makers else DEFAULT)


def codes(found) -> str:
    return ",".join(i.code for i in found)


def listed(found) -> str:
    return ",".join(sorted(map(str, found)))


def split(text: str) -> set[str]:
    return set(text.split(",")) if text else set()


def flag(x: object) -> str:
    return "yes" if x else "no"


def spans_text(found) -> str:
    return ",".join(f"{a}-{b}" for a, b in found)


#: A lexicon with one of each kind of brand-scoped rule.
RULES = Lexicon(
    makers=("ACMEO",),
    pins=(Pin("PINNA", "7", (r"\b600\b", r"\b(?:INJECTION|PEN)\b"), (r"\bNEEDLE",)),),
    aliases={"PINNA": ((r"\bFLEX\s*PEN\b", "PEN"),)},
    kept_variants={"KEPTO": ("ASP", "GOLD")},
    scopes=(Scope("SCOPA", frozenset({"3"}), (r"\b75\b", r"\b(?:60|120)\b")), Scope("SCOPI", frozenset({"3"}), (r"\bSUSPENSION\b",), only=True)),
    families=(Family("REVIA", frozenset({"1", "2"}), frozenset({"S", "SO"}), "SUSPENSION", (r"\bSUSPENSION\b", r"\b200 ML\b"), (), (r"\bS0\b",), "S"),),
    flavored={"FLAVA": ("GRANULES", "ELAICHI")},
    exact_only=frozenset({"EXACTA"}), weak_brands=frozenset({"NEWLY"}), review_brands=frozenset({"REVUE"}), known_products=("KNOWNOL",),
    exceptions=(Exception_("WIDGETA", r"\bCOMPANY\b", "drop"), Exception_("DINERA", r"\bDINNER\b", "garbage"), Exception_("CREMOR", r"\bCREAM\b", "drop", absent=True), Exception_("NUMLA", "SNUMLA", "rename", to="S-NUMLA", within="compact")),
    fused={"REVIASSUSP200ML": ("REVIA", "S")},
)


@cache
def classifier() -> K.Classifier:
    return K.Classifier(
        ["CORADIN", "CORADIN EM", "ZAP", "WIDGETA", "DINERA", "CREMOR", "NUMLA", "S-NUMLA", "EXACTA", "NEWLY", "REVUE", "ROSULIPID", "REVIA"],
        [("CORADIN", "CORADIN AT 25 TABLET", "AT", "25"), ("ROSULIPID", "ROSULIPID 40 TABLET", "", "40"), ("REVIA", "REVIA S SUSPENSION", "S", ""), ("CORADIN", "CORADIN 99 TABLET", "PLAIN", "99")], RULES,
    )


def verdict(name: str) -> str:
    v = classifier()(name)
    return "/".join((v.kind, v.brand, v.text, v.match, v.phrase, v.phrase_match))


def linked(found: D.Link) -> str:
    return f"{found.code}/{found.status}/{found.confidence}"


def ruled(brand: str, text: str) -> C.Catalogue:
    """A brand of the products `text`, under RULES."""
    rows = [(brand, i.product, i.pack, i.variant, i.sub, i.code) for i in items(text)]
    return C.Catalogue.of_rows(rows, RULES)


_STATE = "'1|FLAVA GRANULES CHOCOLATE|400 GM|CHOCOLATE|PLAIN;2|FLAVA GRANULES CHOCOLATE||CHOCOLATE|PLAIN;3|FLAVA GRANULES|400 GM|GRANULES|ELAICHI;4|FLAVA GRANULES||GRANULES|PLAIN;5|FLAVA BAR|30 GM|BAR|PLAIN'"
_REVIA = "'1|REVIA S SUSPENSION|200 ML|S|PLAIN;2|REVIA SO SUSPENSION|200 ML|SO|PLAIN;3|REVIA 10 TABLET||PLAIN|10'"

#: name -> (operator, cases of (arguments, result)); results are SQL over k, f, b, s (strength), d (twice it), h (a hundred more).
CASES: dict[str, tuple[Callable[..., object], list[tuple]]] = {
    "comparable_name": (W.comparable, [("b || '-x/' || s", "b || ' ' || s"), ("'a.b. ' || b || ' + ' || s", "'AB ' || b || ' PLUS ' || s"), ("b || '&' || b || ' *'", "b || ' AND ' || b"), ("'A.B.C ' || s || ' X 10'", "'AB C ' || s || ' 10'"), ("'  '", "''")]),
    "variant_form": (W.variant_form, [("lower(b) || '+' || s", "b || ' PLUS ' || s"), ("b || '--' || s || '.'", "b || ' ' || s"), ("'+'", "'PLUS'")]),
    "variant_key": (W.variant_key, [("b || ' + d ' || s", "b || 'PLUSD' || s"), ("'m-' || b", "'M' || b")]),
    "brand_key": (W.compact, [("b || ' + d ' || s", "b || 'D' || s"), ("lower(b) || '-' || s", "b || s"), ("'--'", "''")]),
    "strength_of_token": (W.full_strength, [("s || 'K'", "s || '000'"), ("s || '.5k'", "s || '500'"), ("s || 'M'", "s || '000000'"), ("s || 'MG'", "s || 'MG'"), ("b", "b")]),
    "strengths_of_words": (lambda t: listed(W.full_strengths(t.split())), [("b || ' ' || s || 'K'", "case when b < s || '000' then b || ',' || s || '000' else s || '000,' || b end"), ("'A A'", "'A'")]),
    "neighbours_joined": (lambda t: listed(W.joined_tokens(t)), [("'D ' || s", "'D' || s"), ("'A-B c'", "'AB,ABC,BC'"), ("b", "''")]),
    "strengths_in_compact": (W.strengths_in_compact, [("b || s || 'K'", "b || s || '000'"), ("b || s || 'MGTAB'", "b || s || 'MGTAB'"), ("b || '1M' || s", "b || '1000000' || s")]),
    "match_word": (W.match_word, [("'tabs'", "'TABLET'"), ("' crm '", "'CREAM'"), ("b", "b")]),
    "match_words": (lambda t: listed(W.match_words(t)), [("b || ' 10 MG TABS 1X10'", "case when b < 'TABLET' then b || ',TABLET' else 'TABLET,' || b end"), ("s || 'MG ' || s || 'S PACK OF X'", "''"), ("'FORT M'", "'FORTE,M'")]),
    "skeleton": (W.skeleton, [("b", "replace(replace(replace(replace(replace(b, 'A', ''), 'E', ''), 'I', ''), 'O', ''), 'U', '')"), ("'aei' || s", "'AEI'"), ("s", "''")]),
    "joined_thousands": (W.joined_thousands, [("s || ' 000 U'", "s || '000 U'"), ("s || ' 5'", "s || ' 5'"), ("'1 000 000 ' || b", "'1000 000 ' || b"), ("'10  000'", "'10000'")]),
    "plain_upper": (W.plain_upper, [("'a.b ' || lower(b) || '-' || s", "'AB ' || b || ' ' || s"), ("b || '+' || s", "b || ' PLUS ' || s"), ("''", "''")]),
    "without_repeats": (W.without_repeats, [("b || ' ' || lower(b) || ' ' || s", "b || ' ' || s"), ("b || ' ' || s || ' ' || b || ' ' || s", "b || ' ' || s"), ("b || ' A B ' || b || ' A B TAB'", "b || ' A B TAB'"), ("b || ' A ' || b", "b || ' A ' || b")]),
    "without_tags": (lambda t, tags: W.without_tags(t, split(tags)), [("'(AP) ' || b || ' ' || s", "''", "b || ' ' || s"), ("b || '-(M)' || s", "'M'", "b || '- M ' || s"), ("b || ' M (m) ' || s", "'M'", "b || ' M ' || s"), ("b || ' (1.5ML)'", "'M'", "b || ' (1.5ML)'")]),
    "repaired_name": (W.repaired, [("b || ' ' || s || ' mg tabs'", "b || ' ' || s || ' MG TABLET'"), ("b || '+susp'", "b || ' PLUS SUSPENSION'"), ("s || 'K ' || b", "s || '000 ' || b"), ("b || ' 5-1000'", "b || ' 5/1000'"), ("b || ' ' || s || '10S'", "b || case when cast(s || '10' as int) > 100 then ' ' || s || ' 10S' else ' ' || s || '10S' end"), ("b || ' GRANULES ELA BIG'", "b || ' GRANULES ELAICHI'"), ("b || ' 100S'", "b || ' 100S'")]),
    "without_maker": (lambda t, b: B.without_maker(t, brands(b, "ACMEO")), [("'ACMEO ' || b || ' ' || s", "b", "b || ' ' || s"), ("'ACM00' || b || ' ' || s", "b", "b || ' ' || s"), ("'ACMER CREAM'", "b || '//ACMER'", "'ACMER CREAM'"), ("b || ' ' || s", "b", "b || ' ' || s"), ("'ACMEO CREAM'", "b", "'ACMEO CREAM'")]),
    "like_maker": (lambda t: flag(B.like_maker(t, RULES)), [("'ACM0'", "'yes'"), ("'ACME'", "'yes'"), ("'AC'", "'no'"), ("b", "'no'"), ("'ACMEOPQRSTU'", "'yes'"), ("'ACMXYZW'", "'no'")]),
    "strong_brand": (lambda t, b: flag(brands(b).strong(t)), [("lower(b)", "b", "'yes'"), ("b || s", "b", "'yes'"), ("b || 'X'", "b", "'no'"), ("''", "b", "'no'")]),
    "brand_letters": (W.letters, [("lower(b) || '-' || s", "b"), ("s", "''")]),
    "unglued_name": (lambda t, b: B.unglued(t, brands(b)), [
        ("b || '10MGTABLETS'", "b", "b || ' 10 MG TABLETS'"), ("b || ' XX --'", "b", "b"), ("b || ' 12. 5 TAB'", "b", "b || ' 12.5 TAB'"), ("substr(b, 1, 1) || ' ' || substr(b, 2) || ' 5'", "b", "b || ' 5'"), ("b || 'FORTE 5'", f"b || ':' || {FAMILY}", "b || ' FORTE 5'"),
        ("b || ' IN-4'", "b", "b || ' INJ 4'"), ("b || ' M2FORTE'", "b", "b || ' M 2 FORTE'"), ("b || '-20TAB'", "b", "b || ' 20 TAB'"), ("b || ' 1X30'", "b", "b || ' 1X30'"), ("b || ' AMP10S TRIO F'", "b", "b || ' AMP 10S TRIO FORTE'")]),
    "split_brand": (lambda t, b: B.split_brand(t, brands(b)), [("b || 'CAPSULES'", "b", "b || ' CAPSULES'"), ("b || '-MET'", "b", "b || ' MET'"), ("b", "b", "b"), ("b || 'EM5'", "b || '//' || b || 'EM'", "b || 'EM 5'"), ("s", "b", "s")]),
    "split_variant": (lambda t, v, u: B.split_variant(t, frozenset(split(v)), frozenset(split(u))), [("'OHFORTE'", "'OH'", "'FORTE'", "'OH FORTE'"), ("'METO'", "'METO'", "'TO'", "'METO'"), ("b", "'OH'", "'FORTE'", "b")]),
    "variant_words": (lambda b: "/".join(listed(x) for x in brands(b).words), [(f"b || ':' || {FAMILY}", "'AM,DS,FORTE,PLAIN,XR/PLAIN'")]),
    "brand_query": (W.brand_query, [("b || ' ' || s || ' MG TAB'", "b"), ("b || s || 'MG'", "b"), ("b || ' EM TAB'", "b || ' EM'"), ("'TAB ' || b", "''"), ("s", "''")]),
    "removable_brand": (lambda b, v: W.removable_brand(b, split(v)), [("b || ' D3 TABLET'", "''", "b || ' D3'"), ("b || ' AM GOLD'", "'AM'", "b || ' GOLD'"), ("b || ' M FORTE X'", "'M FORTE'", "b || ' FORTE X'"), ("lower(b)", "'M'", "b")]),
    "without_brand": (lambda t, b: W.without_brand(t, b), [("b || ' 5 TAB'", "b", "'5 TAB'"), ("'THE ' || b || '-' || b || ' 5'", "b", "'THE - 5'"), ("substr(b, 1, 3) || ' ' || substr(b, 4) || ' 5'", "b", "'5'"), ("'5 TAB'", "b", "'5 TAB'"), ("b || '-EM 5'", "b || ' EM'", "'5'")]),
    "spaced_pattern": (W.spaced_pattern, [("'a-' || s", "'(?<![A-Z0-9])A[' || chr(92) || 's' || chr(92) || '-]*' || case when length(s) = 2 then substr(s, 1, 1) || '[' || chr(92) || 's' || chr(92) || '-]*' || substr(s, 2) else s end || '(?![A-Z0-9])'"), ("'-'", "''")]),
    "master_values": (lambda x: f"{W.clean(x, 'none')}/{W.clean_code(x)}/{W.clean_attribute(x)}", [("' ' || lower(b) || ' '", "lower(b) || '/' || lower(b) || '/' || b"), ("'nan'", "'none//PLAIN'"), ("'None'", "'none//PLAIN'"), ("''", "'//PLAIN'")]),
    "dose_of": (W.dose_of, [("s || ' mg'", "s"), ("s || '/' || d || ' TAB'", "s || '/' || d"), ("b || s", "''"), ("s || '.5MCG'", "s || '.5'")]),
    "is_dose": (lambda x: flag(W.is_dose(x)), [("s", "'yes'"), ("s || '/' || d || '.5'", "'yes'"), ("s || 'MG'", "'no'"), ("b", "'no'")]),
    "dose_variant": (W.dose_variant, [("s || ' 000 - PFS'", "s || '000'"), ("s || ' IU'", "s"), ("'V ' || s || ' MG'", "''")]),
    "repaired_fields": (lambda v, u: "|".join(C.repaired_fields(v, u)), [
        ("s || ' 000 - PFS'", "'PLAIN'", "'PLAIN|' || s || '000'"), ("s || ' MG'", "'TAB'", "'PLAIN|' || s"), ("s", "'FORTE'", "'FORTE|' || s"), ("'M TABLET'", "s", "'M|' || s"), ("s || '/' || d", "''", "'PLAIN|' || s || '/' || d"), ("s || 'MG'", "'PLAIN'", "'PLAIN|' || s"),
        ("'XR-' || s", "'nan'", "'XR|' || s"), ("'AM10'", "''", "'AM|10'"), ("'B5'", "''", "'B5|PLAIN'"), ("s || ' GOLD'", "''", "'GOLD|' || s"), ("'V ' || s || ' MCG'", "''", "'V|' || s"), ("'FORTE'", "''", "'FORTE|PLAIN'")]),
    "reasonable_pack": (lambda x: flag(P.reasonable(x)), [("s", "'yes'"), ("h", "'no'"), ("s || '.5'", "'no'"), ("'0'", "'no'"), ("b", "'no'")]),
    "pack_value": (lambda x: "" if (v := P.pack_value(x)) is None else f"{v:g}", [("'2X' || s", "d"), ("s || ' TAB'", "s"), ("'nan'", "''"), ("b", "''"), ("'1.2.3 X 4'", "'12'")]),
    "pack_size": (P.pack_size, [
        ("b || ' ' || s || 'X2X15'", "'15'"), ("b || ' 2X' || s", "d"), ("b || ' ' || s || ' MG 15 TAB'", "'15'"), ("b || ' 15X1X15'", "'15'"), ("b || ' PACK OF ' || s", "s"), ("b || ' ' || s || 'S'", "s"), ("b || ' ' || s || ' PCS'", "s"), ("b || ' TAB ' || s", "s"),
        ("b || ' ' || s || ' CAP ' || d || ' TAB'", "d"), ("b || ' ' || s || ' ML'", "s"), ("b || ' ' || s || ' MG'", "''"), ("b || ' 500X500'", "''"), ("b || ' 1*' || s || 'ML'", "s")]),
    "counted_tablets": (lambda t: ",".join(m[1] for m in P.counted(t)), [("b || ' ' || s || ' TABS'", "s"), ("s || 'CAP 5 STRIPS'", "s || ',5'"), ("h || ' TABLETS'", "''")]),
    "pack_spans": (lambda t: spans_text(P.pack_spans(t)), [("'A 1X10 B'", "'2-6'"), ("'A 10S'", "'2-5'"), ("'A 5 TAB 15 TAB'", "'8-14'"), ("'A X 30'", "'2-6'"), ("b", "''")]),
    "in_pack": (lambda a, z: flag(P.in_pack((int(a), int(z)), [(5, 9), (20, 25)])), [("'4'", "'6'", "'yes'"), ("'9'", "'12'", "'no'"), ("'4'", "'30'", "'no'"), ("'24'", "'30'", "'yes'")]),
    "pack_notation": (P.pack_notation, [("b || ' 1 X ' || s", "'1X' || s"), ("b || ' ' || s || ' S'", "s || 'S'"), ("b || ' ' || s || ' TAB'", "s || 'T'"), ("b || ' CAP ' || s", "s || 'T'"), ("b || ' 1X10 PCS'", "'1X10'"), ("b", "''")]),
    "with_pack": (P.with_pack, [("b", "'15 TAB'", "b || ' 15TAB'"), ("b || ' 1X10'", "'15'", "b || ' 1X10'"), ("b || ' 5 MG'", "'15'", "b || ' 5 MG'"), ("b", "''", "b"), ("b", "'nan'", "b"), ("b || ' PACK'", "'PACK'", "b || ' PACK'")]),
    "combination": (P.combination, [("b || ' ' || s || '/' || d || ' TAB'", "s || '/' || d"), ("s || ' / ' || d || '/5'", "s || '/' || d || '/5'"), ("b || ' ' || s || '-' || d", "s || '/' || d"), ("'100/1X10'", "''"), ("b", "''")]),
    "has_combination": (lambda p, c: flag(P.has_combination(p, c)), [("b || ' M ' || s || '/1000'", "s || '/1000'", "'yes'"), ("b || ' 2.5/1000'", "'5/1000'", "'no'"), ("b || ' 5/10000'", "'5/1000'", "'no'"), ("b", "''", "'no'")]),
    "flavors": (lambda t, v: listed(W.flavors_of(t, split(v))), [("b || ' CHOCO'", "'CHOCOLATE'", "'CHOCOLATE'"), ("b || ' KESAR ELA'", "'KESAR,ELAICHI'", "'ELAICHI,KESAR'"), ("b || ' KESAR'", "'PLAIN'", "''")]),
    "compound_tokens": (lambda t, b: ",".join(A.compound_tokens(t, b)), [("b || ' D3 ' || s", "b", "'D3'"), ("b || '-GOLD 5'", "b", "'GOLD'"), ("b || ' 5MG TAB'", "b", "''"), ("b || ' 1X10'", "b", "''"), ("b || ' M2 EXTRA'", "b", "'M2'")]),
    "compound_digits": (lambda t: listed(A.digits_of(t.split(","))), [("'D3,M' || s", "case when s < '3' then s || ',3' when s = '3' then '3' else '3,' || s end"), ("'GOLD'", "''")]),
    "skip_words": (lambda t: flag(t in DEFAULT.skip), [("'TAB'", "'yes'"), ("'MCG'", "'yes'"), ("'POWDE'", "'yes'"), ("b", "'no'")]),
    "coarse_forms": (lambda t: listed(O.coarse_forms(t)), [("s || '5TABS'", "'TAB'"), ("s || ' SUSP CAP'", "'CAP,SYP'"), ("s || ' VIAL'", "'INJ'"), ("s", "''")]),
    "forms_in_name": (lambda t: listed(O.forms_in_name(t)), [("b || ' ' || s || 'TAB'", "'TABLET'"), ("b || ' SYP 100ML'", "'SUSPENSION'"), ("b || ' 1X10TAB CAP'", "'CAPSULE'"), ("b || ' TAB CAP'", "'CAPSULE,TABLET'"), ("b || ' ING'", "'INJECTION'"), ("b || ' DROPSX'", "'DROPS'"), ("s", "''")]),
    "forms_of_product": (lambda t: listed(O.forms_of_product(t)), [("b || ' 5 TABLETS'", "'TABLET'"), ("b || ' SYRUP'", "'SUSPENSION'"), ("b || ' I.V. VIAL'", "'INJECTION'"), ("b || ' 5'", "''"), ("b || ' CREAM GEL'", "'CREAM,GEL'")]),
    "forms_share_group": (lambda a, z: flag(O.share_group(split(a), split(z))), [("'TABLET'", "'CAPSULE'", "'yes'"), ("'DROPS'", "'SYRUP'", "'yes'"), ("'GEL'", "'TABLET'", "'no'"), ("''", "'TABLET'", "'no'")]),
    "glued_parts": (lambda t, v: "/".join(map(listed, A.glued_parts(t, split(v)))), [("b || ' ' || s || 'M'", "'M'", "'M/' || s"), ("s || 'XR'", "'XR,R'", "'XR/' || s"), ("s || 'MV'", "'M,V'", "'M,V/' || s"), ("s || 'MG'", "'M,G'", "'/'"), ("'1VIL'", "'L'", "'/'"), ("s || 'S'", "'S'", "'/'")]),
    "coded_parts": (lambda t, v: "/".join(map(listed, A.coded_parts(t, split(v)))), [("'M2 FORTE'", "'M,M FORTE'", "'M,M FORTE/2'"), ("'AM' || s || ' TABX'", "'AM'", "'AM/' || s"), ("'AM' || s || ' TAB'", "'B'", "'/'")]),
    "numbered_parts": (lambda t, v: "/".join(map(listed, A.numbered_parts(t, split(v)))), [("b || ' AM' || s", "'AM'", "'AM/' || s"), ("b || ' AM-' || s || ' TAB'", "'AM'", "'AM/' || s"), ("'MG ' || s", "'MG'", "'/'")]),
    "brand_rewrite": (lambda t: D.link(t, ruled("PINNA", "7|PINNA 600 PEN||PLAIN|600;8|PINNA 300 PEN||PLAIN|300")).code, [("'PINNA 600 FLEX PEN'", "'7'"), ("'PINNA 300 PEN'", "'8'")]),
    "suggestion_line": (lambda p, c, x: D.written([D.Suggestion(p, c, float(x)), D.Suggestion(p, "", 1.0)]), [("b", "s", "'95.5'", "b || ' (' || s || ') [95.5] | ' || b || ' [1.0]'")]),
    "prompt_line": (lambda i, t, b: K.prompt_line(int(i), t, [(b, t, 0.875)] if b else []), [("'1'", "b", "s", "'1. ' || b || ' || candidates: ' || s || ' (word \"' || b || '\", 0.88)'"), ("'2'", "b", "''", "'2. ' || b || ' || candidates: no close brand'")]),
    "rerank_documents": (lambda x: "/".join(D.documents(list(items(x)))), [("'1|A.B ' || lower(b) || '-5|1X10|PLAIN|5;2|' || b || '||PLAIN|5'", "'AB ' || b || ' 5 [PACK:1X10]/' || b")]),
    "product_code_form": (W.product_code, [("s || '.0'", "s"), ("' A' || s || ' '", "'A' || s"), ("'0'", "'0'"), ("'nan'", "'0'"), ("'None'", "'0'"), ("''", "'0'"), ("'1e400'", "'1e400'")]),
    "edit_kind": (lambda a, z: K.edit_kind(a, z) or "none", [("b", "b", "'exact'"), ("'X' || substr(b, 2)", "b", "'1-substitution'"), ("substr(b, 2)", "b", "'1-insertion'"), ("b || 'X'", "b", "'1-deletion'"), ("substr(b, 3)", "b", "'none'"), ("'ab'", "'ba'", "'none'")]),
    "osa_capped": (lambda a, z, n: sim.osa(a, z, int(n)), [("b", "b", "'2'", "'0'"), ("'XY' || b", "'YX' || b", "'2'", "'1'"), ("'CA'", "'ABC'", "'3'", "'3'"), ("b || 'XYZ'", "b", "'2'", "'3'")]),
    "words_ratio": (lambda a, z: f"{sim.ratio(a, z):.3f}", [("b", "b", "'100.000'"), ("b || b", "b", "'66.667'"), ("'ABCD'", "'WXYZ'", "'0.000'"), ("b || 'Q'", "b || 'Z'", "'90.909'")]),
    "words_sorted_ratio": (lambda a, z: f"{sim.token_sort(a, z):.3f}", [("b || ' A'", "'A ' || b", "'100.000'"), ("'A B'", "'A C'", "'66.667'")]),
    "words_set_ratio": (lambda a, z: f"{sim.token_set(a, z):.3f}", [("b || ' A'", "'A ' || b || ' EXTRA'", "'100.000'"), ("'AB CD'", "'AB XY'", "'60.000'"), ("'AB'", "'XY'", "'0.000'")]),
    "jaro_winkler_score": (lambda a, z: f"{sim.jaro_winkler(a, z):.4f}", [("'MARTHA'", "'MARHTA'", "'0.9611'"), ("b", "b", "'1.0000'"), ("'DIXON'", "'DICKSONX'", "'0.8133'")]),
    "ratcliff_score": (lambda a, z: f"{sim.ratcliff(a, z):.4f}", [("b", "b", "'1.0000'"), ("b || b", "b", "'0.6667'"), ("'AB'", "'XY'", "'0.0000'")]),
    "best_choice": (lambda q, t: next((t.split(",")[i] for _, i in Choices(t.split(",")).best(q, sim.token_sort, 80)), "none"), [("substr(b, 2)", "'OTHERS,' || b || ',' || b", "b"), ("b", "'OTHERS,THINGS'", "'none'")]),
    "brand_like_words": (lambda t, b: ",".join(f"{x}:{w}" for x, w, _ in K.brand_candidates(t, b.split(","))), [("substr(b, 2) || ' ' || s", "b || ',QWQWQW'", "b || ':' || substr(b, 2)"), ("substr(b, 1, 5) || ' ' || substr(b, 6)", "b", "b || ':' || b"), ("s", "b", "''")]),
    "words_and_pairs": (lambda t: ",".join(K.words_and_pairs(t)), [("b || ' abc ' || s", "b || ',ABC,' || b || 'ABC'"), ("'AB ' || s", "''")]),
    "garbage_phrases": (lambda t: flag(K.is_garbage_phrase(t, K.garbage_phrases())), [("'Grand  Total'", "'yes'"), ("'-- '", "'yes'"), ("b", "'no'"), ("'TOTAL ' || b", "'no'")]),
    "garbage_patterns": (lambda t: flag(K.is_garbage_pattern(t)), [("'total ' || b", "'yes'"), ("'TOTAL' || b", "'no'"), ("s || '.00'", "'yes'"), ("'A' || s", "case when length(s) <= 2 then 'yes' else 'no' end"), ("b || ' TOTAL'", "'no'")]),
    "metadata_rows": (lambda t: flag(K.is_metadata(t)), [("'STOCK DATE ' || s", "'yes'"), ("'LAST MONTH SALE MAY'", "'yes'"), ("'SALE ' || b", "'no'"), ("s", "'no'")]),
    "product_signals": (lambda t: flag(K.may_be_product(t, RULES)), [("b || ' TAB'", "'yes'"), ("b || ' ' || s || 'MG'", "'yes'"), ("b || ' 1*10'", "'yes'"), ("b || ' 10S'", "'yes'"), ("b || ' TAB SALE'", "'no'"), ("b", "'no'"), ("'KNOWNOL'", "'yes'")]),
    "form_and_quantity": (lambda t: flag(K.has_form(t)) + "/" + flag(K.has_quantity(t)), [("b || ' TAB ' || s || 'MG'", "'yes/yes'"), ("b || ' SUPP'", "'yes/no'"), ("b || ' PCS'", "'no/yes'"), ("b", "'no/no'")]),
    "brand_exceptions": (verdict, [("'WIDGETA COMPANY ' || b", "'MAYBE_PRODUCT///no-brand-fallback//'"), ("'WIDGETA ' || s", "'0/WIDGETA/WIDGETA/exact//'"), ("'DINERA DINNER'", "'1/////'"), ("'CREMOR ' || s || ' GEL'", "'MAYBE_PRODUCT///form+qty match//'"), ("'CREMOR CREAM'", "'0/CREMOR/CREMOR/exact//'"), ("'S NUMLA ' || s", "'0/S-NUMLA/NUMLA/exact//'")]),
    "exact_only_brands": (verdict, [("'EXACTA ' || s", "'0/EXACTA/EXACTA/exact//'"), ("'EXACTE ' || s || ' TAB'", "'MAYBE_PRODUCT///form+qty match//'"), ("'REVUE TAB'", "'MAYBE_PRODUCT///form+qty match//'")]),
    "near_garbage_phrase": (lambda t: "/".join(K.near_phrase(t, K.garbage_phrases()) or ()), [("'GRAND TOTL'", "'GRAND TOTAL/1-insertion'"), ("'GRXND TOTAL'", "'GRAND TOTAL/1-substitution'"), ("'TOTAL'", "''"), ("b", "''")]),
    "master_evidence": (verdict, [("'CORADINAT25MG TAB'", "'0/CORADIN/CORADINAT25MG/master-product//'"), ("'MYCORADIN 99 TAB'", "'0/CORADIN/MYCORADIN/master-product//'"), ("'CORADINAT 5 MG'", "'0/CORADIN/CORADINAT/master-variant//'"), ("'ROZULIPYD 40 MG TAB'", "'0/ROSULIPID/ROZULIPYD/master-2-edit//'"), ("'ROZULIPYD 41 MG TAB'", "'MAYBE_PRODUCT///form+qty match//'"), ("'REVIASSUSP-200ML'", "'0/REVIA/REVIASSUSP-200ML/master-new-family-exact//'"), ("'CORADINAT'", "'MAYBE_PRODUCT///no-brand-fallback//'")]),
    "vocabulary_matches": (verdict, [("'CORADIN EM ' || s", "'0/CORADIN/CORADIN/exact//'"), ("'COR ADIN ' || s", "'0/CORADIN/COR ADIN/exact//'"), ("'CORDIN ' || s", "'0/CORADIN/CORDIN/1-insertion//'"), ("'CROADIN ' || s", "'0/CORADIN/CROADIN/1-transposition//'"), ("'ZAP ' || s", "'0/ZAP/ZAP/exact//'"), ("'ZAPP XYZZY'", "'MAYBE_PRODUCT///no-brand-fallback//'"), ("'Z AP XYZZY'", "'MAYBE_PRODUCT///no-brand-fallback//'")]),
    "model_answers": (lambda t, n: ",".join(K.answers(t, int(n))), [("'1=0' || chr(10) || ' 2 = 1 '", "'2'", "'0,1'"), ("'the answer is 1'", "'1'", "'1'"), ("'1=0'", "'2'", "'0,BAD_OUTPUT'"), ("b", "'1'", "'BAD_OUTPUT'")]),
    "brand_hint": (lambda h, b: brands(b).key(h) or "none", [("' ' || lower(b) || ' '", "b", "b"), ("b || 'X'", "b", "'none'"), ("b || ' x'", "b || ' x'", "b || ' x'")]),
    "potential_brands": (lambda t, b: ",".join(f"{n}:{f}" for n, f in B.potential_brands(t, brands(b))), [("b || ' ' || s", "b || '//OTHERO'", "b || ':3'"), ("substr(b, 1, 4) || '-' || substr(b, 5) || ' 5'", "b", "b || ':4'"), ("b || s || 'MG'", "b", "b || ':3'"), ("b || 'SYP'", "b || 'S'", "''"), ("'GOLD ' || s || ' ' || b", "b || ' GOLD'", "b || ' GOLD:2'"), ("b || ' 5'", "b || ' EM'", "b || ' EM:0'")]),
    "best_brand": (lambda t, b: B.best_brand(t, brands(b)) or "none", [
        ("b || ' EM 5'", "b || '//' || b || ' EM'", "b || ' EM'"), ("b || ' D 3 5'", "b || '//' || b || ' D3'", "b || ' D3'"), ("b || ' MET 5 TAB'", "b || '//' || b || ' METO'", "b || ' METO'"), ("substr(b, 1, 8) || 'QQ 5'", "b", "b"), ("'QQQ' || substr(b, 4) || ' 5'", "b", "'none'"), ("'QQZZQQ 5'", "b", "'none'"), ("'A' || b || ' 5'", "b", "'none'"), ("substr(b, 2) || ' 5'", "b", "b")]),
    "related_brands_of": (lambda b, t, all_: ",".join(B.related(b, t, brands(all_))), [("b", "b || ' 5'", "b || '//' || b || ' EM//' || b || ' TAB'", "b || ',' || b || ' TAB'"), ("b", "b || ' EM 5'", "b || '//' || b || ' EM'", "b || ',' || b || ' EM'"), ("b || ' EM'", "b || ' EM XT'", "b || ' EM//' || b || ' XT//' || b", "b || ' EM,' || b || ' XT'")]),
    "promoted_brand": (lambda t, b, all_: B.promoted(t, b, brands(all_)) or "none", [("b || ' MET 5'", "b", "b || '//' || b || ' METO'", "b || ' METO'"), ("b || ' PRO 5'", "b", "b || ' PROX//' || b || ' PROT//' || b", "'none'"), ("b || ' TAB'", "b", "b || ' TABX//' || b", "'none'"), ("'5'", "b", "b", "'none'")]),
    "nearest_brand_edits": (lambda t, b: "/".join(str(x) for x in B.within_edits(t, b.split(","))), [("substr(b, 2) || ' 5'", "'OTHERO,' || b", "b || '/1'"), ("substr(b, 3) || ' 5'", "b", "'None/2'"), ("'5'", "b", "'None/None'")]),
    "nearest_brands": (lambda t, b: ",".join(x for x, _ in B.nearest_brands(t, brands(b))[:1]), [("substr(b, 2) || ' 5'", "b || '//QWXZQWXZQW'", "b"), ("'A' || b", "b", "''")]),
    "part_of_brand": (lambda q, c: flag(B.is_part(q, c)), [("'A' || b", "b", "'yes'"), ("b", "'A' || b", "'no'"), ("b", "b", "'no'"), ("''", "b", "'no'")]),
    "variant_tags": (lambda h, b: listed(brands(b).tags(h)), [("lower(b)", f"b || ':' || {FAMILY}", "'AM,DS,XR'"), ("'OTHER'", "b", "''")]),
    "by_compound": (lambda x, t: codes(N.by_compound(list(items(x)), [c for c in t.split(",") if c])), [(FAMILY, "'FORTE'", "'3'"), (FAMILY, "''", "'1,2,3,4,5,6,7,8'"), (FAMILY, "'QQ7'", "'1,2,3,4,5,6,7,8'"), (FAMILY, "'SYR'", "'7,8'"), ("'1|' || b || ' D 3|||;2|' || b || ' D33|||'", "'D3'", "'1'")]),
    "by_abbreviation": (lambda x, t, b: codes(N.by_abbreviation(list(items(x)), t, b)), [(FAMILY, "b || ' FOR 5'", "b", "'3'"), (FAMILY, "b || ' FORTE 5'", "b", "'1,2,3,4,5,6,7,8'"), (FAMILY, "b || ' TAB'", "b", "'1,2,3,4,5,6,7,8'"), ("'1|' || b || ' PROTECT|||;2|' || b || ' PROTEIN|||'", "b || ' PRO'", "b", "'1,2'")]),
    "by_exact_brand": (lambda x, t, b: codes(N.by_exact_brand(list(items(x)), t, b)), [("'1|' || b || ' 5|||;2|' || b || 'MET 5|||'", "b || ' 5'", "b", "'1'"), ("'1|' || b || ' 5|||;2|' || b || 'MET 5|||'", "b || ' MET 5'", "b", "'1,2'"), ("'2|' || b || 'MET 5|||'", "b || ' 5'", "b", "'2'")]),
    "by_half": (lambda x, t: codes(N.by_half(list(items(x)), t)), [("'1|SEMI ' || b || '|||;2|' || b || '|||'", "b || ' 5'", "'2'"), ("'1|SEMI ' || b || '|||;2|' || b || '|||'", "'HALF ' || b", "'1'"), ("'2|' || b || '|||'", "'SEMI ' || b", "'2'")]),
    "unknown_words": (lambda t, b, x: ",".join(B.unknown_words(t, b, *C.attributes(list(items(x)))[:2], list(items(x)))), [("b || ' GOLD 5'", "b", FAMILY, "'GOLD'"), ("b || ' FORTE TAB GOLD'", "b", FAMILY, "''"), ("b || ' FOR 5'", "b", FAMILY, "''"), ("b || ' X R 5'", "b", FAMILY, "''"), ("'SEMI ' || b || ' 5'", "b", FAMILY, "'SEMI'"), ("substr(b, 2) || ' P 5'", "b", FAMILY, "'P'")]),
    "most_specific": (lambda v: listed(N.most_specific(split(v))), [("'M,M FORTE,PLAIN'", "'M FORTE,PLAIN'"), ("'M,X'", "'M,X'"), ("'M'", "'M'"), ("b || ',' || b || ' X'", "b || ' X'")]),
    "by_variant": (lambda x, v, all_: codes(N.by_variant(list(items(x)), split(v), list(items(all_)))), [(FAMILY, "'XR'", "''", "'4,5'"), (FAMILY, "'PLAIN'", "''", "'1,2,7'"), ("'1|A||PLAIN|'", "'XR'", FAMILY, "'4,5'"), ("'1|A||XR|'", "'DS'", "'1|A||XR|'", "'1'"), (FAMILY, "'GOLD'", "''", "'1,2,7'")]),
    "by_dose_in_name": (lambda x, v: codes(N.by_dose_in_name(list(items(x)), split(v))), [("'1|A 5 MG|||;2|A 5|||;3|A M5|||'", "'5'", "'1'"), ("'2|A 5|||;3|A M5|||;4|A 55|||'", "'5'", "'2,3'"), ("'3|A M5|||;4|A 55|||'", "'5'", "'3'"), ("'4|A 55|||;5|A 5X10|||'", "'5'", "'4,5'"), ("'4|A 55|||'", "'PLAIN,5/10'", "'4'")]),
    "by_strength": (lambda x, v, t: codes(N.by_strength(list(items(x)), split(v), t)), [
        (FAMILY, "'5/20,PLAIN'", "b || ' 5/20'", "'6'"), (FAMILY, "'10,PLAIN'", "b || ' 10'", "'2,3,4,5'"), (FAMILY, "'PLAIN'", "b || ' SYP'", "'7,8'"), (FAMILY, "'5,10,PLAIN'", "b || ' 5 10'", "'1'"), (FAMILY, "'77,PLAIN'", "b || ' 77'", "'7,8'"), ("'1|A||PLAIN|10/5;2|A||PLAIN|25/5'", "'10,PLAIN'", "'A 10'", "'1'"),
        ("'1|A||PLAIN|100/5/500;2|A||PLAIN|100/10/500;3|A||PLAIN|7'", "'100/500,PLAIN'", "'A 100/500'", "'1'"), ("'1|A FORTE||PLAIN|FORTE;2|A||PLAIN|PLAIN'", "'FORTE,PLAIN'", "'A FORTE'", "'1'"), ("'1|A 10||PLAIN|10;2|A 5||PLAIN|5'", "'10/5,PLAIN'", "'A 10/5'", "'1'"), ("'1|A||PLAIN|7'", "'PLAIN'", "'A'", "'1'")]),
    "by_form": (lambda x, f: codes(N.by_form(list(items(x)), split(f))), [(FAMILY, "'SUSPENSION'", "'7,8'"), (FAMILY, "'CAPSULE'", "'1,2,3,4,5,6'"), (FAMILY, "''", "'1,2,3,4,5,6,7,8'"), ("'1|A|||;2|A TABLET|||'", "'GEL'", "'1'")]),
    "compatible_form": (lambda x, f: codes(N.compatible(list(items(x)), split(f))), [("'1|A|||;2|A TABLET|||;3|A GEL|||'", "'CAPSULE'", "'1,2'"), ("'3|A GEL|||'", "'TABLET'", "''"), ("'3|A GEL|||'", "'FOO'", "'3'")]),
    "form_retry": (lambda x, f: codes(N.again_if_incompatible(lambda pool: [i for i in pool if i.sub == "5"] or pool[:1], list(items(x)), split(f))), [("'1|A GEL||| 5;2|A GEL|||5;3|A TABLET|||7'", "'TABLET'", "'3'"), ("'2|A TABLET|||5;3|A TABLET|||7'", "'TABLET'", "'2'")]),
    "by_named_dose": (lambda x, t: codes(N.by_named_dose(list(items(x)), t)), [("'1|A 500MG/10ML|||;2|A 1K|||'", "'A 500 MG'", "'1'"), ("'1|A 500MG|||;2|A 250MG|||'", "'A 750 MG'", "'1,2'"), ("'1|A 500MG|||;2|A 250MG|||'", "'A 500'", "'1,2'")]),
    "by_pack": (lambda x, p: codes(N.by_pack(list(items(x)), p)), [("'1|A|1X10||;2|A|||;3|A|30||'", "'10'", "'1'"), ("'1|A|1X10||;2|A|||;3|A|30||'", "''", "'2'"), ("'1|A|1X10||;2|A|||'", "'30'", "'2'"), ("'1|A|1X10||;3|A|30||'", "'28'", "'3'"), ("'1|A|1X10||;3|A|30||'", "''", "'1'"), ("'1|A|1X10||;3|A|30||'", "'400'", "'1,3'"), ("'1|A|1X10||'", "'ten'", "'1'")]),
    "by_flavor": (lambda t, v, p: codes(N.by_flavor(list(items(_STATE.strip("'"))), list(items(_STATE.strip("'"))), "FLAVA", t, t, split(v), {"PLAIN"}, p, RULES)), [("'FLAVA CHOCO 400 GM'", "'CHOCOLATE'", "'400'", "'1'"), ("'FLAVA CHOCO'", "'CHOCOLATE'", "''", "'2'"), ("'FLAVA GRANULES 400'", "'GRANULES'", "''", "'3'"), ("'FLAVA GRANULES'", "'GRANULES'", "''", "'2,4'"), ("'FLAVA BAR'", "'BAR'", "''", "'1,2,3,4,5'")]),
    "by_pin": (lambda x, t: codes(N.by_pin(list(items(x)), "PINNA", t, t, RULES)), [("'7|PINNA 600|||;8|PINNA|||'", "'PINNA 600 INJ'", "'7'"), ("'7|PINNA 600|||;8|PINNA|||'", "'PINNA 600 PEN NEEDLES'", "'7,8'"), ("'7|PINNA 600|||;8|PINNA|||'", "'PINNA 300 PEN'", "'7,8'")]),
    "by_kept_variant": (lambda x, t: codes(N.by_kept_variant(list(items(x)), "KEPTO", t, A.compound_tokens(t, "KEPTO"), RULES)), [("'1|A||ASP|;2|A||GOLD|;3|A||PLAIN|'", "'KEPTO ASP TAB'", "'1'"), ("'1|A||ASP|;2|A||GOLD|'", "'KEPTO ASP GOLD'", "'1,2'"), ("'1|A||ASP|;2|A||GOLD|'", "'KEPTO 5 ASP'", "'1,2'")]),
    "by_scope": (lambda x, b, t: codes(N.by_scope(list(items(x)), b, t, RULES)), [("'2|A|||;3|A|||'", "'SCOPA'", "'SCOPA 75 60'", "'2'"), ("'2|A|||;3|A|||'", "'SCOPA'", "'SCOPA 75'", "'2,3'"), ("'2|A|||;3|A|||'", "'SCOPI'", "'SCOPI TAB'", "'2'"), ("'2|A|||;3|A|||'", "'SCOPI'", "'SCOPI SUSP'", "'2,3'")]),
    "family_review": (lambda t: (lambda r: "none" if r is None else f"{r.status}/{r.code}")(D.review(t, t, "REVIA", list(items(_REVIA.strip("'"))), RULES)), [
        ("'REVIA S SUSP 200ML'", "'none'"), ("'REVIA SUSP 200ML'", "'REVIEW_REVIA_DEFAULT_MISSING_VARIANT/1'"), ("'REVIA S0 SUSP'", "'REVIEW_REVIA_OCR_QUALIFIER/'"), ("'REVIA S TAB'", "'REVIEW_REVIA_FORM/'"), ("'REVIA S SO SUSP'", "'REVIEW_REVIA_CONFLICT/'"), ("'REVIA S SUSP 100ML'", "'REVIEW_REVIA_PACK/'"), ("'REVIA 10 TAB'", "'none'")]),
    "ambiguous_strengths": (lambda x, v: flag(N.ambiguous_strength(list(items(x)), split(v))), [("'1|A||M|10/5;2|A||M|10/20'", "'PLAIN'", "'yes'"), ("'1|A||M|10/5;2|A||M|20/5'", "'10,PLAIN'", "'yes'"), ("'1|A||M|10/5;2|A||M|10/20'", "'10/5'", "'no'"), ("'1|A||M|5;2|A||M|10'", "'PLAIN'", "'no'"), ("'1|A||M|10/5;2|A||X|10/20'", "'PLAIN'", "'no'")]),
    "variants_in": (lambda t, b, x: listed(A.variants_in(t, b, C.attributes(list(items(x)))[0], items=list(items(x)))), [
        ("b || ' FORTE 10'", "b", FAMILY, "'FORTE'"), ("b || ' XR 10 TAB'", "b", FAMILY, "'XR'"), ("b || ' 5/20'", "b", FAMILY, "'AM'"), ("b || ' 10 TAB'", "b", FAMILY, "'PLAIN'"), ("b || ' AM5'", "b", FAMILY, "'AM'"), ("b || ' 10S'", "b", "'1|A||S|'", "'PLAIN'"), ("b || ' 80H'", "b", "'1|A||H|'", "'H'"), ("b || ' H40MG'", "b", "'1|A||H|'", "'H'"),
        ("b || ' M2FORTE'", "b", "'1|A||M FORTE|;2|A||M|'", "'M,M FORTE'"), ("b || ' 10000 INJ'", "b", "'1|A||10 000 - PFS|'", "'10 000 - PFS'"), ("b || ' INJ'", "b", "'1|A||I.V.|;2|A||XR|'", "'I.V.'"), ("b || ' 0.25 INJ'", "b", "'1|A||PFS|5;2|A||PLAIN|0.25'", "'PLAIN'"), ("b || ' CHOCO'", "b", "'1|A||CHOCOLATE|'", "'CHOCOLATE'"), ("b || ' FORTS'", "b", FAMILY, "'FORTE'"), ("b || ' HYD CREAM'", "b", "'1|A||HYDRATING LOTION|'", "'HYDRATING LOTION'")]),
    "strengths_in": (lambda t, b, x: listed(A.strengths_in(t, b, *C.attributes(list(items(x)))[1::-1])), [
        ("b || ' 10 MG TAB'", "b", FAMILY, "'10,PLAIN'"), ("b || ' 5/20'", "b", FAMILY, "'5/20,PLAIN'"), ("b || ' 10 1X5'", "b", FAMILY, "'10,PLAIN'"), ("b || ' SYP 10 ML'", "b", FAMILY, "'PLAIN'"), ("b || ' 10 TAB'", "b", FAMILY, "'10,PLAIN'"), ("b || ' 2.5'", "b", FAMILY, "'PLAIN'"), ("b || '-10'", "b", FAMILY, "'10,PLAIN'"),
        ("b || ' FORT'", "b", "'1|A|||FORTE'", "'FORTE,PLAIN'"), ("b || ' 5XR'", "b", FAMILY, "'5,PLAIN'"), ("b || ' PLAINS'", "b", FAMILY, "'PLAIN'")]),
    "attribute_sets": (lambda x: "/".join(map(listed, C.attributes(list(items(x))))), [(FAMILY, "'AM,DS,FORTE,PLAIN,XR/10,5,5/20,PLAIN/100 ML,1X10,1X15,60 ML'"), ("''", "'PLAIN/PLAIN/'")]),
    "all_attributes": (lambda b: listed(brands(b).variants) + "/" + listed(brands(b).sub_variants), [(f"b || ':' || {FAMILY}", "'AM,DS,FORTE,PLAIN,XR/10,5,5/20,PLAIN'")]),
    "name_points": (lambda p, t, v, u: R.name_score(p, t, split(v), split(u)), [("b || ' FORTE'", "b", "''", "''", "'-40'"), ("b || ' ' || h", "b", "''", "''", "'-25'"), ("b || ' FORTE'", "b || ' FORTE'", "'FORTE'", "''", "'100'"), ("b || ' 7 MG'", "b || ' 7'", "''", "'7'", "'125'"), ("b || ' 5 TABLET'", "b || ' 5X15'", "''", "''", "'75'"), ("'SEMI ' || b", "b", "''", "''", "'-60'"), ("b || ' MP'", "b || ' MP'", "''", "''", "'20'"), ("b || ' 10S TAB'", "b", "''", "''", "'0'")]),
    "structural_words": (lambda t: flag(R.structural(t)), [("'1X10S'", "'yes'"), ("'10S'", "'yes'"), ("'MG.'", "'yes'"), ("'15TAB'", "'yes'"), ("b", "'no'"), ("s", "'no'")]),
    "ordered_by_name": (lambda x, t: codes(R.by_name(list(items(x)), t)), [("'1|A FORTE|||;2|A|||;3|A GOLD FORTE|||'", "'A'", "'2,1,3'"), ("'1|A B|||;2|A C|||'", "'A'", "'1,2'")]),
    "ranked_products": (lambda x, t: codes(i for _, i in R.ranked(list(items(x)), t)[:2]), [("'1|' || b || ' FORTE|||;2|' || b || '|||'", "b", "'2,1'"), ("'1|' || b || ' FORTE|||;2|' || b || '|||'", "b || ' FORTE'", "'1,2'"), ("'1|' || b || '|||'", "'ANY'", "'1'")]),
    "best_product": (lambda x, t: getattr(R.best(list(items(x)), t), "code", "none"), [("'1|' || b || ' FORTE|||;2|' || b || '|||'", "b", "'2'"), ("''", "b", "'none'")]),
    "ghost_points": (lambda x, t: R.ghosts(items(x)[0], set(t.split())), [("'1|A FORTE||PLAIN|PLAIN'", "'A'", "'-120'"), ("'1|A||M FORTE|FORTE'", "'A M'", "'-350'"), ("'1|A FORTE||FORTE|FORTE'", "'A FORTE'", "'0'")]),
    "name_without_packs": (P.without_packs, [("b || ' 5 MG 1X10'", "b || ' 5 MG'"), ("b || ' 10S TAB'", "b || ' TABLET'"), ("b", "b")]),
    "sure_choice": (lambda a, z: flag(R.is_sure([(float(x), C.Item("A")) for x in (a, z) if x])), [("'5'", "''", "'yes'"), ("'95'", "'87'", "'yes'"), ("'95'", "'88'", "'no'"), ("'89'", "'1'", "'no'")]),
    "suggested_products": (lambda x, t: ",".join(f"{s.code}:{s.score}" for s in D.suggested(list(items(x)), t)), [("'1|' || b || '|||'", "b", "'1:100.0'"), ("''", "b", "''")]),
    "reranked_answer": (lambda a, x: (lambda i, k: f"{getattr(i, 'code', '')}/{k}")(*R.closest_product(a, list(items(x)))), [("b || ' [PACK:1X10]'", "'1|OTHER|||;2|' || b || '|||'", "'2/exact'"), ("b || 'X'", "'1|OTHER|||;2|' || b || '|||'", "'2/fuzzy'"), ("'77777'", "'2|' || b || '|||'", "'/none'")]),
    "review_suggestion": (lambda t, b: D.suggest(t, brands(b))[1], [("b || ' FORTE 10 TAB'", f"b || ':' || {FAMILY}", "'3'"), ("'QQZZQQ'", f"b || ':' || {FAMILY}", "''"), ("b || ' DS SYP'", f"b || ':' || {FAMILY}", "'8'")]),
    "reranker_outcomes": (lambda t, b, at, score: linked(D.link(t, brands(b), rerank=(lambda q, docs: 1 / 0) if at == "x" else (lambda q, docs: (int(at), float(score))))), [("b || ' A 5'", "b || ':1|' || b || ' A 5 ONE||A|5;2|' || b || ' A 5 TWO||A|5'", "'1'", "'0.8'", "'2/MATCHED/HIGH'"), ("b || ' A 5'", "b || ':1|' || b || ' A 5 ONE||A|5;2|' || b || ' A 5 TWO||A|5'", "'1'", "'0.6'", "'2/MATCHED/MEDIUM'"), ("b || ' A 5'", "b || ':1|' || b || ' A 5 ONE||A|5;2|' || b || ' A 5 TWO||A|5'", "'9'", "'0.6'", "'1/RECOVERED_API_ERROR/LOW'"), ("b || ' A 5'", "b || ':1|' || b || ' A 5 ONE||A|5;2|' || b || ' A 5 TWO||A|5'", "'x'", "'0'", "'1/RECOVERED_API_ERROR/LOW'")]),
}


def _args(name: str) -> int:
    return len(CASES[name][1][0]) - 1


def _pick(cases: list[tuple], at: int) -> str:
    whens = " ".join(f"when {i} then cast({c[at]} as string)" for i, c in enumerate(cases))
    return f"case k % {len(cases)} {whens} end"


def parts(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """SQL expressions over PARTS, families spread over all cores.  Fields are made once, behind a generator, so that they aren't written out wherever they are used."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size", F.expr("cast(floor(p_partkey / 8) as bigint)").alias("f")).repartition(tasks(spark), "f").sortWithinPartitions("p_partkey")
    made = F.struct(*[F.expr(x).alias(n) for n, x in _FIELDS.items()])
    return part.select(F.col("p_partkey").alias("k"), "f", F.inline(F.array(made))).selectExpr(*cols)


def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """part -> (k, got): arguments are built in the JVM, the operator runs over Arrow batches."""
    operator, cases = CASES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        rows = parts(spark, sf_dir, "k", *[f"{_pick(cases, i)} as a{i}" for i in range(_args(name))])

        @F.pandas_udf("string")
        def apply(args: pd.DataFrame) -> pd.Series:
            operator = CASES[name][0]
            return pd.Series([str(operator(*row)) for row in args.itertuples(index=False, name=None)], dtype="object")

        return rows.select("k", apply(F.struct(*[f"a{i}" for i in range(_args(name))])).alias("got"))

    return run


def oracle(name: str) -> str:
    cases = CASES[name][1]
    return f"select k, {_pick(cases, len(cases[0]) - 1)} as got from {PARTS}"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: query(name) for name in CASES}
ORACLE_SQL: dict[str, str] = {name: oracle(name) for name in CASES}
