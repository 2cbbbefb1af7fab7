"""The word lists, tables and limits that cleaning, linking and classifying go by, as one immutable value.

Every function of this package takes a Lexicon, so a user's own lists need no change of code: `replace` of dataclasses gives
another one.  Brand-scoped rules are rows of tables (`pins`, `scopes`, `families`, `exceptions`), empty by default.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

#: Dosage units, dosage forms and their spellings, and other words that aren't part of a brand.
UNITS = ("MG", "GM", "ML", "MCG", "IU", "UNIT")
HINTS = (
    "TA TAB TABS TABLET TABLETS CAP CAPS CAPSULE CAPSULES DROP DROPS SYP SYRUP TONIC SUSPENSION INJ INJECTION CREAM GEL "
    "OINTMENT LOTION PLUS BAR BARS GRANUL GRANULES IN SYR SUSP AMP AMPS AMPOULE AMPOULES PFS VIAL PEN CHOCOLATE ELAICHI "
    "KESAR CHOCO CHOC ELA ELAI ELAICH ELAC ELACHI KES KESA FLV FLAV FLAVOUR CHOCH"
).split()
NOT_BRANDS = "PCS PC NOS NO VIAL AMP AMPS PFS SYR POWDE POWDER GRANUL GRANULE GRANULES GRANULS LACT LACTATION".split()
MATCH_WORDS = {
    "TA": "TABLET", "TAB": "TABLET", "TABS": "TABLET", "TABLETS": "TABLET", "CAP": "CAPSULE", "CAPS": "CAPSULE", "CAPSULES": "CAPSULE", "INJ": "INJECTION", "INJECTIONS": "INJECTION", "DROP": "DROPS",
    "SYP": "SYRUP", "BARS": "BAR", "GRANUL": "GRANULES", "LOT": "LOTION", "LO": "LOTION", "CRM": "CREAM", "CR": "CREAM",
}
FORM_WORDS = "TABLET CAPSULE INJECTION SYRUP DROPS CREAM LOTION GEL OINTMENT SOLUTION SUSPENSION POWDER SACHET BAR GRANULES".split()
#: Spellings and what they stand for, in the order in which they hold.
REWRITES = (
    ("FORT", "FORTE"), ("FORTS", "FORTE"), ("FOURT", "FORTE"), ("ING", "INJECTION"), ("INJ", "INJECTION"), ("INJN", "INJECTION"), ("INJG", "INJECTION"), ("INJE", "INJECTION"), ("INJD", "INJECTION"), ("INGD", "INJECTION"),
    ("SYR", "SYRUP"), ("SYP", "SYRUP"), ("SY", "SYRUP"), ("SUSP", "SUSPENSION"), ("SUSPN", "SUSPENSION"), ("AMP", "INJECTION"), ("AMPS", "INJECTION"), ("AMPUL", "INJECTION"), ("AMPULE", "INJECTION"), ("AMPULES", "INJECTION"),
    ("AMPOUL", "INJECTION"), ("AMPOULS", "INJECTION"), ("AMPOULE", "INJECTION"), ("AMPOULES", "INJECTION"), ("AMPOULEP", "INJECTION"), ("IN", "INJECTION"), ("VL", "VIAL"), ("VAIL", "VIAL"), ("VALE", "VIAL"),
    ("TAB", "TABLET"), ("TABS", "TABLET"), ("TA", "TABLET"), ("TABLETS", "TABLET"), ("TABD", "TABLET"), ("TABLETP", "TABLET"), ("TABLETNU", "TABLET"), ("CAP", "CAPSULE"), ("CAPS", "CAPSULE"), ("CAPSULES", "CAPSULE"),
    ("CAPD", "CAPSULE"), ("CAPSUL", "CAPSULE"), ("CAPSULS", "CAPSULE"), ("DROP", "DROPS"), ("DROPSP", "DROPS"), ("NEDDLES", "NEEDLES"), ("NEEDALES", "NEEDLES"), ("PAKET", "PACK"), ("PACKET", "PACK"), ("BIG", ""), ("MCP", ""),
    ("CREA", "CREAM"), ("CRM", "CREAM"), ("CR", "CREAM"), ("OINT", "OINTMENT"), ("OINTM", "OINTMENT"), ("OINTB", "OINTMENT"), ("LOT", "LOTION"), ("POW", "POWDER"), ("GRANUL", "GRANULES"), ("GRANU", "GRANULES"),
    ("GRANULS", "GRANULES"), ("GRANULIS", "GRANULES"), ("BARS", "BAR"), ("CHEB", "CHEWABLE"), ("SYNDEN", "SYNDET"), ("MOISTURIS", "MOISTURIZING"), ("MOIST", "MOISTURE"), ("HYD", "HYDRATING"), ("HYDRO", "HYDRATING"),
    ("CLEN", "CLEAN"), ("FACEWASH", "FACE WASH"), ("FAC", "FACE"), ("FLV", "FLAVOR"), ("FLAV", "FLAVOR"), ("FLAVOUR", "FLAVOR"), ("CHO", "CHOCOLATE"), ("CHOC", "CHOCOLATE"), ("CHOCO", "CHOCOLATE"), ("CHOCH", "CHOCOLATE"),
    ("ELA", "ELAICHI"), ("ELAI", "ELAICHI"), ("ELAC", "ELAICHI"), ("ELACHI", "ELAICHI"), ("ELAICH", "ELAICHI"), ("KES", "KESAR"), ("KESA", "KESAR"),
)
ORAL_WORDS = "TABLET TABLETS TAB TABS CAPSULE CAPSULES CAP CAPS SYRUP SYP DROPS DROP SUSPENSION SUSP CREAM GEL OINTMENT LOTION SACHET POWDER POWD GRANULES GRANULE SPRAY NASALSPRAY SOLUTION SOL TONIC BAR KIT".split()
DOSE_NOISE = "MG GM ML MCG G M IU UNIT TAB TABS TABLET TABLETS INJ INJECTION PFS VIAL AMP AMPS SYR SYRINGE PEN".split()
#: Forms and how a name, or a product, says them.
INPUT_FORMS = (
    ("DROPS", r"DROPS?\b|(?<![A-Z])DROPS?[A-Z]*\b"), ("SUSPENSION", r"\bSUSPENSIONS?\b|\bSUSP\.?\b|\bSUSPN\b|\bSYRUPS?\b|\bSYP\.?\b|\d+SYP\b"), ("TABLET", r"\bTABLETS?\b|\bTABS?\.?\b|\bTA\b|\d+TABLETS?|\d+TABS?\b"),
    ("CAPSULE", r"\bCAPSULES?\b|\bCAPS?\.?\b|\d+CAPSULES?|\d+CAPS?\b"), ("INJECTION", r"\bINJECTIONS?\b|\bINJ\.?\b|\bING\.?\b|\d+INJ\b|\bVIAL\b|\bPFS\b|\bAMPS?\b|\bSYR\.?\b|\d+SYR\.?\b|\bI\.?V\.?\b"), ("CREAM", r"\bCREAMS?\b|\bCRM\.?\b"),
    ("OINTMENT", r"\bOINTMENTS?\b|\bOI\.?\b|\bOINT\.?\b"), ("GEL", r"\bGELS?\b"), ("SOLUTION", r"\bSOLUTIONS?\b|\bSOL\.?\b"), ("POWDER", r"\bPOWDERS?\b|\bPOW\.?\b"), ("BAR", r"\bBARS?\b|\bSYNDET\b"),
    ("GRANULES", r"\bGRANULES?\b|\bGRANULS?\b"), ("SACHET", r"\bSACHETS?\b"), ("LOTION", r"\bLOTIONS?\b|\bLOT\.?\b|\bLO\b"), ("TONIC", r"\bTONICS?\b"),
)
PRODUCT_FORMS = (
    ("DROPS", r"\bDROPS?\b"), ("SUSPENSION", r"\bSUSPENSIONS?\b|\bSUSP\.?\b|\bSUSPN\b|\bSYRUPS?\b|\bSYP\.?\b|\d+SYP\b|\bSYR\.?\b|\d+SYR\.?\b"), ("TABLET", r"\bTABLETS?\b|\bTABS?\.?\b"), ("CAPSULE", r"\bCAPSULES?\b|\bCAPS?\.?\b"),
    ("INJECTION", r"\bINJECTIONS?\b|\bINJ\.?\b|\bING\.?\b|\d+INJ\b|\bVIAL\b|\bPFS\b|\bAMPS?\b|\bI\.?V\.?\b"), ("CREAM", r"\bCREAMS?\b"), ("OINTMENT", r"\bOINTMENTS?\b"), ("GEL", r"\bGELS?\b"), ("SOLUTION", r"\bSOLUTIONS?\b|\bSOL\b"),
    ("POWDER", r"\bPOWDERS?\b"), ("BAR", r"\bBARS?\b|\bSYNDET\b"), ("GRANULES", r"\bGRANULES?\b|\bGRANULS?\b"), ("SACHET", r"\bSACHETS?\b"), ("LOTION", r"\bLOTIONS?\b"), ("TONIC", r"\bTONICS?\b"),
)
FORM_GROUPS = {
    "TABLET": "solid", "CAPSULE": "solid", "SUSPENSION": "liquid", "SYRUP": "liquid", "SOLUTION": "liquid", "DROPS": "liquid", "TONIC": "liquid", "INJECTION": "parenteral", "CREAM": "topical", "GEL": "topical",
    "OINTMENT": "topical", "LOTION": "topical", "POWDER": "powder", "GRANULES": "powder", "SACHET": "powder", "BAR": "bar",
}
COARSE_FORMS = (
    ("TAB", ("TAB",)), ("CAP", ("CAP",)), ("INJ", ("INJ", "VIAL")), ("DROP", ("DROP",)), ("SYP", ("SYRUP", "SYP", "SUSP")), ("CREAM", ("CREAM",)), ("OINT", ("OINT",)), ("GEL", ("GEL",)), ("SOL", ("SOL",)),
)
INJECTION_WORDS = "IV INJ INJECTION VIAL PFS AMP AMPS SYR SYRINGE".split()
FLAVORS = {w: f for f, spelled in (("CHOCOLATE", "CHOCOLATE CHOC CHOCO CHOCH"), ("ELAICHI", "ELAICHI ELAICH ELACHI ELAC ELA ELAI"), ("KESAR", "KESAR KESA KES")) for w in spelled.split()}
#: Variants that a name may carry as a word of its own, and letters that may be glued to a number.
SUFFIXES = "FORTE XR SR ER MR DS OD CR X H AM M METO PROTECT PLUS XT D CT BS LT TM OH AT D3 MV F GM L XL NT ME GRS P S".split()
LETTERS = "HLMXDFSPTZQVWY"
GHOSTS = "FORTE BETA MD AMH EZ LAR XR SR CR PLUS DS OD MR ER SEMI".split()
COUNTS = (10, 15, 20, 30, 14, 21, 28, 7, 5)
#: Classifier: signals of a product, words that speak against one, and garbage.
FORM_SIGNAL = (
    r"\b(?:TABS?|TABLETS?|CAPS?|CAPSULES?|SYP|SYRUP|INJ|INJN|OINT|OINTMENT|CREAM|GEL|DROPS?|LOTION|SUSP|SUSPENSION|SACHET?|SACH|POWDER|SPRAY|INHALER|PATCH|SYRINGE|VIAL|AMP|AMPULE|AMPOULE|SOLUTION|SOLN|SYR|SUS|SOL|PFS|LOZENGE|"
    r"SUPPOSITORIES?|SUPPOS?|SUPPO|SUPP|ENEMA|EYE|EAR|NASAL|CHEWABLE|EFFERVESCENT)\b"
)
QUANTITY_SIGNAL = r"\b\d+\.?\d*\s*(?:MG|MCG|IU|ML|GM|G)\b|\b\d+\s*[X*]\s*\d+\b|\b\d+'?\s*S\b|\b\d+\s*(?:TAB|TABS|CAP|CAPS|VIAL|AMP)\b|\b\d+\s*MD\b|\bPCS\b"
GUARD = "TOTAL SALE PURCHASE INVOICE STOCK VALUE REPORT SUMMARY IMPORT CALL".split()
PHRASES = ("GRAND TOTAL", "TOTAL", "SUB TOTAL", "PAGE NO", "STOCK STATEMENT", "SALES REPORT", "PRODUCT NAME", "ITEM NAME")
PATTERNS = (r"(?:TOTAL|PAGE|SUB *TOTAL|GRAND +TOTAL)\b", r"\d[\d.,/ -]*$", r"[^A-Za-z0-9]*(?:[A-Za-z0-9][^A-Za-z0-9]*){0,3}$", r"(?:DATE|FROM|PERIOD)\s*[:.]", r"CONTINUED\b")
META_WORDS = (
    "TOTAL SUBTOTAL GRAND GRANDTOTAL VALUE QUANTITY QTY AMOUNT NET GROSS SUM MRP RATE DISCOUNT CREDIT DEBIT BALANCE PURCHASE SALE SALES INVOICE RS PAGE REPORT SUMMARY ANALYSIS GROUP CATEGORY DIVISION COMPANY SUPPLIER "
    "MANUFACTURER DISTRIBUTOR DATE MONTH YEAR PERIOD CONTINUED STOCK CLOSING OPENING CARRY FORWARD PRODUCT ITEM NAME PACKING PACK UNIT UOM DETAIL DETAILS DESCRIPTION CODE TYPE SRNO SR ID NO COL BLANK HEADER PARTICULARS PKG "
    "STRENGTH LAST CURRENT NEW MOVING NON ABOVE DAYS JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC IN OF BY THE AND FOR TO AT FROM THIS SUB WISE BRAND STARTS HERE SECTION SCHEDULE SHELF"
).split()


@dataclass(frozen=True)
class Exception_:
    """A match of `brand` is dropped, or makes the row garbage, or becomes another brand, where `pattern` is found (or, if `absent`, isn't)."""

    brand: str
    pattern: str
    action: str  # drop, garbage, or rename
    absent: bool = False
    to: str = ""
    within: str = "name"  # name, compact or matched


@dataclass(frozen=True)
class Pin:
    """Names of `brand` in which all of `include` and none of `exclude` are found are of the product `code`."""

    brand: str
    code: str
    include: tuple[str, ...]
    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class Scope:
    """Products `codes` of `brand` are only candidates where (if `only`) or unless `pattern` is found."""

    brand: str
    codes: frozenset[str]
    patterns: tuple[str, ...]
    only: bool = False


@dataclass(frozen=True)
class Family:
    """Products `codes` (all of which the catalogue must have) whose links need review unless name, form and pack agree."""

    brand: str
    codes: frozenset[str]
    variants: frozenset[str]
    form: str
    active: tuple[str, ...] = ()  # a name is of the family if it has a variant of it or one of these; empty: always
    cues: tuple[tuple[str, str], ...] = ()  # (word, variant)
    unclear: tuple[str, ...] = ()  # patterns of qualifiers that can't be told
    default: str = ""  # the variant for a name without one, where form and pack agree


@dataclass(frozen=True)
class Lexicon:
    units: tuple[str, ...] = UNITS
    hints: frozenset[str] = frozenset(HINTS)
    not_brands: frozenset[str] = frozenset(NOT_BRANDS)
    match_words: dict = field(default_factory=lambda: dict(MATCH_WORDS), hash=False)
    form_words: frozenset[str] = frozenset(FORM_WORDS)
    rewrites: tuple[tuple[str, str], ...] = REWRITES
    oral_words: frozenset[str] = frozenset(ORAL_WORDS)
    dose_noise: frozenset[str] = frozenset(DOSE_NOISE)
    input_forms: tuple[tuple[str, str], ...] = INPUT_FORMS
    product_forms: tuple[tuple[str, str], ...] = PRODUCT_FORMS
    form_groups: dict = field(default_factory=lambda: dict(FORM_GROUPS), hash=False)
    coarse_forms: tuple[tuple[str, tuple[str, ...]], ...] = COARSE_FORMS
    injection_words: frozenset[str] = frozenset(INJECTION_WORDS)
    flavors: dict = field(default_factory=lambda: dict(FLAVORS), hash=False)
    suffixes: tuple[str, ...] = tuple(SUFFIXES)
    letters: str = LETTERS
    ghosts: frozenset[str] = frozenset(GHOSTS)
    counts: tuple[int, ...] = COUNTS
    makers: tuple[str, ...] = ()
    phrases: tuple[str, ...] = PHRASES
    patterns: tuple[str, ...] = PATTERNS
    meta_words: frozenset[str] = frozenset(META_WORDS)
    guard: tuple[str, ...] = tuple(GUARD)
    exact_only: frozenset[str] = frozenset()
    review_brands: frozenset[str] = frozenset()
    weak_brands: frozenset[str] = frozenset()  # brands that are words of other names, too
    fused: dict = field(default_factory=dict, hash=False)  # compact row -> (brand, variant)
    known_products: tuple[str, ...] = ()
    exceptions: tuple[Exception_, ...] = ()
    pins: tuple[Pin, ...] = ()
    aliases: dict = field(default_factory=dict, hash=False)  # brand -> ((pattern, text), ...)
    kept_variants: dict = field(default_factory=dict, hash=False)  # brand -> variants that a word behind it pins
    scopes: tuple[Scope, ...] = ()
    families: tuple[Family, ...] = ()
    flavored: dict = field(default_factory=dict, hash=False)  # brand -> (word of the family, default flavour)
    dosed_tablets: frozenset[str] = frozenset()  # brands whose glued MG dose means tablets

    def __hash__(self) -> int:
        """Cheap, as it is taken for every text that is looked up; equal values have equal sizes."""
        return len(self.phrases)

    @cached_property
    def skip(self) -> frozenset[str]:
        """Words that never make a brand longer."""
        return self.hints | set(self.units) | self.not_brands

    @cached_property
    def spelled(self) -> dict[str, str]:
        """What a word becomes when all rewrites are tried in order, each on what those before it left."""
        out = {}
        for first in {a for a, _ in self.rewrites}:
            text = first
            for source, to in self.rewrites:
                text = " ".join(w for t in text.split() for w in (to.split() if t == source else [t]))
            out[first] = text
        return out

    @cached_property
    def rewrite_pattern(self) -> re.Pattern:
        return re.compile(r"\b(?:" + "|".join(map(re.escape, sorted(self.spelled, key=len, reverse=True))) + r")\b")

    @cached_property
    def input_form_patterns(self) -> list[tuple[str, re.Pattern]]:
        return [(f, re.compile(p)) for f, p in self.input_forms]

    @cached_property
    def product_form_patterns(self) -> list[tuple[str, re.Pattern]]:
        return [(f, re.compile(p)) for f, p in self.product_forms]

    @cached_property
    def guard_pattern(self) -> re.Pattern:
        return re.compile(r"\b(?:" + "|".join(self.guard) + r")\b", re.I)

    @cached_property
    def garbage_patterns(self) -> list[re.Pattern]:
        return [re.compile(p, re.I) for p in self.patterns]


DEFAULT = Lexicon()
