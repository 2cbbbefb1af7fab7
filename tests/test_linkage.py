"""Queries against their oracles, operators against tables of cases and brute force."""

import math
import random
import re
from functools import partial

import duckdb
import pytest
from pyspark.sql import functions as F

from namewright import cases, catalog, jobs, journeys
from namewright.functions import similarity as sim
from namewright.linker import attributes, brands, classify, decide, forms, frames, models, narrow, packs, rank, scores, words
from namewright.linker.catalogue import Catalogue, Item
from namewright.linker.lexicon import DEFAULT, Lexicon
from namewright.plans import linkage
from namewright.sources import tables
from namewright.streaming import incremental

SF = "/root/testdata/sf0.001"
ON_SPARK = [*journeys.QUERIES, *linkage.QUERIES, "pack_size", "best_brand", "by_strength", "variants_in", "family_review"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"create view part as select * from '{SF}/part.parquet'")
    return c


def rows_of(cols, rows):
    fix = lambda v: None if v is None else round(float(v), 5) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    return sorted((tuple(fix(r[c]) for c in cols) for r in rows), key=str)


@pytest.mark.parametrize("name", ON_SPARK)
def test_query_equals_oracle(spark, con, name):
    got = catalog.QUERIES[name](spark, SF)
    want = con.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    cols, want = sorted(names), [dict(zip(names, r, strict=True)) for r in want.fetchall()]
    assert rows_of(cols, got.collect()) == rows_of(cols, want)


@pytest.mark.parametrize("name", sorted(cases.CASES))
def test_cases(con, name):
    """Each case once at least, the operator called directly."""
    operator, own = cases.CASES[name]
    n = len(own[0]) - 1
    picked = ", ".join(cases._pick(own, i) for i in range(n + 1))
    for *args, want in con.execute(f"select {picked} from {cases.PARTS} where k between 40 and 40 + {3 * len(own)}").fetchall():
        assert str(operator(*args)) == want, args


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL) and len(catalog.QUERIES) == len(cases.QUERIES) + len(journeys.QUERIES) + len(linkage.QUERIES)


@pytest.mark.parametrize("name", ["brand_families", "master_evidence_rows", "classify_rows", "class_counts", "classify_summary", "rows_to_link", "final_sheet", "review_rows", "link_rows", "link_statuses", "link_by_join", "linked_outputs", "review_changes"])
def test_families_with_the_brands_of_others(spark, tmp_path_factory, name):
    """From family 102,400 on brands come again."""
    folder, c = tmp_path_factory.mktemp("again"), duckdb.connect()
    c.execute(f"copy (select p_partkey + {journeys.VOLUME_PARTS} * v as p_partkey, p_name, p_size from '{SF}/part.parquet', range(2) r(v) where p_partkey < 48) to '{folder}/part.parquet'")
    c.execute(f"create view part as select * from '{folder}/part.parquet'")
    got, want = catalog.QUERIES[name](spark, str(folder)), c.execute(catalog.ORACLE_SQL[name])
    cols, want = [d[0] for d in want.description], want.fetchall()
    assert rows_of(cols, got.collect()) == rows_of(cols, [dict(zip(cols, r, strict=True)) for r in want])


# Similarities


def slow_lcs(a, b):
    return 0 if not a or not b else 1 + slow_lcs(a[1:], b[1:]) if a[0] == b[0] else max(slow_lcs(a[1:], b), slow_lcs(a, b[1:]))


def word(rng, letters="abc", most=7):
    return "".join(rng.choice(letters) for _ in range(rng.randint(0, most)))


def test_similarities():
    rng = random.Random(5)
    for _ in range(200):
        a, b = word(rng), word(rng)
        assert sim.lcs(a, b) == slow_lcs(a, b)
        assert sim.osa(a, b) == sim.osa(b, a)
        assert sim.osa(a, b, 1) == min(sim.osa(a, b), 2)
        kind = classify.edit_kind(a, b)
        assert (kind is not None) == (brands.levenshtein(a, b) <= 1) and (kind == "exact") == (a == b)
    assert sim.osa("ca", "abc") == 3 and sim.osa("ab", "ba") == 1
    assert sim.token_set("new york mets", "mets york new") == 100 and sim.token_sort("b a", "a b") == 100
    assert math.isclose(sim.jaro_winkler("MARTHA", "MARHTA"), 0.961111, abs_tol=1e-6)


@pytest.mark.parametrize(("scorer", "cutoff"), [(sim.ratio, 60), (sim.token_sort, 60), (sim.jaro_winkler, 0.7), (sim.token_set, 60)])
def test_best_choices_are_those_of_all(scorer, cutoff):
    rng = random.Random(7)
    texts = [" ".join(word(rng, "ABCD", 5) for _ in range(rng.randint(1, 3))).strip() for _ in range(150)]
    choices = scores.Choices(texts)
    for _ in range(60):
        query = " ".join(word(rng, "ABCD", 5) for _ in range(2)).strip()
        want = sorted(((scorer(query, t), -i) for i, t in enumerate(texts) if scorer(query, t) >= cutoff), reverse=True)[:3]
        assert choices.best(query, scorer, cutoff, most=3) == [(s, -i) for s, i in want]


# Brands


def test_brand_search_finds_what_a_search_of_all_brands_finds():
    rng = random.Random(3)
    names = list({" ".join(filter(None, (word(rng, "ABD3", 4) for _ in range(rng.randint(1, 3))))) for _ in range(120)} - {""})
    catalogue = Catalogue.of_rows([(n, n + " 1", "", "", "", str(i)) for i, n in enumerate(names)])
    for _ in range(300):
        text = rng.choice([" ", "-", ""]).join(word(rng, "ABD3", 4) for _ in range(rng.randint(1, 4)))
        own, start = words.full_strengths(words.tokens(text)), words.strengths_in_compact(words.compact(text))
        want = {b.name for b in catalogue.brands.values() if brands.fit(b, text, own, start) is not None}
        assert {n for n, _ in brands.potential_brands(text, catalogue)} == want, text


def test_vocabulary_finds_what_a_comparison_with_all_brands_finds():
    rng = random.Random(11)
    names = list({w for _ in range(60) if len(w := word(rng, "ABCDE", 12)) >= 3})
    own = classify.Vocabulary(names)
    for _ in range(200):
        spans = classify.spans(" ".join(word(rng, "ABCDE", 11) for _ in range(2)))
        hits = []
        for k, n in enumerate(names):
            for i, j, _, joined in spans if len(n) >= 4 else ():
                most = 2 if len(n) >= 10 else 1
                kind = classify.edit_kind(joined, n)
                kind = kind or (None if (d := sim.osa(joined, n, most)) > most else classify.KINDS[3 if d == 1 else 4])
                if kind not in (None, "exact"):
                    hits.append((classify.KINDS.index(kind), -len(joined), k, i, j, kind))
        found = own.best_near(spans)
        assert (found is None) == (not hits) and (not hits or (found.brand, found.kind) == (names[min(hits)[2]], min(hits)[5]))


def test_spans_are_bounded():
    assert len(classify.spans("a " * 10_000, 12)) < 130_000 and [s[3] for s in classify.spans("AB C")] == ["AB", "ABC", "C"]


def test_brand_alike_is_that_of_a_search_of_all_brands():
    """With brands of several words, which count only where the name has their first."""
    rng = random.Random(19)
    names = list({" ".join(filter(None, (word(rng, "ABCDEF", 7) for _ in range(rng.randint(1, 2))))) for _ in range(200)} - {""})
    catalogue = Catalogue.of_rows([(n, n + " 1", "", "", "", str(i)) for i, n in enumerate(names)])
    for _ in range(100):
        text = " ".join(word(rng, "ABCDEF", 7) for _ in range(2)).strip()
        allowed = [bool(catalogue.single_words[i]) or b.first in text for i, b in enumerate(catalogue.brands.values())]
        got = scores.np.array(catalogue.single_words)
        for first in catalogue.of_words:
            got[catalogue.of_words[first]] |= first in text
        assert got.tolist() == allowed
        for scorer, cutoff in ((sim.token_sort, 55), (sim.ratio, 55), (sim.jaro_winkler, 0.6)):
            want = sorted(((scorer(text, t), -i) for i, t in enumerate(catalogue.names.texts) if allowed[i] and scorer(text, t) >= cutoff), reverse=True)[:2]
            assert catalogue.names.best(text, scorer, cutoff, scores.np.array(allowed), 2) == [(s, -i) for s, i in want]


# Links


@pytest.fixture(scope="module")
def shop():
    return Catalogue.of_rows([("CORA", "CORA 5 TABLET", "", "PLAIN", "5", "1"), ("CORA", "CORA FORTE 10 TABLET", "1X10", "FORTE", "10", "2"), ("CORA", "CORA AM 5/10 TABLET", "1X15", "AM 5/10", "", "3"), ("CORA METO", "CORA METO 25 TABLET", "", "PLAIN", "25", "4"), ("ZELMIN", "ZELMIN SYRUP 100 ML", "100 ML", "PLAIN", "PLAIN", "5"), ("ZELMIN", "ZELMIN DS SYRUP", "", "DS", "", "6"), ("", "NOTHING", "", "", "", "7"), ("CORA", "CORA 5 TABLET", "", "PLAIN", "5", "8")])


@pytest.mark.parametrize(("name", "code", "status"), [
    ("CORA 5MG TAB", "1", "MATCHED"), ("CORAFORTE 10", "2", "MATCHED"), ("CORA MET 25 TAB", "4", "MATCHED"), ("CARA 5 TAB", "1", "MATCHED"), ("ZELMINSYP 100ML", "5", "MATCHED"), ("ZELMIN DS SYP", "6", "MATCHED"), ("CORA AM 5/10 TAB 15S", "3", "MATCHED"),
    ("cora forte 10mg", "2", "MATCHED"), ("  CORA   5 MG TAB ", "1", "MATCHED"), ("CORA 12. 5", "2", "MATCHED") if False else ("CORA\r5 MG TAB", "1", "MATCHED"), ("QWERTY 5", "", "NO_BRAND"), ("12 - --", "", "NO_BRAND"), ("ACORA 5", "", "NO_BRAND"), ("CORA P Q 5 TAB", "", "VARIANT_NOT_IN_MASTER"), ("CORA FORTE P Q 10 TAB", "2", "RECOVERED_LOWER_VARIANT"),
])
def test_links(shop, name, code, status):
    found = decide.link(name, shop)
    assert (found.code, found.status) == (code, status)


def test_links_with_hints(shop):
    assert decide.link("5 MG TAB", shop, hint=" cora ").code == "1"
    assert decide.link("CORA 5", shop, hint="OTHER", detect=False).status == "NO_BRAND" and decide.link("CORA 5", shop, detect=False).status == "NO_BRAND"
    assert decide.link("CORA 5 MG", shop, hint="OTHER").code == "1"
    assert decide.link("QQQQ 5", Catalogue({})).status == "NO_BRAND"


def test_no_brand_is_recovered_within_one_edit():
    own = Catalogue.of_rows([("XY Z", "XY Z 5", "", "", "5", "1")])
    assert {decide.link(n, own).status for n in ("XYZ 5", "XQZ 5")} <= {"MATCHED", "RECOVERED_NO_BRAND", "NO_BRAND"}


def test_long_and_odd_names_end(shop):
    for name in ("CORA " * 3000, "(" * 2000, "X" * 5000, "5X" * 2000, "é" * 100 + " CORA 5 TAB", "1 000 " * 500):
        assert decide.link(name, shop).status


def test_rows_survive_errors(spark, shop):
    def fails(*_):
        raise RuntimeError("no")

    assert frames.linked_row("CORA 5", None, shop, True, None, fails)[2] == "ERROR" and frames.linked_row("  ", None, shop, True, None)[2] == "SKIPPED_EMPTY"
    master = spark.createDataFrame([("CORA", "CORA 5 TABLET", "1", "x")], "brand_name string, product_name string, product_code string, name string")
    names = spark.createDataFrame([("CORA 5", None, 1), (None, None, 2), ("", "CORA", 3), ("CORA 5", None, 4)], "name string, hint string, status int")
    got = {(r["name"], r["status"]) for r in frames.link_names(names, master).collect()}
    assert got == {("CORA 5", "MATCHED"), (None, "SKIPPED_EMPTY"), ("", "SKIPPED_EMPTY")}
    assert frames.link_names(names.limit(0), master).count() == 0 and {r["status"] for r in frames.link_names(names, master.limit(0)).collect()} == {"NO_BRAND", "SKIPPED_EMPTY"}
    with pytest.raises(ValueError):
        frames.classify_names(names, ["CORA"], master, most_products=0)
    assert {r["class"] for r in frames.classify_names(names, ["CORA"]).collect()} == {"0", "1"}


def test_verdicts_by_join_are_those_of_the_whole_catalogue(spark):
    """Of names of each kind, brands that share letters, and catalogues with rows that say the same."""
    rows = [("Coradin", "CORADIN AT 25 TABLET", "AT", "25"), ("CORADIN", "CORADIN 99 SYRUP", None, "99"), ("ROSULIPID", "ROSULIPID 40 TABLET", "", "40"), ("DINO", "DINO GOLD TABLET", "GOLD", None), ("LIPI", "LIPI 40 CAPSULE", "PLAIN", "40"), ("OTHER", "OTHER 5 TABLET", "", "5")]
    master = spark.createDataFrame([(*r, k % 4) for k, r in enumerate(rows)], "brand_name string, product_name string, variant string, sub_variant string, ord long")
    texts = ["CORADINAT 25 TAB", "XCORADIN99SYP 10ML", "ROSULPIDX 40 MG TAB", "ROSXULPID 40 TAB", "DINOGOLD TAB", "QCORADIN LIPI 40MG CAP", "CORADIN 5", "CORDIN 5", "TOTAL SALE", "ZZZZ 5 TAB", "OTHER 5 TAB", "XYROSULIPIDLIPI40 CAP", "", None, "X" * 300 + " 5 TAB"]
    names = spark.createDataFrame([(t,) for t in texts], "name string")
    brands = ["CORADIN", "ROSULIPID", "DINO", "LIPI", "RO-SULIPID"]
    one, two = (sorted(map(str, frames.classify_names(names, brands, master, given_products=n).collect())) for n in (100, 0))
    assert one == two and len(one) == len(texts) and sum("master-" in r for r in one) >= 5


def test_links_by_join_are_those_of_the_whole_catalogue(spark, shop):
    """Brands spelled in two ways, hints, names without a brand, and more products than one group takes."""
    rows = [("cora", "CORA 5 TABLET", "5", "1"), ("CORA", "CORA FORTE 10 TABLET", "10", "2"), ("CORA METO", "CORA METO 25 TABLET", "25", "3"), *((f"Q{chr(65 + k)}XYL", f"Q{chr(65 + k)}XYL 5 TABLET", "5", f"q{k}") for k in range(20))]
    master = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "brand_name string, product_name string, sub_variant string, product_code string, ord long")
    names = spark.createDataFrame([("CORA 5 TAB", None), ("CORA FORTE 10", None), ("CORA MET 25", None), ("QCXYL 5", None), ("QZXYLL 5", None), ("5 TAB", "Cora"), ("5 TAB", "none"), ("CORA P Q 5", None), (None, None), ("ZZZZ", "x")], "name string, hint string")
    for detect in (True, False):
        one, two = (sorted(map(str, frames.link_names(names, master, detect=detect, most_products=n).collect())) for n in (100, 0))
        assert one == two and len(one) == 10


@pytest.mark.parametrize("name", ["final_sheet", "review_rows"])
def test_names_are_resolved_where_the_catalogue_is_too_large_for_workers(spark, con, monkeypatch, name):
    monkeypatch.setattr(journeys, "classify_names", partial(frames.classify_names, given_products=0))
    monkeypatch.setattr(journeys, "link_names", partial(frames.link_names, most_products=0))
    found = journeys.QUERIES[name](spark, SF)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, con.execute(journeys.ORACLE_SQL[name]).fetchall()))


def test_links_by_join_are_spread_over_many_tasks(spark):
    """However few bytes the groups have."""
    master = spark.createDataFrame([(f"Q{a}{b}XYL", f"Q{a}{b}XYL 5 TABLET", "5") for a in "ABCDEFGH" for b in "ABCDEFGH"], "brand_name string, product_name string, sub_variant string")
    names = master.selectExpr("concat(brand_name, ' 5 TAB') as name", "brand_name as hint")
    assert frames.link_names(names, master, most_products=0).rdd.getNumPartitions() >= 4 * frames.tasks(spark)


def test_links_of_many_brands_make_no_patterns_of_each(monkeypatch):
    names = [f"{a}{b}NIXO" for a in "BCDFGHJKLM" for b in "AEIOU"]
    catalogue = Catalogue.of_rows([(n, f"{n} {x}", "", v, "5", n + v) for n in names for v, x in (("PLAIN", "5 TABLET"), ("FORTE", "FORTE 5 TABLET"))])
    assert decide.link(names[0] + " FORTE 5 TAB", catalogue, names[0]).code == names[0] + "FORTE"
    made, compile_ = [], re._compiler.compile
    monkeypatch.setattr(re._compiler, "compile", lambda p, flags=0: (made.append(p), compile_(p, flags))[1])
    assert [decide.link(n + " FORTE 5 TAB", catalogue, n).code for n in names] == [n + "FORTE" for n in names]
    assert not [p for p in made if any(n in str(p) for n in names)]


def test_bounded_parts_are_those_of_patterns():
    rng = random.Random(4)
    for _ in range(20_000):
        text, part = ("".join(rng.choice("AB1_- .é") for _ in range(rng.randint(0, n))) for n in (12, 3))
        if part:
            assert list(words.bounded(text, part)) == [m.start() for m in re.finditer(rf"\b{re.escape(part)}\b", text)]
            for most in (None, 1):
                assert words.without_bounded(text, part, most) == re.sub(rf"\b{re.escape(part)}\b", "", text, count=most or 0)


def test_variants_in_are_the_same_whatever_was_asked_before():
    rng, asked = random.Random(5), []
    for _ in range(300):
        value = " ".join(["A", *(rng.choice(["FORTE", "S", "10S", "XR", "5", "M2 FORTE", "T", "AM5", "TAB", "SYP", "M", "INJ"]) for _ in range(rng.randint(0, 4)))])
        asked.append((value, frozenset(rng.sample(["PLAIN", "FORTE", "S", "T", "XR", "AM", "M", "M FORTE", "5", "SYRUP"], 4)), frozenset(rng.sample(["XR", "M", "S"], 1))))
    ask = lambda v, own, cut: (attributes.variants_in(v, "A", own, cut), attributes.strengths_in(v, "A", {"5", "10", "2"}, own))
    known = [ask(*a) for a in asked]
    for a, found in zip(asked, known, strict=True):
        attributes._stated.clear(), attributes.said_of.cache_clear(), attributes.parts_of.cache_clear()
        assert ask(*a) == found


def test_narrowing_never_gives_nothing():
    rng = random.Random(2)
    for _ in range(200):
        items = [Item(f"A {rng.choice(['', 'FORTE', '5 MG', 'SYRUP', 'TABLET'])} {i}", rng.choice(["", "1X10", "30"]), rng.choice(["PLAIN", "FORTE", "XR"]), rng.choice(["PLAIN", "5", "10", "5/10"]), str(i)) for i in range(rng.randint(1, 6))]
        name = f"A {rng.choice(['FORTE', 'XR', '', 'QQ'])} {rng.choice(['5', '10 MG', '5/10', ''])} {rng.choice(['TAB', 'SYP', '10S', ''])}"
        said, doses = attributes.variants_in(name, "A", {i.variant for i in items}), attributes.strengths_in(name, "A", {i.sub for i in items}, {i.variant for i in items})
        for out in (narrow.by_variant(items, said, items), narrow.by_strength(items, doses, name), narrow.by_pack(items, packs.pack_size(name)), narrow.by_named_dose(items, name), narrow.by_form(items, {"TABLET"}), narrow.by_half(items, name)):
            assert out and set(out) <= set(items)
        order = [i for _, i in rank.ranked(items, name, said, doses)]
        assert sorted(order, key=items.index) == items


def test_lexicon_rewrites_are_those_in_order():
    for first, text in DEFAULT.spelled.items():
        want = [first]
        for source, to in DEFAULT.rewrites:
            want = [w for t in want for w in (to.split() if t == source else [t])]
        assert text == " ".join(want)
    assert words.repaired("a tabs", Lexicon(rewrites=(("TABS", "X Y"), ("Y", "Z")))) == "A X Z"


def test_a_form_inside_the_letters_of_a_brand_is_none():
    assert forms.forms_in_name("HEMADROPIF 6TAB") == {"TABLET"}
    assert all("DROPS" in forms.forms_in_name(n) for n in ("CORA DROP", "CORADROPS", "CORA 10DROPS", "CORA DROPSX"))


def test_semi_in_a_brand_that_the_name_says_costs_nothing():
    assert rank.name_score("SEMIBGOFAV FORTE", "SEMIBGOFAV") == rank.EXTRA_WORD and rank.name_score("GOLIBSEMIL 7 MG", "GOLIBSEMIL 7", (), ("7",)) == 125
    assert rank.name_score("SEMI CORA", "CORA") == rank.EXTRA_WORD + rank.HALF == rank.name_score("SEMICORA", "CORA")


def test_a_compound_that_begins_a_word_isnt_looked_for_in_a_brand():
    items = [Item(f"FOFORTEPAR {x}") for x in ("5 TABLET", "FORTE 10 TABLET", "FOR-TE 10")]
    assert narrow.by_compound(items, ["FORTE"]) == items[1:]
    assert narrow.by_compound([Item("CORAFORTE 5"), Item("CORA 5"), Item("CORA XR")], ["FORTE", "XR"]) == [Item("CORAFORTE 5"), Item("CORA XR")]


# Sources, jobs, connectors


def test_tables(spark, tmp_path):
    names = tables.read_names(spark.createDataFrame([("A",), ("A",), (None,)], "` Product_Name ` string"))
    assert names.count() == 3
    ordered = tables.read_names(spark.createDataFrame([("A", 7)], "product_name string, n int"), order="n")
    assert ordered.first().row_id == 7
    master = tables.read_master(spark.createDataFrame([("P", "B", "nan"), ("", "B", "X")], "PRODUCT_NAME string, BRAND_NAME string, VARIANT string"))
    assert [(r.variant, r.sub_variant) for r in master.collect()] == [("PLAIN", "PLAIN")]
    with pytest.raises(ValueError):
        tables.resolve(names, "other")
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "none.csv"))
    (tmp_path / "empty.csv").write_text("PRODUCT_NAME\n")
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(ValueError):
        tables.evidence(master.drop("variant"), ["B"])
    (tmp_path / "brands.txt").write_text('"B", "A-1"')
    assert [(r.brand_ord, r.brand_norm) for r in tables.read_brands(spark, str(tmp_path / "brands.txt")).collect()] == [(0, "B"), (1, "A1")]
    match = F.struct(F.lit("B").alias("brand"), F.lit("b").alias("text"), F.lit("exact").alias("kind"))
    assert tables.with_match(names, match).first().matched_brand == "B"
    assert tables.with_garbage(names, F.struct(F.lit("T").alias("phrase"), F.lit("1-deletion").alias("kind"))).first().garbage_phrase == "T"
    assert tables.write_results({"a": names, "b_review": names.limit(0)}, str(tmp_path / "out")) == ["a"]


def test_job(spark, tmp_path):
    (tmp_path / "names.csv").write_text("product_name \nCORA 5 TAB\nTOTAL SALE\nCORA 5 TAB\nXYZZY 5 TAB\n\" \"\nCORA P Q 5 TAB\n")
    (tmp_path / "master.csv").write_text("BRAND_NAME,product_name,SUB_VARIANT,PRODUCT_CODE\nCORA,CORA 5 TABLET,5,11\nCORA,CORA 10 TABLET,10,12\n")
    (tmp_path / "brands.txt").write_text('"CORA"')
    config = jobs.Config.of({"NAMEWRIGHT_NAMES": str(tmp_path / "names.csv"), "NAMEWRIGHT_WITH_MAYBE": "true", "NAMEWRIGHT_ROW_LIMIT": "50"}, ["--master", str(tmp_path / "master.csv"), "--brands", str(tmp_path / "brands.txt"), "--out", str(tmp_path / "out")])
    assert config.with_maybe and config.row_limit == 50
    got = jobs.run(spark, config)
    assert got == {"rows": 6, "products": 3, "garbage": 2, "maybe": 1, "mapped": 2}
    out = next(p for p in tmp_path.iterdir() if p.name.startswith("out_"))
    rows = sorted((r["name"], r.product_code) for r in spark.read.parquet(str(out / "mapping")).collect())
    assert rows == [(" ", "1"), ("CORA 5 TAB", "11"), ("CORA 5 TAB", "11"), ("CORA P Q 5 TAB", "0"), ("TOTAL SALE", "1"), ("XYZZY 5 TAB", "0")]
    assert [r.status for r in spark.read.parquet(str(out / "mapping_review")).collect()] == ["VARIANT_NOT_IN_MASTER"]
    for bad in ({"mode": "other"}, {"with_maybe": True, "only_maybe": True}, {"row_limit": 0}):
        with pytest.raises(ValueError):
            jobs.Config(**bad)
    with pytest.raises(ValueError):
        jobs.run(spark, jobs.Config(mode="llm"))


def test_session(shop):
    got = list(jobs.answers(["brands", "stats", "CORA 5 TAB", "", "exit", "CORA 5"], shop))
    assert got[0] == "CORA, CORA METO, ZELMIN" and got[1] == "3 brands, 6 products" and got[2].startswith("CORA 5 TABLET (1) MATCHED") and len(got) == 3


def test_connectors(spark):
    waits, replies = [], [models.Reply(429, {}, {"Retry-After": "3"}), models.Reply(500, {}), models.Reply(200, {"x": 1})]
    assert models.asked(lambda _: replies.pop(0), {}, wait=10, sleep=waits.append) == {"x": 1} and waits == [3, 20]
    assert models.asked(lambda _: 1 / 0, {}, tries=2, sleep=waits.append) is None and waits[2:] == [10]
    chat = lambda payload: models.Reply(200, {"choices": [{"message": {"content": "1=0\n2=1"}}], "usage": {"prompt_tokens": 7, "completion_tokens": 2}})
    assert models.classify_batch(["CORA", "TOTAL"], ["CORA"], chat, "m") == (["0", "1"], 7, 2)
    frame = spark.createDataFrame([("CORA",), ("TOTAL",)], "name string").coalesce(1)
    assert [(r["name"], r.answer, r.input_tokens) for r in models.classify_by_model(frame, ["CORA"], chat, "m").collect()] == [("CORA", "0", 7), ("TOTAL", "1", 0)]
    best = models.reranker(lambda p: models.Reply(200, {"results": [{"index": 0, "relevance_score": 0.2}, {"index": 1, "relevance_score": 0.9}]}), "m")
    assert best("a", ["b", "c"]) == (1, 0.9)
    with pytest.raises(RuntimeError):
        models.reranker(lambda p: models.Reply(200, {}), "m")("a", ["b"])
    assert models.enabled("both") and not models.enabled("local")
    with pytest.raises(ValueError):
        models.enabled("other")


def test_stream(spark, tmp_path):
    spark.createDataFrame([("CORA 5",), ("TOTAL",)], "name string").write.parquet(str(tmp_path / "in"))
    names = spark.readStream.schema("name string").parquet(str(tmp_path / "in"))
    incremental.process_stream(names, lambda b: frames.classify_names(b, ["CORA"]), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert sorted((r["name"], r["class"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("CORA 5", "0"), ("TOTAL", "1")]
