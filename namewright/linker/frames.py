"""Classifying and linking of DataFrames: distinct names go through the linker in Arrow batches, results are joined back.

The catalogue is given to workers whole while it has at most `most_products` products.  Beyond that, workers get brands and
words of variants only, which find the brand of a name; the products of a brand's root then come by a join, in groups of
bounded numbers of names, and the name is linked among them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import once, ship, tasks
from .brands import best_brand, nearest_brands
from .catalogue import Catalogue
from .classify import Classifier, Evidence, Verdict, spans
from .decide import NONE, Link, Reranker, cleaned, link, resolve, written
from .lexicon import DEFAULT, Lexicon
from .words import comparable, compact

MOST_PRODUCTS = 300_000
#: Names and products that are linked in one group, where products come by a join (more products only where one root has them).
GROUP_NAMES, GROUP_PRODUCTS = 20_000, 50_000
MASTER = ("brand_name", "product_name", "pack_size", "variant", "sub_variant", "product_code")
EVIDENCE = ("brand_name", "product_name", "variant", "sub_variant")
LINK_DDL = "output string, code string, status string, confidence string, candidates int, suggestions string, brand string"
VERDICT_DDL = "class string, matched_brand string, matched_text string, match_type string, garbage_phrase string, garbage_match string"
_held: dict[str, Catalogue | Classifier] = {}


class Given:
    """Rows given to workers whole; each worker process keeps what it made of the last ones."""

    def __init__(self, spark: SparkSession, rows):
        self.key, self.value = uuid.uuid4().hex, spark.sparkContext.broadcast(rows)

    def made(self, make) -> Catalogue | Classifier:
        if self.key not in _held:
            _held.clear()
            _held[self.key] = make(self.value.value)
        return _held[self.key]


def master_rows(master: DataFrame) -> DataFrame:
    """The catalogue's columns as text, in their order; optional ones may be missing, an `ord` column keeps the rows' order."""
    there = {c.lower(): c for c in master.columns}
    cols = [(master[there[c]].cast("string") if c in there else F.lit(None).cast("string")).alias(c) for c in MASTER]
    return master.select(*cols, (master[there["ord"]].cast("long") if "ord" in there else F.lit(0).cast("long")).alias("ord"))


def linked_row(name: object, hint: object, catalogue: Catalogue, detect: bool, rerank: Reranker | None, find=link) -> tuple:
    """A name's result; blank names are skipped, errors become a status."""
    if name is None or not str(name).strip():
        found = Link("", status="SKIPPED_EMPTY", confidence="NONE")
    else:
        try:
            found = find(name, catalogue, hint, detect, rerank)
        except Exception as e:  # noqa: BLE001  one name never fails the others
            found = Link(f"ERROR: {str(e)[:50]}", status="ERROR", confidence="NONE")
    return found.output, found.code, found.status, found.confidence, found.candidates, written(found.suggestions), found.brand


def _linker(rows: Given, lexicon: Lexicon, detect: bool, rerank: Reranker | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        catalogue = rows.made(lambda own: Catalogue.of_rows(own, lexicon))
        for batch in batches:
            out = [linked_row(n, h, catalogue, detect, rerank) for n, h in zip(batch["name"], batch["hint"], strict=True)]
            yield pd.concat([batch.reset_index(drop=True), pd.DataFrame(out, columns=[c.split()[0] for c in LINK_DDL.split(", ")])], axis=1)

    return run


def spread(names: DataFrame, *keys: str) -> DataFrame:
    """Distinct names over all cores: linking costs far more than reading them."""
    # by another expression than the keys: what a group-by has dealt by them already would stay, in as few tasks as its bytes ask for
    return names.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")).drop("times").repartition(tasks(names.sparkSession), F.xxhash64(*keys))


def link_names(names: DataFrame, master: DataFrame, lexicon: Lexicon = DEFAULT, detect: bool = True, rerank: Reranker | None = None, most_products: int = MOST_PRODUCTS) -> DataFrame:
    """names (name, hint) -> the distinct ones with LINK_DDL.  A null hint: the brand is looked for."""
    spark = names.sparkSession
    ship(spark)
    own = spread(names.select(names["name"].cast("string").alias("name"), (names["hint"] if "hint" in names.columns else F.lit(None)).cast("string").alias("hint")), "name", "hint")
    rows = master_rows(master)
    if rows.count() > most_products:
        return _link_by_join(own, rows, lexicon, detect, rerank)
    given = Given(spark, [tuple(r)[: len(MASTER)] for r in rows.orderBy("ord").collect()])  # at most most_products rows
    return own.mapInPandas(_linker(given, lexicon, detect, rerank), f"name string, hint string, {LINK_DDL}")


class Finder(Catalogue):
    """A catalogue of brands without products: finds a name's brand, or the brands most like it."""

    def __init__(self, names: list[str], words: tuple[frozenset[str], frozenset[str]], tags: dict[str, set[str]], lexicon: Lexicon):
        super().__init__({n: [] for n in names}, lexicon)
        self.__dict__["words"], self.short = words, tags

    def tags(self, hint: object) -> set[str]:
        return self.short.get(self.key(hint) or "", set())


def root(brand: object) -> str:
    return (comparable(brand).split() or [""])[0]


def _found(finder: Given, lexicon: Lexicon, detect: bool):
    """Rows (name, hint, text, found, hinted, roots): the cleaned name, its brand, and the roots whose products its link needs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = finder.made(lambda v: Finder(*v, lexicon))
        for batch in batches:
            out = []
            for name, hint in zip(batch["name"], batch["hint"], strict=True):
                text = cleaned(name, own, hint) if name is not None else ""
                said = own.key(hint) if hint else None
                brand = said or (best_brand(text, own) if detect and text else None)
                roots = {root(brand)} if brand else {root(b) for b, _ in nearest_brands(text, own)} if detect and text else set()
                out.append((name, hint, text, brand, said is not None, sorted(roots) or [""]))
            yield pd.DataFrame(out, columns=["name", "hint", "text", "found", "hinted", "roots"])

    return run


def _link_by_join(own: DataFrame, rows: DataFrame, lexicon: Lexicon, detect: bool, rerank: Reranker | None) -> DataFrame:
    spark = own.sparkSession
    rows = once(rows.where("trim(brand_name) <> '' and trim(product_name) <> ''"))
    word = lambda c: {r[0] for r in rows.select(F.explode(F.regexp_extract_all(F.upper(c), F.lit("[A-Z]{2,}"), F.lit(0))).alias("w")).distinct().collect()}  # noqa: E731  a language's words
    # a brand is named as in its first row, as in Catalogue.of_rows
    names_of: dict[str, str] = {}
    for (brand,) in rows.groupBy("brand_name").agg(F.min("ord").alias("ord")).orderBy("ord", "brand_name").select("brand_name").collect():
        names_of.setdefault(comparable(brand), brand.strip())
    brands = [name for _, name in sorted(names_of.items())]
    tags: dict[str, set[str]] = {}
    for brand, tag in rows.where(F.upper("variant").rlike("^[A-Z]{1,4}$")).select("brand_name", F.upper("variant")).distinct().collect():
        tags.setdefault(names_of[comparable(brand)], set()).add(tag)
    finder = Given(spark, (brands, (frozenset(word("variant")), frozenset(word("sub_variant"))), tags))
    names = once(own.mapInPandas(_found(finder, lexicon, detect), "name string, hint string, text string, found string, hinted boolean, roots array<string>"))
    # roots are dealt to groups; a name without a brand needs the products of up to three roots: they travel to the first one's group
    groups = max(16 * tasks(spark), -(-rows.count() // GROUP_PRODUCTS))  # many, so that tasks get equal shares
    first = names.withColumn("group", F.pmod(F.xxhash64(F.element_at("roots", 1)), F.lit(groups)))
    sizes = first.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / GROUP_NAMES).cast("int").alias("salts"))
    dealt = first.join(sizes, "group").withColumn("salt", F.pmod(F.xxhash64("name"), F.col("salts")).cast("int"))
    root_of = F.udf(root, "string")
    families = rows.join(rows.select("brand_name").distinct().withColumn("root", root_of("brand_name")), "brand_name")
    wanted = dealt.select(F.col("group").alias("to_group"), F.col("salt").alias("to_salt"), F.explode("roots").alias("root")).distinct()
    sent = wanted.join(families, "root")

    def run(group: pd.DataFrame, products: pd.DataFrame) -> pd.DataFrame:
        products = products.sort_values("ord", kind="stable")
        catalogue = Catalogue.of_rows(products[list(MASTER)].itertuples(index=False, name=None), lexicon)
        out = []
        group = group.sort_values("found")  # what is made for a brand, patterns above all, serves all of its names
        for name, hint, text, found, hinted in group[["name", "hint", "text", "found", "hinted"]].itertuples(index=False, name=None):

            def find(*_, text=text, raw=name, brand=found or None, hinted=hinted) -> Link:
                return resolve(text, raw, brand, hinted, catalogue, rerank) if brand or detect else Link(NONE, status="NO_BRAND", confidence="NONE")

            out.append((name, hint, *linked_row(name, hint, catalogue, detect, rerank, find)))
        return pd.DataFrame(out, columns=["name", "hint"] + [c.split()[0] for c in LINK_DDL.split(", ")])

    # by number: groups are small in bytes but long in work, and would be put together into as few tasks as their bytes ask for
    shares = 4 * tasks(spark)
    left, right = dealt.repartition(shares, "group", "salt"), sent.repartition(shares, "to_group", "to_salt")
    return left.groupBy("group", "salt").cogroup(right.groupBy("to_group", "to_salt")).applyInPandas(run, f"name string, hint string, {LINK_DDL}")


def _verdicts(names, found: list[Verdict], **more) -> pd.DataFrame:
    out = [(n, v.kind, v.brand, v.text, v.match, v.phrase, v.phrase_match) for n, v in zip(names, found, strict=True)]
    return pd.DataFrame(out, columns=["name"] + [c.split()[0] for c in VERDICT_DDL.split(", ")]).assign(**more)


def _classifier(value: Given, lexicon: Lexicon, wanted: bool = False):
    """Verdicts; if wanted, with the brands of which they need what the catalogue says."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = value.made(lambda v: Classifier(*v, lexicon))
        for batch in batches:
            texts = ["" if n is None else n for n in batch["name"]]
            yield _verdicts(batch["name"], [own(t) for t in texts], **({"brands": [own.wanted(t) for t in texts]} if wanted else {}))

    return run


def classify_names(names: DataFrame, brands: list[str], master: DataFrame | None = None, lexicon: Lexicon = DEFAULT, most_products: int | None = None, given_products: int = MOST_PRODUCTS) -> DataFrame:
    """names (name) -> the distinct ones with VERDICT_DDL.

    brands: the vocabulary, in the order of its priority.  master: the catalogue, of which workers get each brand's
    distinct (product's words but numbers apart, variant, sub-variant) once; beyond `given_products` of them they come by a
    join.  most_products: more are refused.
    """
    spark = names.sparkSession
    ship(spark)
    own = spread(names.select(names["name"].cast("string").alias("name")), "name")
    rows: list[tuple] = []
    if master is not None:
        known = master_rows(master).groupBy("brand_name", "product_name", "variant", "sub_variant").agg(F.min("ord").alias("ord"))
        if (n := known.count()) > (given_products if most_products is None else min(most_products, given_products)):
            if most_products is not None and n > most_products:
                raise ValueError(f"{n} products are more than most_products = {most_products}")
            return _classify_by_join(own, brands, known, lexicon)
        rows = [tuple(r) for r in known.orderBy("ord", *EVIDENCE).select(*EVIDENCE).collect()]
    return own.mapInPandas(_classifier(Given(spark, (brands, rows)), lexicon), f"name string, {VERDICT_DDL}")


def _classify_by_join(own: DataFrame, brands: list[str], known: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Workers get the vocabulary; names about which the catalogue is asked meet the products of the brands they may be of, in groups."""
    spark = own.sparkSession
    first = once(own.mapInPandas(_classifier(Given(spark, (brands, ())), lexicon, True), f"name string, {VERDICT_DDL}, brands array<string>"))
    asked = first.where("size(brands) > 0").select("name", "brands")
    groups = max(tasks(spark), -(-asked.count() // GROUP_NAMES))
    dealt = asked.withColumn("group", F.pmod(F.xxhash64("name"), F.lit(groups)))
    wanted = dealt.select(F.col("group").alias("to_group"), F.explode("brands").alias("norm")).distinct()
    named = spark.createDataFrame([(compact(b), b) for b in {compact(b): b for b in brands}.values()] or [("", "")], "norm string, shown string")
    norm_of = F.udf(compact, "string")
    said = known.withColumn("norm", norm_of("brand_name")).join(named, "norm")
    sent = wanted.join(said, "norm")

    def run(group: pd.DataFrame, products: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(products[["ord", *EVIDENCE]].itertuples(index=False, name=None), key=lambda r: (r[0], *((x is not None, x or "") for x in r[1:])))
        evidence = Evidence(dict(zip(products["norm"], products["shown"], strict=True)), [r[1:] for r in rows], lexicon)
        bare = Classifier([], (), lexicon)
        found = [bare.verdict(n, evidence.match(n, spans(n, 0), lexicon)) for n in group["name"]]
        return _verdicts(group["name"], found)

    second = dealt.groupBy("group").cogroup(sent.groupBy("to_group")).applyInPandas(run, f"name string, {VERDICT_DDL}")
    return first.where("size(brands) = 0").drop("brands").unionByName(second)


def final_codes(links: DataFrame) -> DataFrame:
    """(name, class, code, product) of classified and linked names: garbage is 1, what isn't linked 0; names are joined without their blanks around."""
    unlinked = (NONE, "NO_BRAND", "NO_CANDIDATES", "VARIANT_NOT_IN_MASTER", "AMBIGUOUS_STRENGTH", "LOCAL_ONLY_UNRESOLVED", "API_ERROR", "ERROR", "SKIPPED_EMPTY")
    garbage, none = F.col("class") == "1", (F.col("class") != "0") | F.col("status").isNull() | F.col("status").isin(*unlinked) | F.col("status").startswith("REVIEW_") | F.col("code").isin("", "0")
    code = F.when(garbage, "1").when(none, "0").otherwise(F.col("code"))
    product = F.when(garbage, "GARBAGE").when(none, "NO SUGGESTION").otherwise(F.col("output"))
    return links.withColumns({"product_code": code, "master_product": product})


