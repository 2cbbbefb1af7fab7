"""Queries over noisy names of the table `part`: a name's noun is the brand, its adjective the variant, the size the strength.

Spark runs the linker's operators; the oracle is SQL that states the rules anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import compact, tokens
from ..linker import classify as K
from ..linker.frames import classify_names, spread
from ..linker.lexicon import Lexicon
from ..shipping import ship
from ..sources import tables

_BRAND, _VARIANT = "upper(split_part(p_name, ' ', 2))", "upper(split_part(p_name, ' ', 1))"
#: (row_id, name): every eighth name is corrupted in another way.
NAMES = f"""select p_partkey as row_id, case p_partkey % 8
  when 0 then brand || ' ' || variant || ' ' || strength || ' MG TAB'
  when 1 then substr(brand, 1, 1) || 'X' || substr(brand, 3) || ' ' || variant || ' ' || strength || ' MG 10 TAB'
  when 2 then substr(brand, 1, 2) || substr(brand, 4) || ' ' || variant || ' ' || strength || 'MG'
  when 3 then substr(brand, 1, 1) || substr(brand, 3, 1) || substr(brand, 2, 1) || substr(brand, 4) || ' ' || strength || ' CAP'
  when 4 then brand || variant || ' ' || strength || ' SYRUP 1X10'
  when 5 then brand || '-' || strength || 'MGTAB'
  when 6 then case p_partkey % 24 when 6 then 'TOTAL PAGE ' || p_partkey when 14 then '-- ' else case p_partkey % 48 when 46 then 'Grnd Total' else 'Grand  Total' end end
  else 'ZORVEX ' || strength || ' MG TAB' end as name
  from (select p_partkey, {_BRAND} as brand, {_VARIANT} as variant, cast(p_size as varchar(9)) as strength from part) p"""
#: Brands in the order of their first part, which is their priority.
BRANDS = f"select brand, row_number() over (order by first_key) as ord from (select {_BRAND} as brand, min(p_partkey) as first_key from part group by 1) b"
#: The catalogue, one row for a code.
MASTER = f"""select cast(p_partkey as varchar(20)) as product_code, p_partkey as ord, {_BRAND} as brand_name, case when {_VARIANT} = 'NEW' then 'PLAIN' else {_VARIANT} end as variant,
  cast(p_size as varchar(9)) as sub_variant, case when p_partkey % 4 = 0 then cast(null as varchar(9)) else '1X' || cast(5 * (1 + p_partkey % 3) as varchar(9)) end as pack_size,
  {_BRAND} || ' ' || {_VARIANT} || ' ' || cast(p_size as varchar(9)) || ' MG ' || p_type as product_name from part"""
#: The lexicon of these queries, and the same for the oracle.
LEXICON = Lexicon(phrases=("GRANDTOTAL", "TOTAL", "SUBTOTAL", "PAGENO"), patterns=(r"(?:TOTAL|PAGE|SUB *TOTAL|GRAND +TOTAL)", r"[^A-Za-z0-9]*(?:[A-Za-z0-9][^A-Za-z0-9]*){0,3}$"), meta_words=frozenset("TOTAL PAGE SALE STOCK GRAND DATE QTY".split()))
_PHRASES = "phrases as (select * from (values ('GRANDTOTAL'), ('TOTAL'), ('SUBTOTAL'), ('PAGENO'), ('')) v(phrase))"
_META = "t in ('TOTAL', 'PAGE', 'SALE', 'STOCK', 'GRAND', 'DATE', 'QTY')"
_COMPACT = "regexp_replace(upper({}), '[^A-Z0-9]+', '', 'g')"


def part_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """SQL over the table `part` of a folder; no view of the session's is touched."""
    return spark.sql(text.replace("from part", "from {part}"), part=spark.read.parquet(f"{sf_dir}/part.parquet"))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_sql(spark, sf_dir, NAMES)


def brands(spark: SparkSession, sf_dir: str) -> list[str]:
    """The vocabulary: a list, as its order is a priority."""
    return [r["brand"] for r in part_sql(spark, sf_dir, BRANDS).orderBy("ord").collect()]


def over_names(rows: DataFrame, operator: Callable[[str], tuple | None], ddl: str) -> DataFrame:
    """The operator's columns for each row, over distinct names; rows for which it gives nothing go."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(n, *got) for n in batch["name"] if (got := operator(n)) is not None]
            yield pd.DataFrame(found, columns=["name"] + [c.split()[0] for c in ddl.split(", ")])

    return rows.join(spread(rows.select("name"), "name").mapInPandas(run, f"name string, {ddl}"), "name").drop("name")


def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("row_id", compact(F.col("name")).alias("norm"))


def row_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = tokens(F.col("name"))
    return names(spark, sf_dir).select("row_id", F.array_join(own, " ").alias("toks"), F.size(own).alias("n"))


def token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs of words, in the row: starts, then ends."""
    t = F.col("t")
    ends = lambda i: F.transform(F.sequence(i, F.size(t)), lambda j: F.struct(i.alias("i"), j.alias("j"), F.array_join(F.slice(t, i, j - i + 1), "").alias("norm")))
    rows = names(spark, sf_dir).select("row_id", tokens(F.col("name")).alias("t")).where(F.size("t") > 0)
    return rows.select("row_id", F.inline(F.flatten(F.transform(F.sequence(F.lit(1), F.size(t)), ends)))).select("row_id", "i", "j", "norm")


def vocab_exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = K.Vocabulary(brands(spark, sf_dir))
    return over_names(names(spark, sf_dir), lambda n: (m.brand,) if (m := own.first_exact(K.spans(n, own.longest))) else None, "brand string")


def fuzzy_edit1(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = K.Vocabulary(brands(spark, sf_dir))
    return over_names(names(spark, sf_dir), lambda n: (m.brand, m.kind) if not own.first_exact(s := K.spans(n, own.longest + 2)) and (m := own.best_near(s)) else None, "brand string, match_type string")


def exact_garbage(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = spark.createDataFrame([(p,) for p in K.garbage_phrases(LEXICON)], "norm string")
    return names(spark, sf_dir).select("row_id", compact(F.col("name")).alias("norm")).join(F.broadcast(phrases), "norm", "left_semi").select("row_id")


def pattern_garbage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_names(names(spark, sf_dir), lambda n: (True,) if K.is_garbage_pattern(n, LEXICON) else None, "hit boolean").select("row_id")


def metadata_garbage(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, known = F.regexp_extract_all(F.upper("name"), F.lit("[A-Z]+"), F.lit(0)), F.array(*[F.lit(w) for w in sorted(LEXICON.meta_words)])
    return names(spark, sf_dir).where((F.size(words) > 0) & F.forall(words, lambda w: F.array_contains(known, w))).select("row_id")


def fuzzy_garbage(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = K.garbage_phrases(LEXICON)
    return over_names(names(spark, sf_dir), lambda n: (m[0],) if (m := K.near_phrase(n, phrases)) else None, "phrase string")


def maybe_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_names(names(spark, sf_dir), lambda n: (K.has_form(n), K.has_quantity(n)), "has_form boolean, has_quantity boolean")


def classify_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By vocabulary and garbage alone."""
    rows = names(spark, sf_dir)
    found = classify_names(rows, brands(spark, sf_dir), lexicon=LEXICON)
    return rows.join(found, "name").select("row_id", "name", "class", F.expr("nullif(matched_brand, '')").alias("matched"), F.when(F.col("class") == "0", F.col("match_type")).alias("match_type"))


def master_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product for a name and pack: the first."""
    rows = tables.read_master(part_sql(spark, sf_dir, MASTER))
    first = rows.groupBy(F.col("brand_name").alias("brand"), F.col("product_name").alias("product"), F.col("pack_size").alias("pack"))
    return first.agg(F.min_by("product_code", "ord").alias("code"), F.count(F.lit(1)).alias("n"))


def brand_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = tables.brand_items(tables.read_master(part_sql(spark, sf_dir, MASTER)))
    return items.select("brand", F.size("items").alias("n"), F.col("items")[0]["product_code"].alias("first_code"))


_NAMES, _BRANDS = f"names as ({NAMES})", f"brands as ({BRANDS})"
_SPANS = """toks as (select row_id, name, regexp_extract_all(upper(name), '[A-Z0-9]+') as t from names), starts as (select row_id, t, unnest(generate_series(1, len(t))) as i from toks where len(t) > 0),
  pairs as (select row_id, t, i, unnest(generate_series(i, len(t))) as j from starts), spans as (select row_id, i, j, array_to_string(list_slice(t, i, j), '') as norm from pairs)"""
_EXACT = f"""{_NAMES}, {_BRANDS}, {_SPANS}, hits as (select row_id, ord, i, j, b.brand from spans s join brands b on s.norm = b.brand where length(b.brand) > 3 or i = j),
  exact as (select row_id, arg_min(brand, row(ord, i, j)) as brand from hits group by row_id)"""
_SWAPPED = "(damerau_levenshtein(norm, brand) = 1 and levenshtein(norm, brand) = 2)"
_FUZZY = f"""{_EXACT}, near as (select s.row_id, i, norm, b.brand, b.ord, case when levenshtein(norm, b.brand) = 1 then case when length(norm) = length(b.brand) then 0 when length(norm) < length(b.brand) then 1 else 2 end when {_SWAPPED.replace('brand', 'b.brand')} then 3 else 4 end as rnk
    from spans s join brands b on abs(length(norm) - length(b.brand)) <= 2 and length(b.brand) >= 4 where s.row_id not in (select row_id from exact) and (levenshtein(norm, b.brand) = 1 or {_SWAPPED.replace('brand', 'b.brand')} or (length(b.brand) >= 10 and levenshtein(norm, b.brand) = 2))),
  fuzzy as (select row_id, arg_min(brand, row(rnk, -length(norm), ord, i)) as brand, min(rnk) as rnk from near group by row_id)"""
_KIND = "case rnk when 0 then '1-substitution' when 1 then '1-insertion' when 2 then '1-deletion' when 3 then '1-transposition' else '2-edit' end"
_NEAR = f"""garbage_near as (select row_id, p.phrase, case when length(norm) = length(phrase) then 0 when length(norm) < length(phrase) then 1 else 2 end as rnk
      from (select row_id, {_COMPACT.format('name')} as norm from names) n join phrases p on abs(length(norm) - length(p.phrase)) <= 1 and length(p.phrase) >= 1 and length(norm) >= 1 and levenshtein(norm, p.phrase) = 1)"""
_PATTERN = f"regexp_matches(upper(trim(name)), '^(TOTAL|PAGE|SUB *TOTAL|GRAND +TOTAL)') or length({_COMPACT.format('name')}) <= 3"
_JUNK = "(select row_id from (select row_id, regexp_extract_all(upper(name), '[A-Z]+') as w from names) x where len(w) > 0 and len(list_filter(w, lambda t: not (" + _META + "))) = 0)"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (normalize_names, row_tokens, token_spans, vocab_exact_match, fuzzy_edit1, exact_garbage, pattern_garbage, metadata_garbage, fuzzy_garbage, maybe_product, classify_full, master_dedupe, brand_items)
}
ORACLE_SQL: dict[str, str] = {
    "normalize_names": f"with {_NAMES} select row_id, {_COMPACT.format('name')} as norm from names",
    "row_tokens": f"with {_NAMES} select row_id, trim(regexp_replace(upper(name), '[^A-Z0-9]+', ' ', 'g')) as toks, len(regexp_extract_all(upper(name), '[A-Z0-9]+'))::int as n from names",
    "token_spans": f"with {_NAMES}, {_SPANS} select row_id, i::int as i, j::int as j, norm from spans",
    "vocab_exact_match": f"with {_EXACT} select row_id, brand from exact",
    "fuzzy_edit1": f"with {_FUZZY} select row_id, brand, {_KIND} as match_type from fuzzy",
    "exact_garbage": f"with {_NAMES}, {_PHRASES} select row_id from names n join phrases p on {_COMPACT.format('n.name')} = p.phrase",
    "pattern_garbage": f"with {_NAMES} select row_id from names where {_PATTERN}",
    "metadata_garbage": f"with {_NAMES} select row_id from {_JUNK} y",
    "fuzzy_garbage": f"with {_NAMES}, {_PHRASES}, {_NEAR} select row_id, arg_min(phrase, row(rnk, -length(phrase), phrase)) as phrase from garbage_near group by row_id",
    "maybe_product": f"with {_NAMES} select row_id, len(list_intersect(regexp_extract_all(upper(name), '[A-Z0-9]+'), ['TAB', 'CAP', 'SYRUP'])) > 0 as has_form, (regexp_matches(upper(name), '(^|[ -])[0-9]+ ?MG( |$)') or name like '%1X10' or regexp_matches(name, '[0-9] (TAB|CAP)$')) as has_quantity from names",
    "classify_full": f"""with {_FUZZY}, {_PHRASES}, {_NEAR} select n.row_id, n.name, coalesce(e.brand, f.brand) as matched, case when e.brand is not null then 'exact' when f.brand is not null then {_KIND} end as match_type,
      case when coalesce(e.brand, f.brand) is not null then '0' when {_COMPACT.format('n.name')} in (select phrase from phrases) or {_PATTERN} or n.row_id in {_JUNK} or n.row_id in (select row_id from garbage_near) then '1' else 'MAYBE_PRODUCT' end as class
      from names n left join exact e on n.row_id = e.row_id left join fuzzy f on n.row_id = f.row_id""",
    "master_dedupe": f"select brand_name as brand, product_name as product, coalesce(pack_size, '') as pack, min_by(product_code, ord) as code, count(*) as n from ({MASTER}) m group by 1, 2, 3",
    "brand_items": f"select brand_name as brand, count(distinct product_name || '|' || coalesce(pack_size, ''))::int as n, min_by(product_code, ord) as first_code from ({MASTER}) m group by 1",
}
