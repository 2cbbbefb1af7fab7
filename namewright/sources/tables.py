"""Sources and sinks: names, vocabularies and catalogues in; sheets, reviews and totals out.

Sheets are tables: a workbook is a folder with a table for each sheet.  A version of a folder is never written over: each
run writes to its own, so the input of a run is its own backup.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import compact, null_if_missing
from ..linker.forms import coarse_forms
from ..linker.frames import link_names
from ..shipping import ship

MASTER_COLUMNS = {"product_name": None, "brand_name": None, "pack_size": "", "variant": "PLAIN", "sub_variant": "PLAIN", "product_code": ""}
EVIDENCE_COLUMNS = ("brand_name", "variant", "sub_variant", "product_name")


def resolve(df: DataFrame, name: str) -> str:
    """The column of that name, whatever its case and padding."""
    found = [c for c in df.columns if c.strip().upper() == name.upper()]
    if not found:
        raise ValueError(f"no column {name}; there are {', '.join(df.columns)}")
    return found[0]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet, csv or json table, by the path's ending; an error if it can't be read or has no rows."""
    kind = next((k for k in ("csv", "json") if path.rstrip("/").endswith(f".{k}")), "parquet")
    reader = spark.read.options(header=True, multiLine=True, escape='"') if kind == "csv" else spark.read
    try:
        df = getattr(reader, kind)(path)
        empty = df.isEmpty()
    except Exception as e:
        raise ValueError(f"can't read {path}: {str(e).splitlines()[0]}") from e
    if empty:
        raise ValueError(f"{path} has no rows")
    return df


def read_names(df: DataFrame, column: str = "PRODUCT_NAME", order: str | None = None) -> DataFrame:
    """(row_id, name), all rows.  order: a column of row numbers; without one they are given once, and hold if the result is written and read back."""
    name = df[f"`{resolve(df, column)}`"].cast("string").alias("name")
    return df.select((df[order].cast("long") if order else F.monotonically_increasing_id()).alias("row_id"), name)


def read_brands(spark: SparkSession, path: str) -> DataFrame:
    """(brand_ord, brand, brand_norm) of the quoted names in a text file; the order in it is a priority."""
    quoted = spark.read.text(path, wholetext=True).select(F.posexplode(F.regexp_extract_all("value", F.lit('"([^"]+)"'), F.lit(1))).alias("brand_ord", "brand"))
    return quoted.withColumn("brand_norm", compact(F.col("brand")))


def read_master(df: DataFrame, *kept: str) -> DataFrame:
    """The catalogue: optional columns by default, null words as null, rows without name or brand dropped; a column `ord` is kept, as are those named."""
    have = {c.strip().lower(): c for c in df.columns}
    cols = [(null_if_missing(F.col(f"`{have[c]}`"), default) if c in have else F.lit(default).cast("string")).alias(c) for c, default in MASTER_COLUMNS.items()]
    cols += [F.col(f"`{have['ord']}`").cast("long").alias("ord")] if "ord" in have else []
    out = df.select(*cols, *kept).where("product_name is not null and brand_name is not null")
    return out.withColumns({"brand_norm": compact(F.col("brand_name")), "variant": F.upper("variant"), "sub_variant": F.upper("sub_variant")})


def evidence(master: DataFrame, brands: list[str]) -> DataFrame:
    """(brand, variants, strengths, products) of the vocabulary's brands: what the catalogue says of each, its rows for one name and pack once.  Its four columns must be there."""
    missing = [c for c in EVIDENCE_COLUMNS if c not in {x.lower() for x in master.columns}]
    if missing:
        raise ValueError(f"the catalogue has no {', '.join(missing)}")
    spark = master.sparkSession
    ship(spark)
    known = spark.createDataFrame(list(enumerate(brands)), "ord int, brand string").select(compact(F.col("brand")).alias("norm"), "ord", "brand")
    known = known.groupBy("norm").agg(F.max_by("brand", "ord").alias("brand"))  # of equal norms the last name
    forms = F.udf(lambda x: sorted(coarse_forms(x)), "array<string>")
    text = lambda c: F.when(F.upper(F.trim(c)) == "PLAIN", "").otherwise(F.coalesce(compact(F.col(c)), F.lit("")))
    pack = F.coalesce("pack_size", F.lit("")) if "pack_size" in {c.lower() for c in master.columns} else F.lit("")
    rows = master.select(compact(F.col("brand_name")).alias("norm"), text("variant").alias("variant"), text("sub_variant").alias("strength"), "product_name", pack.alias("pack")).distinct()
    rows = rows.withColumn("forms", forms("product_name")).join(F.broadcast(known), "norm")
    said = lambda c, ok: F.collect_set(F.when(ok, F.col(c)))
    return rows.groupBy("norm", "brand").agg(said("variant", F.col("variant") != "").alias("variants"), said("strength", F.col("strength").rlike("[0-9]")).alias("strengths"), F.collect_list(F.struct("variant", "strength", "forms")).alias("products"))


def brand_items(master: DataFrame, *by: str) -> DataFrame:
    """(brand, items): a brand's products in order, the first of those with one name and pack.  by: columns that tell catalogues apart, each with brands of its own."""
    first = master.groupBy(*by, "brand_norm", "product_name", F.coalesce("pack_size", F.lit("")).alias("pack")).agg(F.min(F.struct("ord", "brand_name", "product_code", "variant", "sub_variant")).alias("r"))
    item = F.struct("r.ord", F.col("product_name").alias("product"), "pack", "r.variant", "r.sub_variant", "r.product_code", "r.brand_name")
    rows = first.groupBy(*by, "brand_norm").agg(F.array_sort(F.collect_list(item)).alias("items"))  # one brand's products
    return rows.select(*by, F.col("items")[0]["brand_name"].alias("brand"), "items")


def has_result(value) -> F.Column:
    """Neither null nor blank."""
    return F.trim(F.coalesce(value.cast("string"), F.lit(""))) != ""


def pending(names: DataFrame, done: DataFrame) -> DataFrame:
    """Names, not blank, without a result yet."""
    return names.where(has_result(names["name"])).join(done.where(has_result(done["result"])).select("row_id"), "row_id", "left_anti")


def first_rows(names: DataFrame, most: int | None) -> DataFrame:
    """The first rows by number; all without a limit."""
    return names if most is None else names.orderBy("row_id").limit(most)


def rows_to_link(classified: DataFrame, with_maybe: bool = False) -> DataFrame:
    """Confirmed products with their brands as hints; maybe products, if wanted, without: (..., hint, source)."""
    sure = classified.where("class = '0'").withColumns({"hint": F.expr("nullif(trim(matched_brand), '')"), "source": F.lit("0")})
    maybe = classified.where("class = 'MAYBE_PRODUCT'").withColumns({"hint": F.lit(None).cast("string"), "source": F.lit("MAYBE_PRODUCT")})
    return sure.unionByName(maybe) if with_maybe else sure


def last_results(rows: DataFrame) -> DataFrame:
    """Of each name, blanks around it aside, the result of the last row."""
    return rows.groupBy(F.trim("name").alias("name")).agg(F.max_by("result", "row_id").alias("result"), F.count(F.lit(1)).alias("n"))


def with_match(rows: DataFrame, match: F.Column) -> DataFrame:
    """A match's brand, text and kind (a struct, or null) in its three columns, the garbage columns cleared."""
    cols = {"matched_brand": match["brand"], "matched_text": match["text"], "match_type": match["kind"]}
    return rows.withColumns(cols | {c: F.lit(None).cast("string") for c in ("garbage_phrase", "garbage_match")})


def with_garbage(rows: DataFrame, match: F.Column) -> DataFrame:
    """The phrase and kind of a garbage match in their columns, those of a brand cleared."""
    cols = {"garbage_phrase": match["phrase"], "garbage_match": match["kind"]}
    return rows.withColumns({c: F.lit(None).cast("string") for c in ("matched_brand", "matched_text", "match_type")} | cols)


def review_changes(rows: DataFrame, master: DataFrame) -> DataFrame:
    """Highlighted rows (row_no, name, product_code, highlighted) linked anew, with what changes."""
    own = rows.where("highlighted")
    found = link_names(own, master).select("name", F.col("output").alias("suggested_output"), F.col("code").alias("suggested_code"), "status")
    other = (F.col("suggested_code") != "") & (F.upper(F.trim("suggested_code")) != F.upper(F.trim("product_code")))
    return own.join(found, "name").withColumn("review", F.when(other, "Suggested change").otherwise("Needs manual review"))


def usage(calls: DataFrame, input_price: float, output_price: float) -> DataFrame:
    """Tokens of calls to a model, their number, and their price (of a million tokens each)."""
    sums = calls.agg(F.sum("input_tokens").cast("long").alias("input_tokens"), F.sum("output_tokens").cast("long").alias("output_tokens"), F.count(F.lit(1)).alias("calls"))
    return sums.withColumn("price", F.round((F.col("input_tokens") * input_price + F.col("output_tokens") * output_price) / 1_000_000, 9))


def new_version(folder: str) -> str:
    """A folder of its own for a run's output."""
    return f"{folder.rstrip('/')}_{time.strftime('%Y%m%d_%H%M%S')}"


def write_results(sheets: dict[str, DataFrame], folder: str) -> list[str]:
    """Each frame to a table of its name, nulls in text as ''; a review sheet only where it has rows; other tables of the folder stay."""
    written = []
    for name, df in sheets.items():
        if name.endswith("review") and df.isEmpty():
            continue
        df.na.fill("").write.mode("overwrite").parquet(f"{folder}/{name}")
        written.append(name)
    return written
