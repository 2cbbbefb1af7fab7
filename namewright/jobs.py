"""Jobs: classify and link a table of names, write the sheets, and say what came of it.

python -m namewright.jobs --names NAMES --master MASTER --brands BRANDS --out FOLDER; each option can be given as an
environment variable, too (NAMEWRIGHT_NAMES, ...).  The input is never written to: each run's output is a folder of its own.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .linker.catalogue import Catalogue
from .linker.decide import Reranker, link, written
from .linker.frames import classify_names, final_codes, link_names
from .linker.lexicon import DEFAULT, Lexicon
from .linker.models import MODES
from .sources import tables


@dataclass(frozen=True)
class Config:
    """What a job does; immutable, made once of defaults, environment and arguments."""

    names: str = ""
    master: str = ""
    brands: str = ""
    out: str = ""
    column: str = "PRODUCT_NAME"
    mode: str = "local"
    with_maybe: bool = False
    only_maybe: bool = False
    row_limit: int | None = None

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"mode {self.mode} is none of {', '.join(MODES)}")
        if self.with_maybe and self.only_maybe:
            raise ValueError("with_maybe and only_maybe exclude each other")
        if self.row_limit is not None and self.row_limit < 1:
            raise ValueError("row_limit must be at least 1")

    @classmethod
    def of(cls, environment: dict[str, str], arguments: Iterable[str] = ()) -> Config:
        """Defaults, then NAMEWRIGHT_* variables, then arguments."""
        parser = argparse.ArgumentParser(prog="namewright", argument_default=argparse.SUPPRESS)
        flags = {"with_maybe", "only_maybe"}
        for f in fields(cls):
            parser.add_argument(f"--{f.name.replace('_', '-')}", **({"action": "store_true"} if f.name in flags else {"type": int} if f.name == "row_limit" else {}))
        said = {f.name: environment[k] for f in fields(cls) if (k := f"NAMEWRIGHT_{f.name.upper()}") in environment}
        for name in set(said) & flags:
            said[name] = said[name].lower() in ("1", "true", "yes")
        if "row_limit" in said:
            said["row_limit"] = int(said["row_limit"])
        return cls(**(said | vars(parser.parse_args(list(arguments)))))


def classify_phase(names: DataFrame, brands: list[str], master: DataFrame | None, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """All rows, in their number, with the classifier's columns."""
    return names.join(classify_names(names, brands, master, lexicon), "name", "left")


def link_phase(classified: DataFrame, master: DataFrame, config: Config = Config(), lexicon: Lexicon = DEFAULT, rerank: Reranker | None = None) -> DataFrame:
    """Rows that are linked (confirmed products, maybe products if the job says so), with the linker's columns."""
    rows = tables.rows_to_link(classified, config.with_maybe or config.only_maybe)
    rows = tables.first_rows(rows.where("source <> '0'") if config.only_maybe else rows, config.row_limit)
    found = link_names(rows, master, lexicon, detect=True, rerank=rerank)
    return rows.join(found, rows["name"].eqNullSafe(found["name"]) & rows["hint"].eqNullSafe(found["hint"]), "left").drop(found["name"], found["hint"])


def sheets(classified: DataFrame, linked: DataFrame) -> dict[str, DataFrame]:
    """The job's results: all rows as they were classified, all rows with their final codes, rows to review, and how often each status came."""
    found = linked.select("row_id", "output", "code", "status", "confidence", "suggestions")
    rows = final_codes(classified.join(found, "row_id", "left"))
    review = rows.where("class = '0' and (product_code = '0' or confidence = 'LOW' or status like 'REVIEW%')")
    return {
        "garbage_check": classified,
        "mapping": rows.select("row_id", "name", "product_code", "master_product"),
        "mapping_review": review.select("row_id", "name", "product_code", "master_product", "status", "confidence", "suggestions"),
        "statuses": linked.groupBy("status").agg(F.count(F.lit(1)).alias("n")),
    }


def summary(classified: DataFrame, mapping: DataFrame) -> dict[str, int]:
    """How many rows there are, of each class and with a code."""
    counts = classified.agg(F.count(F.lit(1)), F.count_if(F.col("class") == "0"), F.count_if(F.col("class") == "1")).first()
    mapped = mapping.where("product_code not in ('0', '1')").count()
    return {"rows": counts[0], "products": counts[1], "garbage": counts[2], "maybe": counts[0] - counts[1] - counts[2], "mapped": mapped}


def run(spark: SparkSession, config: Config, lexicon: Lexicon = DEFAULT, rerank: Reranker | None = None) -> dict[str, int]:
    """The whole job; results are read back from where they were written, so nothing is done twice."""
    if config.mode != "local" and rerank is None:
        raise ValueError(f"mode {config.mode} needs a reranker")
    out = tables.new_version(config.out)
    names = tables.read_names(tables.read_table(spark, config.names), config.column)
    names.write.parquet(f"{out}/names")  # row numbers hold from here on
    names = spark.read.parquet(f"{out}/names")
    master = tables.read_master(tables.read_table(spark, config.master))
    brands = [r["brand"] for r in tables.read_brands(spark, config.brands).orderBy("brand_ord").collect()]
    classify_phase(names, brands, master, lexicon).write.parquet(f"{out}/classified")
    classified = spark.read.parquet(f"{out}/classified")
    link_phase(classified, master, config, lexicon, rerank if config.mode != "local" else None).write.parquet(f"{out}/linked")
    linked = spark.read.parquet(f"{out}/linked")
    tables.write_results(sheets(classified, linked), out)
    return summary(classified, spark.read.parquet(f"{out}/mapping"))


def answers(lines: Iterable[str], catalogue: Catalogue) -> Iterator[str]:
    """A session by lines: a name is linked, `brands` lists brands, `stats` counts, `exit` ends."""
    for line in lines:
        word = line.strip()
        if word.lower() in ("exit", "quit"):
            return
        if word.lower() == "brands":
            yield ", ".join(catalogue.brands)
        elif word.lower() == "stats":
            yield f"{len(catalogue.brands)} brands, {sum(len(b.items) for b in catalogue.brands.values())} products"
        elif word:
            found = link(word, catalogue)
            yield f"{found.output} ({found.code}) {found.status} {found.confidence} {written(found.suggestions)}".strip()


def main() -> None:
    import sys

    config = Config.of(dict(os.environ), sys.argv[1:])
    for k, v in run(SparkSession.builder.getOrCreate(), replace(config)).items():
        print(f"{k}: {v}")


if __name__ == "__main__":
    main()
