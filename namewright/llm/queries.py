"""The queries opN_<name> of this subpackage: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, grammar, jaccard_tree, language_mix, lm, packing, quality, tokens, toxicity, warc
from .common import table

BPE = "byte_bpe_50k.json"


def op1_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digests(table(spark, sf_dir, "pages"))


def op2_log_frequency_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_corpus(table(spark, sf_dir, "documents"))


def op3_token_id_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar.encode_corpus(table(spark, sf_dir, "documents"), tokens.vocabulary(BPE))


def op4_jaccard_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_tree.jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokens.vocabulary(BPE))


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mix.identify(table(spark, sf_dir, "documents"))


def op7_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_conflict_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokens.vocabulary(BPE))


def op10_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.risk_controlled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_warc_archive, op2_log_frequency_bloom_lm, op3_token_id_grammar, op4_jaccard_signature_tree, op5_token_counts, op6_language_mixture, op7_benchmark_containment, op8_toxicity_bigru, op9_conflict_best_fit, op10_risk_controlled_quality)}


def _five_words(table_name: str, key: str) -> str:
    """Distinct runs of five words; benchmark items have fifteen words at least."""
    words = f"select {key}, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') as w from {table_name} where {key} is not null"
    return f"select distinct {key}, array_to_string(w[k:k + 4], ' ') as g from (select {key}, w, unnest(generate_series(1, len(w) - 4)) as k from ({words}) a where len(w) >= 5) b"


_FIVE_BITS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * i + 1}, 5))::int >> {b}) & 31) + 1, 1)" for i in range(8) for b in (15, 10, 5, 0))
_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
_SETS = f"""w as (select doc_id, {_WORDS} as w from documents), n as (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) as k from w where len(w) > 0),
  s as (select distinct doc_id, array_to_string(w[k:k + 2], ' ') as g from n), z as (select doc_id, count(*) as n from s group by doc_id)"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc_archive": f"""with p as (select page_id, url, coalesce(html, '') as t, sha1(coalesce(html, '')) as h from pages), m as (select h, max(page_id) as r from p group by h)
      select page_id, octet_length(encode(t))::bigint as payload_bytes, {_FIVE_BITS} as payload_digest, case when page_id = r then 'response' else 'revisit' end as record_type, case when page_id <> r then r end as refers_to, nullif(url, '') as target_uri from p join m using (h)""",
    "op4_jaccard_signature_tree": f"""with recursive {_SETS}, e as (select a.doc_id as x, b.doc_id as y from s a join s b on a.g = b.g and a.doc_id <> b.doc_id join z p on p.doc_id = a.doc_id join z q on q.doc_id = b.doc_id
      group by a.doc_id, b.doc_id, p.n, q.n having 100 * count(*) >= 90 * (p.n + q.n - count(*))), r(x, y) as (select doc_id, doc_id from documents union select r.x, e.y from r join e on r.y = e.x)
      select r.x as doc_id, coalesce(any_value(z.n), 0)::bigint as n_shingles, min(r.y) as component_id from r left join z on z.doc_id = r.x group by r.x""",
    "op7_benchmark_containment": f"""with bs as ({_five_words("benchmark", "item_id")}), n as (select item_id, count(*) as n_shingles from bs group by item_id), ds as ({_five_words("documents", "doc_id")})
      select doc_id, item_id, n_shingles, count(*) as n_found from ds join bs using (g) join n using (item_id) group by doc_id, item_id, n_shingles having 100 * count(*) >= 80 * n_shingles""",
}
