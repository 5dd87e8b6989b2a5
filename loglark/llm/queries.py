"""One named query per operator, over the whole tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loglark.llm import exact_dedup, hard_negatives, language, lexical_search, main_text, minhash, mixing, packing, pii, quality_trees, rule_ensemble, secret_scan, sharding
from loglark.llm.common import LOWER, UPPER, WORD, documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_extendible_shards(spark, sf):
    return sharding.shard(documents(spark, sf))


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet")


@query
def op2_rule_ensemble(spark, sf):
    return rule_ensemble.quality(documents(spark, sf), labels(spark, sf))


@query
def op3_pii_spans(spark, sf):
    return pii.personal_data(documents(spark, sf))


@query
def op4_language(spark, sf):
    return language.languages(documents(spark, sf))


@query
def op5_minhash(spark, sf):
    return minhash.near_duplicates(documents(spark, sf))


@query
def op6_main_text(spark, sf):
    return main_text.main_text(spark.read.parquet(f"{sf}/pages.parquet"))


@query
def op7_quality_trees(spark, sf):
    return quality_trees.quality_rules(documents(spark, sf), labels(spark, sf))


@query
def op8_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(documents(spark, sf))


@query
def op9_packing(spark, sf):
    return packing.pack(documents(spark, sf))


@query
def op10_mixing(spark, sf):
    columns = ["doc_id", "mix_epoch", "mix_tokens", *[f"mix_{k}" for k in mixing.LEVELS]]
    return mixing.mix(documents(spark, sf)).select(*columns)


@query
def op11_lexical_search(spark, sf):
    return lexical_search.search(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query
def op12_hard_negatives(spark, sf):
    return hard_negatives.mine(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query
def op13_secrets(spark, sf):
    return secret_scan.secrets(documents(spark, sf))


ORACLES = {
    "op1_extendible_shards": sharding.SQL,
    "op5_minhash": f"""
        with recursive t as (
          select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w from documents),
        g as (
          select doc_id, unnest(list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                 else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as s from t),
        n as (select doc_id, count(*) as n from g group by 1),
        i as (select a.doc_id as a, b.doc_id as b, count(*) as c from g a join g b on a.s = b.s and a.doc_id <> b.doc_id group by all),
        l as (select a, b from i join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
        r(a, b) as (select a, b from l union select r.a, l.b from r join l on l.a = r.b),
        m as (select a, min(b) as b from r group by 1)
        select t.doc_id, coalesce(n.n, 0) as n_shingles, least(t.doc_id, coalesce(m.b, t.doc_id)) as component_id,
               t.doc_id = least(t.doc_id, coalesce(m.b, t.doc_id)) as kept
        from t left join n using (doc_id) left join m on m.a = t.doc_id""",
    # The pages of the table have one article each, without tags inside that hold other parts.
    "op6_main_text": r"""
        with a as (
          select page_id, url, regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '(?s)<[^>]*>', ' ', 'g') as t from pages),
        u as (
          select page_id, url, replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') as t from a)
        select page_id, url, coalesce(trim(regexp_replace(t, '\s+', ' ', 'g')), '') as text,
               cast(coalesce(length(trim(regexp_replace(t, '\s+', ' ', 'g'))), 0) as bigint) as n_chars from u""",
    "op8_exact_dedup": f"""
        with d as (select doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) as text_sha256 from documents)
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
               doc_id = max(doc_id) over w as kept, text_sha256
        from d window w as (partition by text_sha256)""",
    "op10_mixing": mixing.SQL,
    "op11_lexical_search": lexical_search.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_secrets": secret_scan.SQL,
}
