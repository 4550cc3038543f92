"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baitline.llm import ann, bpe, exact_dedup, html_text, mixing, passages, repeats, simhash, token_counts, toxicity
from baitline.llm.common import table


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_classes(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents")).drop("draw")
    return mixed.withColumn("positions", F.array_join(F.transform("positions", lambda x: x.cast("string")), ","))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), more=())


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; the others are held against plain versions in the tests."""
    return {"op7_exact_dedup": _EXACT, "op8_mixing": _MIXING}


_EXACT = r"""
    with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
    select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
           doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
    from n
"""

_MIXING = r"""
    with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
        cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), text, '')), 1, 15) as bigint) as draw from documents),
    s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as rank from d group by source),
    w as (select *, ((rank - 1) % 3 + 1)::bigint as weight, source_size * 3 as most from s),
    l as (select *, ((sum(source_size) over ())::bigint - coalesce(sum(most) over before, 0)::bigint)::double / ((sum(weight) over ())::bigint - coalesce(sum(weight) over before, 0)::bigint)::double as level
        from w window before as (order by most::double / weight::double, rank rows between unbounded preceding and 1 preceding)),
    t as (select source, source_size, weight, least(most::double, max(level) over () * weight) as target from l),
    p as (select d.*, source_size, weight, target, coalesce(sum(size) over (partition by d.source order by draw, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as before
        from d join t on d.source is not distinct from t.source),
    g as (select *, round(target)::bigint as goal, case when source_size > 0 then round(target)::bigint // source_size else 0 end as passes from p),
    k as (select *, passes * size + least(greatest(goal - passes * source_size - before, 0), size) as taken from g),
    n as (select *, unnest(range(0, (passes + 1)::bigint)) as nth from k where taken > 0),
    f as (select *, (before + nth * source_size)::double / target as share from n where nth < ceil(taken / size)),
    e as (select *, case weight when 1 then (sqrt(greatest(2.25::double + -2.0::double * share, 0.0::double)) - 1.5::double) / -1.0::double when 2 then share
             else (sqrt(greatest(0.25::double + 2.0::double * share, 0.0::double)) - 0.5::double) end as due from f),
    o as (select doc_id, draw, size, source, before, nth, floor(least(greatest(due, 0.0::double), 1.0::double) * 1000000000)::bigint as place from e),
    l2 as (select doc_id, draw, size, source, before, min(place) as position, string_agg(cast(place as varchar), ',' order by nth) as positions from o group by all)
    select k.doc_id, k.source, k.size, k.source_size, k.target, k.taken::bigint as taken, l2.position, coalesce(l2.positions, '') as positions
    from k left join l2 on k.doc_id is not distinct from l2.doc_id and k.draw = l2.draw and k.size = l2.size and k.source is not distinct from l2.source and k.before = l2.before and k.taken > 0
"""
