"""The registered queries: each applies one operator, with its usual parameters, to a whole given table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    audit_sql,
    byte_bpe,
    collision_search,
    filter_audit,
    html_text,
    language,
    lm_score,
    near_vectors,
    ngram_join,
    packing,
    quality,
    quality_sql,
    toxicity,
    vector_codes,
    warc,
)
from .common import fold, ship


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}

# Columns of the given tables.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(fn):
        REGISTRY[name] = Query(fn, sql)
        return fn

    return add


@query("op10_quality_rules", quality_sql.SQL)
def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents"))


WARC_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
    sha256(coalesce(html, '')) as payload_digest
  from pages
),
f as (
  select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first_id
  from p
)
select page_id, payload_bytes, payload_digest,
  case when first_id is not null and page_id is distinct from first_id then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from first_id then first_id end as refers_to
from f
"""


@query("op9_warc", WARC_SQL)
def web_archive(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages"))


@query("op8_language")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = language.fit(language.sample(docs))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@query("op5_packing")
def packed(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op7_byte_bpe")
def byte_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = byte_bpe.round_trip(docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op3_toxicity")
def toxic_texts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    machine = toxicity.fit(*toxicity.sample(docs, table(spark, sf, "labels")))
    found = toxicity.score(docs, machine)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query("op4_html_text")
def page_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.main_text(table(spark, sf, "pages"))


@query("op6_ngram_join")
def near_texts(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.link(table(spark, sf, "documents")).drop("uid")


@query("op1_near_vectors")
def near_vectors_of(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors.link(table(spark, sf, "embeddings")).drop("uid")


@query("op2_lm_score")
def lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm_score.score(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op11_nearest_vectors")
def nearest_vectors_of(spark: SparkSession, sf: str) -> DataFrame:
    return collision_search.search(table(spark, sf, "embeddings")).drop("query_uid")


@query("op12_filter_audit", audit_sql.AUDIT_SQL)
def filter_orders(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op13_vector_codes", audit_sql.CODES_SQL)
def vector_codes_of(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf, "embeddings"))
