"""One query per operator, over its whole table, with its SQL equivalent where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseloom.llm import (
    alignment,
    byte_bpe,
    exact_dedup,
    importance,
    language,
    minhash,
    packing,
    prefix_forest,
    secret_scan,
    sharding,
    suffix_dedup,
    toxicity,
    warc,
)
from pulseloom.llm.vocabulary import public_pattern, vocabulary_path
from pulseloom.plans.bindings import table
from pulseloom.session import scratch_path, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

SHARDS = 24


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[key] = lambda spark, sf_dir: function(tune(spark), sf_dir)
        if sql is not None:
            CHECKS[key] = sql
        return function

    return register


def remainder(divisor: int) -> Column:
    """CRC-32 of doc_id as text, modulo a divisor; a NULL id counts as an empty text."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % divisor


@query("op1_prefix_forest")
def op1_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query(
    "op2_exact_dedup",
    r"""
    with d as (select doc_id, length(coalesce(text, '')) as chars,
                 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
    r as (select *, row_number() over (partition by text_sha256 order by chars desc, doc_id) as place,
            count(*) over (partition by text_sha256) as group_size from d),
    k as (select text_sha256, doc_id as keep_id from r where place = 1)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from r join k using (text_sha256)
    """,
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"), exact_dedup.fresh_index(spark))


@query("op3_bounded_ring")
def op3_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query("op4_linked_secrets")
def op4_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in secret_scan.KINDS[: secret_scan.STRONG]],
        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


@query(
    "op5_warc_archives",
    """
    with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
    r as (select *, max(page_id) over (partition by h) as newest from p)
    select page_id, payload_bytes,
      array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        cast(((('0x' || substr(h, cast(5 * (i // 4) + 1 as int), 5))::bigint >> cast(15 - 5 * (i % 4) as int)) & 31) + 1 as int), 1)), '')
        as payload_digest,
      case when page_id = newest then 'response' else 'revisit' end as record_type,
      case when page_id <> newest then newest end as refers_to, cast(null as varchar) as problem
    from r
    """,
)
def op5_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.read_archives(manifest, with_payload=False).select(
        warc.page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").alias("refers_to"),
        "problem",
    )


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, vocabulary_path("word_bpe_49k.json")))


@query("op7_unigram_language")
def op7_unigram_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(remainder(3) != 1), vocabulary_path("piece_bpe_32k.model"))
    return language.predict(docs, model).withColumn("held_out", remainder(3) == 1)


@query("op8_weak_toxicity")
def op8_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(remainder(5) != 0))
    scored = docs.select("doc_id", (remainder(5) == 0).alias("held_out"), toxicity.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query(
    "op9_circulant_minhash",
    r"""
    with recursive d as (select doc_id, list_filter(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
          lambda w: w <> '') as w from documents),
    s as (select distinct doc_id, unnest(case when len(w) = 1 then [w[1]] when len(w) = 0 then []
            else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as shingle from d),
    n as (select doc_id, count(*) as n_shingles from s group by doc_id),
    e as (select a.doc_id as a, b.doc_id as b from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id
          join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id group by a.doc_id, b.doc_id
          having 100 * count(*) >= 80 * (any_value(x.n_shingles) + any_value(y.n_shingles) - count(*))),
    both_ways as (select a, b from e union all select b, a from e),
    reach as (select doc_id, doc_id as other from documents union select r.doc_id, t.b from reach r join both_ways t on t.a = r.other),
    c as (select doc_id, min(other) as component_id from reach group by doc_id)
    select doc_id, coalesce(n_shingles, 0) as n_shingles, component_id, doc_id = component_id as kept
    from c left join n using (doc_id)
    """,
)
def op9_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2).drop("text_key")


@query("op10_recursive_bpe")
def op10_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = (vocabulary_path("byte_bpe_multi_50k.tiktoken"), public_pattern())
    decoded = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"), *where), *where)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op11_batched_importance")
def op11_batched_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    drawn, name = importance.resample(docs, target, keep=["doc_id"])
    return drawn.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(name(c)).alias(c) for c in ("n_features", "weight", "score", "rank")])


@query("op12_diagonal_alignment")
def op12_diagonal_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.summarise(docs, vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))


@query("op13_suffix_family")
def op13_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, names = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(names["n_bytes"]).alias("n_bytes"),
        F.col(names["n_removed"]).alias("n_removed"),
        F.size(names["spans"]).cast("long").alias("n_spans"),
        F.sha2(F.col(names["kept"]), 256).alias("kept_sha256"),
    )
