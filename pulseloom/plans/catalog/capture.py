"""Projection, change capture and warehouse upkeep queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pulseloom.operators import capture
from pulseloom.plans.bindings import TABLES, table, view
from pulseloom.plans.registry import query
from pulseloom.schemas import VERSIONED_FACT
from pulseloom.session import materialise, scratch_path
from pulseloom.sources.ledger import table_status

# score becomes likes, and there are no other counters.
STAGING = (5, 4, ["comment_id", "text", "created_at", "score", None, None, None])
DAY1, DAY2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
_COMMON = """5 as source_id, 4 as platform_id, comment_id as external_post_id, text as text_content,
  created_at as published_at, score as likes, cast(null as bigint) as comments, cast(null as bigint) as shares,
  cast(null as bigint) as views"""


def staged(spark, sf_dir, name):
    mapped = capture.map_to_common(view(spark, sf_dir, name), STAGING)
    return capture.dedupe_latest(mapped).drop("ingested_at")


def first_fact(spark, sf_dir):
    empty = spark.createDataFrame([], VERSIONED_FACT)
    return materialise(capture.scd2_apply(empty, staged(spark, sf_dir, "staging_v1"), F.lit(DAY1)), "fact")


@query("map_to_common", f"select {_COMMON}, ingested_at from staging_v1")
def map_to_common(spark, sf_dir):
    return capture.map_to_common(view(spark, sf_dir, "staging_v1"), STAGING)


@query("dedupe_latest", f"select {_COMMON}, ingested_at from staged1")
def dedupe_latest(spark, sf_dir):
    return capture.dedupe_latest(capture.map_to_common(view(spark, sf_dir, "staging_v1"), STAGING))


@query(
    "current_snapshot",
    """select post_id, comment_id as external_post_id, text as text_content, score as likes, effective_date from fact1""",
)
def current_snapshot(spark, sf_dir):
    fact = capture.current_snapshot(first_fact(spark, sf_dir), 5)
    return fact.select("post_id", "external_post_id", "text_content", "likes", "effective_date")


@query(
    "detect_changes",
    "select comment_id as external_post_id, text as text_content, score as likes, is_update from change2",
)
def detect_changes(spark, sf_dir):
    changes = capture.detect_changes(staged(spark, sf_dir, "staging_v2"), first_fact(spark, sf_dir).where("is_current"))
    return changes.select("external_post_id", "text_content", "likes", "is_update")


@query(
    "scd2_apply",
    """select f.post_id, f.comment_id as external_post_id, f.score as likes, f.effective_date,
         case when u.comment_id is not null then timestamp '2024-01-02 00:00:00' end as expiration_date,
         u.comment_id is null as is_current
       from fact1 f left join (select comment_id from change2 where is_update) u using (comment_id)
       union all
       select (select max(post_id) from fact1) + row_number() over (order by comment_id), comment_id, score,
         timestamp '2024-01-02 00:00:00', null, true from change2""",
)
def scd2_apply(spark, sf_dir):
    fact = first_fact(spark, sf_dir)
    last = fact.agg(F.max("post_id")).first()[0] or 0
    after = capture.scd2_apply(fact, staged(spark, sf_dir, "staging_v2"), F.lit(DAY2), last)
    return after.select("post_id", "external_post_id", "likes", "effective_date", "expiration_date", "is_current")


@query(
    "scd2_summary",
    """select (select count(*) from staging_v2) as staging_rows_raw, (select count(*) from staging_v2) as staging_rows_deduped,
         (select count(*) from change2 where not is_update) as new,
         (select count(*) from change2 where is_update) as updated,
         (select count(*) from staging_v2) - (select count(*) from change2) as unchanged""",
)
def scd2_summary(spark, sf_dir):
    raw = view(spark, sf_dir, "staging_v2")
    return capture.scd2_summary(raw, staged(spark, sf_dir, "staging_v2"), first_fact(spark, sf_dir).where("is_current"))


@query(
    "assign_surrogate_key",
    """select row_number() over (order by l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
         l_extendedprice) as line_id, l_orderkey, l_partkey, l_linenumber from lineitem""",
)
def assign_surrogate_key(spark, sf_dir):
    order = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select(*order)
    keyed = capture.assign_surrogate_key(lines, [F.col(c) for c in order], "line_id")
    return keyed.select("line_id", "l_orderkey", "l_partkey", "l_linenumber")


@query(
    "insert_if_absent",
    """select doc_id, concat(source, ' (labelled)') as source from documents where doc_id in (select doc_id from labels)
       union all select doc_id, source from documents where doc_id not in (select doc_id from labels)""",
)
def insert_if_absent(spark, sf_dir):
    """All documents come twice, in two spellings; each absent one is inserted once."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    labelled = documents.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    existing = labelled.select("doc_id", F.concat("source", F.lit(" (labelled)")).alias("source"))
    twice = documents.unionByName(documents.select("doc_id", F.concat("source", F.lit(" (again)")).alias("source")))
    return capture.insert_if_absent(existing, twice, "doc_id")


@query(
    "check_foreign_key",
    "select doc_id, source, lang from documents where doc_id not in (select doc_id from labels)",
)
def check_foreign_key(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return capture.check_foreign_key(documents, "doc_id", table(spark, sf_dir, "labels"), "doc_id")


@query(
    "check_key_and_not_null",
    """select 'duplicate_key' as violation, 'pseudo_auteur' as column_name, pseudo_auteur as key_value,
         count(*) as row_count from comments where pseudo_auteur is not null group by 3 having count(*) > 1
       union all select 'null_value', 'texte', null, count(*) from comments where texte is null having count(*) > 0""",
)
def check_key_and_not_null(spark, sf_dir):
    return capture.check_key_and_not_null(view(spark, sf_dir, "comments"), "pseudo_auteur", ["texte", "ecole"])


@query(
    "evolve_schema",
    "select *, cast(null as varchar) as loyalty_tier, cast(null as bigint) as referrals from customer",
)
def evolve_schema(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    added = [StructField("loyalty_tier", StringType()), StructField("referrals", LongType())]
    return capture.evolve_schema(customers, StructType([*customers.schema.fields, *added]))


# What the stored tables should have: new columns of one, a table of its own, and one that is complete.
_DECLARED = {
    "customer": "c_custkey bigint, c_name string, loyalty_tier string, referrals bigint",
    "region": "r_regionkey bigint, r_name string",
    "loyalty_card": "card_id bigint, c_custkey bigint",
}
_DECLARED_ROWS = ", ".join(
    f"('{t}', '{part.split()[0]}', '{part.split()[1]}')" for t, ddl in _DECLARED.items() for part in ddl.split(", ")
)


def _stored(spark, sf_dir):
    return {t: f"{sf_dir}/{t}.parquet" for t in _DECLARED}


@query(
    "schema_diff",
    f"""select d.table_name, d.column_name, d.data_type,
          case when d.table_name in (select table_name from information_schema.columns) then 'add_column' else 'create_table' end as action
        from (values {_DECLARED_ROWS}) d(table_name, column_name, data_type)
        where not exists (select 1 from information_schema.columns c where c.table_name = d.table_name and c.column_name = d.column_name)""",
)
def schema_diff(spark, sf_dir):
    """Declared tables against the files there are: a table with missing columns, a missing one, and one with nothing to do."""
    declared = {t: StructType.fromDDL(ddl) for t, ddl in _DECLARED.items()}
    return capture.migrate(spark, declared, _stored(spark, sf_dir))


@query(
    "migrate_tables",
    "select c_custkey, c_name, cast(null as varchar) as loyalty_tier, cast(null as bigint) as referrals, c_nationkey from customer",
)
def migrate_tables(spark, sf_dir):
    """The customers after their table got its missing columns, read from the files."""
    path = scratch_path(spark, "migrate")
    paths = {t: f"{path}/{t}" for t in _DECLARED}
    for t in ("customer", "region"):
        table(spark, sf_dir, t).write.parquet(paths[t])
    capture.migrate(spark, {t: StructType.fromDDL(ddl) for t, ddl in _DECLARED.items()}, paths, dry_run=False)
    customers = spark.read.option("mergeSchema", True).parquet(paths["customer"])
    return customers.select("c_custkey", "c_name", "loyalty_tier", "referrals", "c_nationkey")


@query(
    "table_status",
    " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES),
)
def table_status_query(spark, sf_dir):
    return table_status({t: table(spark, sf_dir, t) for t in TABLES})
