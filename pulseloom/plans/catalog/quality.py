"""Quality and profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseloom.operators import quality
from pulseloom.plans.bindings import STAGED, table, view
from pulseloom.plans.registry import query
from pulseloom.schemas import KEY_COLUMNS
from pulseloom.session import scratch_path

POST_KEYS = ["post_id", "topic", "total_engagement"]


def _row(table_name: str, check: str, failed: str, source: str, passed: str, otherwise: str = "WARN") -> str:
    return f"""select '{table_name}' as table_name, '{check}' as check_name,
      case when {passed} then 'PASS' else '{otherwise}' end as check_result, n as rows_checked, f as rows_failed
      from (select count(*) as n, cast({failed} as bigint) as f from {source})"""


def _count_row(name: str, source: str) -> str:
    return _row(name, "row_count_positive", "case when count(*) > 0 then 0 else 1 end", source, "n > 0", "FAIL")


def _duplicate_row(name: str, columns: list[str], source: str) -> str:
    distinct = f"(select count(*) from (select distinct {', '.join(columns)} from {source}))"
    return _row(name, "duplicate_rate", f"count(*) - {distinct}", source, "f / n < 0.01")


def _null_rows(name: str, columns: list[str], source: str) -> list[str]:
    return [_row(name, f"null_rate_{c}", f"count(*) - count({c})", source, "f / n <= 0.05") for c in columns]


def _negative_rows(name: str, columns: list[str], source: str) -> list[str]:
    return [
        _row(name, f"type_consistency_{c}_non_negative", f"count(*) filter (where {c} < 0)", source, "f = 0")
        for c in columns
    ]


def _range_rows(name: str, source: str) -> list[str]:
    rows = []
    for c, (low, high) in quality.MAIN_CORPUS_BOUNDS.items():
        outside = f"{c} < {low}" + (f" or {c} > {high}" if high is not None else "")
        rows.append(_row(name, f"range_{c}", f"count(*) filter (where {outside})", source, "f = 0"))
    return rows


def _total_row(name: str, source: str) -> str:
    wrong = "count(*) filter (where total_engagement <> likes + shares + comments)"
    return _row(name, "engagement_total_consistent", wrong, source, "f = 0")


def _all(rows: list[str]) -> str:
    return "\nunion all\n".join(rows)


@query("dq_row_count", _count_row("posts", "posts"))
def dq_row_count(spark, sf_dir):
    return quality.run_checks(view(spark, sf_dir, "posts"), "posts", [quality.row_count_check()])


@query("dq_duplicate_rate", _duplicate_row("staging", ["*"], "(select * exclude (ingested_at) from staging_v1)"))
def dq_duplicate_rate(spark, sf_dir):
    """Over all columns but the technical one: most rows are staged twice."""
    staged = view(spark, sf_dir, "staging_v1").drop("ingested_at")
    return quality.run_checks(staged, "staging", [quality.duplicate_check(staged.columns)])


@query("dq_null_rate", _all(_null_rows("posts", POST_KEYS, "posts")))
def dq_null_rate(spark, sf_dir):
    posts = view(spark, sf_dir, "posts")
    return quality.run_checks(posts, "posts", quality.null_checks(posts, [*POST_KEYS, "not_there"]))


_SIGNED = "(select c_custkey, c_acctbal as likes, c_acctbal as score, c_nationkey as views from customer)"


@query("dq_non_negative", _all(_negative_rows("customer", ["likes", "views"], _SIGNED)))
def dq_non_negative(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("likes"), F.col("c_acctbal").alias("score"), F.col("c_nationkey").alias("views")
    )
    return quality.run_checks(customers, "customer", quality.non_negative_checks(customers))


@query("dq_range", _all(_range_rows("posts", "posts")))
def dq_range(spark, sf_dir):
    posts = view(spark, sf_dir, "posts")
    return quality.run_checks(posts, "posts", quality.range_checks(posts, quality.MAIN_CORPUS_BOUNDS))


@query("dq_engagement_consistent", _total_row("posts", "posts"))
def dq_engagement_consistent(spark, sf_dir):
    posts = view(spark, sf_dir, "posts")
    return quality.run_checks(posts, "posts", quality.engagement_check(posts))


_SUITE = _all(
    [
        _count_row("posts", "posts"),
        _duplicate_row("posts", ["*"], "posts"),
        *_null_rows("posts", POST_KEYS, "posts"),
        *_negative_rows("posts", ["likes", "shares", "comments", "views"], "posts"),
        *_range_rows("posts", "posts"),
        _total_row("posts", "posts"),
    ]
)


def suite(spark, sf_dir):
    return quality.quality_suite(view(spark, sf_dir, "posts"), "posts", POST_KEYS, main_corpus=True)


@query("dq_suite", _SUITE)
def dq_suite(spark, sf_dir):
    return suite(spark, sf_dir)


#: The view that stands for each staging table.
_STAGING_VIEWS = {**{t: f"staged_{t}" for t in STAGED}, "raw_multi_platform_posts": "posts", "raw_facebook_comments": "comments"}
_COUNTED = {"raw_youtube_comments": ["likes"], "raw_multi_platform_posts": ["likes", "shares", "comments", "views"], "raw_facebook_comments": ["likes"]}
_MAIN = "raw_multi_platform_posts"


def _table_suite(name: str) -> str:
    source = _STAGING_VIEWS[name]
    rows = [_count_row(name, source), _duplicate_row(name, ["*"], source), *_null_rows(name, KEY_COLUMNS[name], source)]
    rows += _negative_rows(name, _COUNTED.get(name, []), source)
    return _all(rows + ([*_range_rows(name, source), _total_row(name, source)] if name == _MAIN else []))


@query("dq_suite_tables", _all([_table_suite(name) for name in KEY_COLUMNS]))
def dq_suite_tables(spark, sf_dir):
    """Every staging table with its declared key columns."""
    tables = {name: view(spark, sf_dir, _STAGING_VIEWS[name]) for name in KEY_COLUMNS}
    return quality.quality_of_tables(tables, KEY_COLUMNS, _MAIN)


_EXPECTED = {"orders.csv": ["o_orderkey", "o_orderpriority", "o_orderdate"], "events.csv": ["event_id", "event_type", "ts"]}
_DATES = ["o_orderdate", "ts"]


@query(
    "audit_files",
    _all(
        [
            f"""select '{f}' as file_name, 'PRESENT' as status, '{c}' as column_name, count(*) as row_count, {len(cs)} as column_count,
                  count(*) - count({c}) as missing_count, {f'min({c})' if c in _DATES else 'null::timestamp'} as first_date,
                  {f'max({c})' if c in _DATES else 'null::timestamp'} as last_date from {f.split('.')[0]}"""
            for f, cs in _EXPECTED.items()
            for c in cs
        ]
    )
    + " union all select 'reviews.csv', 'MISSING', null, null, null, null, null, null",
)
def audit_files(spark, sf_dir):
    """Two delivered files and one that is not there."""
    folder = scratch_path(spark, "delivered")
    for name, columns in _EXPECTED.items():
        table(spark, sf_dir, name.split(".")[0]).select(*columns).write.options(
            header=True, quote='"', escape='"', timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        ).csv(f"{folder}/{name}")
    datasets = {name: {"date_columns": _DATES, "multi_line": False} for name in [*_EXPECTED, "reviews.csv"]}
    return quality.audit_report(spark, folder, datasets)


_PROFILED = ["plateforme", "id_commentaire", "id_publication", "pseudo_auteur", "texte", "date_commentaire", "langue",
             "texte_publication", "date_publication", "type_contenu", "ecole", "likes", "partages", "vues",
             "nb_commentaires"]


@query(
    "profile_columns",
    _all(
        [
            f"""select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
                  count(distinct {c}) as distinct_count, substring(min(cast({c} as varchar)), 1, 40) as sample_value,
                  round(100.0::double * (count(*) - count({c})) / count(*), 6) as null_percent,
                  100.0::double * (count(*) - count({c})) / count(*) > 50 as mostly_null from comments"""
            for c in _PROFILED
        ]
    ),
)
def profile_columns(spark, sf_dir):
    return quality.profile_columns(view(spark, sf_dir, "comments"))


@query(
    "diagnose_empty_columns",
    """select case when e = 1 then 'INFO' else 'WARN' end as severity, cast(e as int) as empty_count, 'class_label' as empty_columns
       from (select case when count(class_label) = 0 then 1 else 0 end as e from metrics) where e > 0""",
)
def diagnose_empty_columns(spark, sf_dir):
    return quality.diagnose_empty_columns(view(spark, sf_dir, "metrics"))


@query(
    "diagnose_wrong_names",
    """select 'WARN' as severity, 2 as empty_count, 'comments, shares' as empty_columns
       from (select count(*) as n from staging_v1) where n > 0""",
)
def diagnose_wrong_names(spark, sf_dir):
    missing = [F.lit(None).cast("long").alias(c) for c in ("comments", "shares")]
    return quality.diagnose_empty_columns(view(spark, sf_dir, "staging_v1").select("comment_id", *missing))


_AUDITED = _PROFILED


@query(
    "audit_dataset",
    _all(
        [
            f"""select '{c}' as column_name, count(*) as row_count, {len(_AUDITED)} as column_count,
                  count(*) - count({c}) as missing_count,
                  {f'min({c})' if c.startswith('date') else 'null::timestamp'} as first_date,
                  {f'max({c})' if c.startswith('date') else 'null::timestamp'} as last_date from comments"""
            for c in _AUDITED
        ]
    ),
)
def audit_dataset(spark, sf_dir):
    return quality.audit_dataset(view(spark, sf_dir, "comments"), ["date_commentaire", "date_publication"])


@query("dq_result_counts", f"select check_result, count(*) as check_count from ({_SUITE}) group by check_result")
def dq_result_counts(spark, sf_dir):
    return quality.dq_result_counts(suite(spark, sf_dir))


@query(
    "dq_log_newest",
    f"""select row_number() over (order by check_name) as check_id, table_name, check_name, check_result, rows_checked,
          rows_failed from ({_SUITE}) order by check_id desc""",
)
def dq_log_newest(spark, sf_dir):
    from pulseloom.operators.capture import assign_surrogate_key

    return quality.dq_log_newest(assign_surrogate_key(suite(spark, sf_dir), [F.col("check_name")], "check_id"))
