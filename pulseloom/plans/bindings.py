"""Views that give the supplied tables the shape of the operators' inputs.

Each view is one SQL text for Spark and for the checking engine. Only the two
dialect spellings below differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from pulseloom.operators.themes import Taxonomy
from pulseloom.session import tune

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

# Invented prose needs a taxonomy of its own; the themes stand in order of priority.
TAXONOMY = Taxonomy(
    {
        "licence": ["mit license", "apache license", "public license"],
        "annonce": ["ther", "than", "then", "thing"],
        "generique": ["that", "with", "this", "from"],
        "francais": ["où", "été", "éaux", "la", "une"],
    }
)

POSTS = """
select cast(o_orderkey as string) as post_id, o_orderpriority as platform, o_orderdate as published_at,
  o_custkey % 5000 + 1 as followers, o_custkey % 3650 as account_age_days, c_acctbal > 5000 as verified,
  case when o_orderkey % 31 = 0 then null else c_mktsegment end as topic, lower(r_name) as language,
  o_orderstatus as media_type, o_orderkey % 500 as content_length, l.shares as num_hashtags,
  case when o_orderkey % 101 > 66 then 'positive' when o_orderkey % 101 > 33 then 'neutral' else 'negative' end
    as sentiment_category,
  (o_orderkey % 101) / 1e2 as sentiment_positive, (100 - o_orderkey % 101) / 2e2 as sentiment_negative,
  (100 - o_orderkey % 101) / 2e2 as sentiment_neutral,
  l.likes, l.shares, l.comments, cast(round(o_totalprice) as bigint) as views,
  l.likes + l.shares + l.comments + case when o_orderkey % 97 = 0 then 1 else 0 end as total_engagement,
  (l.likes + l.shares + l.comments) * 1e3 / (o_custkey % 5000 + 1) as engagement_rate_per_1k_followers,
  o_orderkey % 720 * 1e0 as hours_since_post, (l.likes + l.shares + l.comments) / 1e2 as viral_coefficient,
  (o_orderkey % 7) / 6e0 as cross_platform_spread,
  case when o_orderkey % 211 = 0 then 101.5e0 else l.disc * 1e1 / l.shares end as toxicity_score
from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
join region on r_regionkey = n_regionkey
left join (select l_orderkey, cast(sum(l_quantity) as bigint) as likes, count(*) as shares,
                  cast(sum(l_linenumber) as bigint) as comments,
                  cast(sum(cast(round(l_discount * 100) as bigint)) as bigint) as disc
           from lineitem group by l_orderkey) l on l_orderkey = o_orderkey
"""

# The one-row count is joined inside, below a projection: on the same level as the
# documents the optimizer may put a delay filter between events and all documents.
COMMENTS = """
select 'facebook' as plateforme, cast(e.event_id as string) as id_commentaire, cast(d.doc_id as string) as id_publication,
  case when e.user_id % 10 = 0 then concat('u', e.user_id) else concat('u', e.user_id, '-', day(e.ts)) end as pseudo_auteur,
  case when e.event_id % 53 = 0 then null when e.event_id % 50 = 0 then '   ' else e.props end as texte,
  e.ts as date_commentaire, d.lang as langue, d.text as texte_publication,
  {ntz} '2024-01-01 00:00:00' + {hours} as date_publication,
  e.event_type as type_contenu, case when d.doc_id % 2 = 0 then 'BBC' else 'CNN' end as ecole,
  d.n_chars as likes, d.doc_id % 50 as partages, d.n_chars * 10 as vues, e.event_id % 100 as nb_commentaires
from (select event_id, ts, user_id, event_type, props, event_id % n.n_docs as doc_ref
      from events cross join (select count(*) as n_docs from documents) n) e
join documents d on d.doc_id = e.doc_ref
"""

PUBLICATIONS = """
select cast(doc_id as string) as id_publication, case when doc_id % 2 = 0 then 'BBC' else 'CNN' end as ecole,
  lang as type_contenu, text as texte_publication,
  {ntz} '2024-01-01 00:00:00' + {hours} as date_publication, n_chars as likes, doc_id % 50 as partages
from documents d
"""

REVIEWS = """
select d.doc_id, d.text, case l.quality when 1 then 'positive' when 0 then 'negative' end as label, d.lang as language,
  (d.n_chars % 1000) / 1e3 as fixed_score,
  case when d.n_chars % 1000 >= 500 then 'positive' else 'negative' end as fixed_prediction
from documents d join labels l on l.doc_id = d.doc_id
"""

# Every key is staged twice; the later row must win, and differs for one in twenty.
STAGING_V1 = """
select cast(o_orderkey as string) as comment_id, o_orderpriority as text, cast(o_custkey % 100 as bigint) as score,
  o_orderdate as created_at, {ntz} '2024-01-01 00:00:00' as ingested_at from orders
union all
select cast(o_orderkey as string), o_orderpriority,
  cast(case when o_orderkey % 20 = 0 then o_custkey % 100 + 1 else o_custkey % 100 end as bigint),
  o_orderdate, {ntz} '2024-01-01 01:00:00' from orders
"""

# The second batch stages every order again: some scores change, some become NULL,
# some rows come under a new key, the rest is as the first batch left it.
STAGING_V2 = """
select cast(case when o_orderkey % 25 = 7 then o_orderkey + 100000000 else o_orderkey end as string) as comment_id,
  o_orderpriority as text,
  cast(case when o_orderkey % 30 = 0 then null when o_orderkey % 10 = 0 then o_custkey % 100 + 7
       when o_orderkey % 20 = 0 then o_custkey % 100 + 1 else o_custkey % 100 end as bigint) as score,
  o_orderdate as created_at, {ntz} '2024-01-02 00:00:00' as ingested_at from orders
"""

# One load attempt per order; the content hash has few values, so most attempts repeat.
ATTEMPTS = """
select o_orderkey as log_id, md5(o_orderpriority) as file_hash, 'raw_reddit' as table_name,
  o_orderkey % 11 = 0 as force, o_orderdate as loaded_at from orders
"""

# One tracked run per order, one metric per line number.
RUNS = """
select o_orderkey as run_id, cast(o_custkey % 12 + 1 as int) as model_id, cast(o_orderkey % 8 + 1 as int) as source_id,
  case when o_orderkey % 3 = 0 then 'sentiment' when o_orderkey % 3 = 1 then 'virality' else 'engagement' end as task_type,
  cast(o_custkey as int) as train_rows, cast(o_custkey % 1000 as int) as test_rows, o_orderdate as run_at
from orders
"""
METRICS = """
select l_orderkey * 10 + l_linenumber as metric_id, l_orderkey as run_id,
  case l_linenumber when 1 then 'f1_score' when 2 then 'precision_macro' when 3 then 'recall_macro'
       when 4 then 'balanced_accuracy' when 5 then 'mae' when 6 then 'rmse' else 'r2' end as metric_name,
  max(l_discount) as metric_value, cast(null as string) as class_label
from lineitem group by l_orderkey, l_linenumber
"""

# Labelled documents as stored predictions.
PREDICTIONS = """
select l.doc_id as prediction_id, l.doc_id as post_id, cast(11 as int) as model_id,
  case l.quality when 1 then 'positive' else 'negative' end as sentiment_label,
  (d.n_chars % 1000) / 1e3 as positive_probability, 1e0 - (d.n_chars % 1000) / 1e3 as negative_probability,
  0e0 as neutral_probability,
  greatest((d.n_chars % 1000) / 1e3, 1e0 - (d.n_chars % 1000) / 1e3) as confidence, false as is_human_validated
from labels l join documents d on d.doc_id = l.doc_id
"""

# Documents as stored posts of three sources.
SOCIAL_POSTS = """
select doc_id as post_id, cast(doc_id % 3 + 2 as int) as source_id, cast(doc_id % 4 + 1 as int) as platform_id,
  cast(doc_id as string) as external_post_id, case when doc_id % 41 = 0 then null else text end as text_content,
  {ntz} '2024-01-01 00:00:00' + {hours} as published_at,
  n_chars as likes, n_chars % 17 as comments, n_chars % 13 as shares, n_chars * 10 as views
from documents d
"""

# Each order is a run: a start event always, an end event unless it is still open.
RUN_EVENTS = """
select o_orderkey as run_id, 'start' as event, o_orderdate as ts,
  case when o_orderkey % 2 = 0 then 'scheduled' else 'manual' end as trigger_type,
  cast(null as string) as error_type, cast(null as string) as error_message,
  cast(null as bigint) as sources, cast(null as bigint) as new_rows, cast(null as bigint) as updated_rows from orders
union all
select l_orderkey, 'end', max(l_shipdate), cast(null as string),
  case when min(l_returnflag) = 'R' then 'ValueError' end, case when min(l_returnflag) = 'R' then min(l_linestatus) end,
  max(l_suppkey), max(l_partkey), cast(max(l_linenumber) as bigint)
from lineitem group by l_orderkey
"""

# Six corpora as they are staged; the other two are the posts and the comments above.
STAGED = {
    "raw_sentiment140": "select doc_id as tweet_id, text, cast(n_chars % 5 as int) as polarity from documents",
    "raw_twitter_fr": "select doc_id as tweet_id, case when doc_id % 9 = 0 then null else text end as text, lang as sentiment from documents",
    "raw_allocine": "select cast(doc_id as string) as review_id, lang as text, quality * 1e0 as rating from labels join documents using (doc_id)",
    "raw_reddit": """select cast(event_id as string) as comment_id, case when event_id % 30 = 0 then null else props end as text,
        cast(user_id % 7 - 3 as int) as score from events""",
    "raw_youtube_comments": "select cast(event_id as string) as comment_id, props as text, cast(event_id % 9 - 1 as int) as likes from events",
    "raw_amazon_reviews": "select cast(l_orderkey as string) as review_id, l_returnflag as text, l_linenumber % 2 as star_rating from lineitem",
}

_SPARK = {"ntz": "timestamp_ntz", "hours": "make_interval(0, 0, 0, 0, cast(d.doc_id * 7 % 240 as int), 0, 0)"}
_CHECK = {"ntz": "timestamp", "hours": "to_hours(cast(d.doc_id * 7 % 240 as int))"}

VIEWS = {
    "posts": POSTS,
    "comments": COMMENTS,
    "publications": PUBLICATIONS,
    "reviews": REVIEWS,
    "staging_v1": STAGING_V1,
    "staging_v2": STAGING_V2,
    "attempts": ATTEMPTS,
    "runs": RUNS,
    "metrics": METRICS,
    "predictions": PREDICTIONS,
    "social_posts": SOCIAL_POSTS,
    "run_events": RUN_EVENTS,
    **{f"staged_{name}": text for name, text in STAGED.items()},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, **instead: DataFrame) -> DataFrame:
    """A bound view; ``instead`` replaces base tables, e.g. by a stream."""
    text = VIEWS[name].format(**_SPARK)
    used = [t for t in TABLES if re.search(rf"\b(?:from|join)\s+{t}\b", text)]
    frames = {t: instead.get(t) if instead.get(t) is not None else table(spark, sf_dir, t) for t in used}
    # Hand the frames over by name: no temporary view is left behind in the session.
    marked = re.sub(rf"\b(from|join)(\s+)({'|'.join(used)})\b", r"\1\2{\3}", text)
    return tune(spark).sql(marked, **frames)


def dealt(df: DataFrame) -> DataFrame:
    """The tables are single files: one task each, until they are dealt over all cores for dear per-row work."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def check_view(name: str) -> str:
    """The same view for the checking engine."""
    return VIEWS[name].format(**_CHECK)
