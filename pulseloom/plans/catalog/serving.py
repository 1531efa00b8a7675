"""Rule and serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseloom.operators import serving
from pulseloom.operators.capture import assign_surrogate_key
from pulseloom.plans.bindings import table, view
from pulseloom.plans.catalog.kpi import kpi_platform
from pulseloom.plans.registry import query, rounded
from pulseloom.schemas import MODEL_ROWS, SOURCE_ROWS, reference_rows

AS_OF = "2024-01-02 00:00:00"
_POST = ", ".join(serving.POST_COLUMNS)
_RECOMMENDED = """select row_number() over (order by platform_name) as recommendation_id, platform_name,
  'format_engagement' as recommendation_type,
  concat('Prioriser les contenus performants sur ', platform_name, '.') as recommendation_text,
  post_count as evidence_posts, round(median_engagement, 6) as evidence_median,
  round(average_engagement_rate, 6) as evidence_rate, round(average_engagement_rate, 6) as score,
  timestamp '2024-01-02 00:00:00' as generated_at from kpis"""
_THRESHOLD = 50.0
_ALERTED = f"""select row_number() over (order by platform_name) as alert_id, platform_name, 'high_toxicity' as alert_type,
  concat('Surveiller la toxicite moyenne sur ', platform_name, '.') as alert_text, 'HIGH' as severity,
  round(average_toxicity, 6) as evidence_toxicity, timestamp '2024-01-02 00:00:00' as generated_at
  from kpis where average_toxicity >= {_THRESHOLD}"""


def _opened(df, schema: str, names: dict[str, str]):
    """Read the JSON evidence back into columns: number formats differ by engine."""
    parsed = F.from_json("evidence", schema)
    columns = [parsed[k].alias(v) for k, v in names.items()]
    return rounded(df.select("*", *columns).drop("evidence"))


@query("recommendations_build", _RECOMMENDED)
def recommendations_build(spark, sf_dir):
    built = serving.recommendations_build(kpi_platform(spark, sf_dir), F.lit(AS_OF))
    names = {"post_count": "evidence_posts", "median_engagement": "evidence_median", "average_engagement_rate": "evidence_rate"}
    return _opened(built, "post_count bigint, median_engagement double, average_engagement_rate double", names)


@query("alerts_build", _ALERTED)
def alerts_build(spark, sf_dir):
    built = serving.alerts_build(kpi_platform(spark, sf_dir), F.lit(AS_OF), _THRESHOLD)
    return _opened(built, "average_toxicity double", {"average_toxicity": "evidence_toxicity"})


@query("recommendations_ranked", f"select * from ({_RECOMMENDED}) order by score desc, recommendation_id")
def recommendations_ranked(spark, sf_dir):
    return serving.recommendations_ranked(recommendations_build(spark, sf_dir))


@query("alerts_recent", f"select * from ({_ALERTED}) order by generated_at desc, alert_id")
def alerts_recent(spark, sf_dir):
    return serving.alerts_recent(alerts_build(spark, sf_dir))


@query("posts_page", f"select {_POST} from social_posts where source_id = 3 order by post_id limit 50 offset 20")
def posts_page(spark, sf_dir):
    return serving.posts_page(view(spark, sf_dir, "social_posts"), source_id=3, limit=50, offset=20)


@query("posts_page_after", f"select {_POST} from social_posts where platform_id = 2 and post_id > 50 order by post_id limit 50")
def posts_page_after(spark, sf_dir):
    return serving.posts_page(view(spark, sf_dir, "social_posts"), platform_id=2, after_post_id=50)


@query("post_lookup", f"select {_POST} from social_posts where post_id = 7")
def post_lookup(spark, sf_dir):
    return serving.post_lookup(view(spark, sf_dir, "social_posts"), 7)


@query("posts_scoped", f"select {_POST} from social_posts where source_id = 2")
def posts_scoped(spark, sf_dir):
    return serving.posts_scoped(view(spark, sf_dir, "social_posts"), "scoped_admin", 2, limit=None)


@query("posts_scoped_admin", f"select {_POST} from social_posts")
def posts_scoped_admin(spark, sf_dir):
    return serving.posts_scoped(view(spark, sf_dir, "social_posts"), "institution_admin", None, limit=None)


@query(
    "post_predictions",
    """select prediction_id, post_id, model_id, sentiment_label, round(positive_probability, 6) as positive_probability,
         round(negative_probability, 6) as negative_probability, round(neutral_probability, 6) as neutral_probability,
         round(confidence, 6) as confidence from predictions
       where post_id = (select min(doc_id) from labels)""",
)
def post_predictions(spark, sf_dir):
    first = table(spark, sf_dir, "labels").agg(F.min("doc_id")).first()[0]
    return serving.post_predictions(view(spark, sf_dir, "predictions"), first)


@query("sentiment_summary", "select sentiment_label, count(*) as count from predictions group by 1 order by 1")
def sentiment_summary(spark, sf_dir):
    return serving.sentiment_summary(view(spark, sf_dir, "predictions"))


@query(
    "list_sources",
    """select row_number() over (order by source) as source_id, source as source_name, 'public_dataset' as provenance,
         case when count(distinct lang) > 1 then 'multi' else min(lang) end as language from documents group by source
       order by source_id""",
)
def list_sources(spark, sf_dir):
    sources = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("source_name")).agg(
        F.when(F.count_distinct("lang") > 1, "multi").otherwise(F.min("lang")).alias("language")
    )
    keyed = assign_surrogate_key(sources, [F.col("source_name")], "source_id")
    return serving.list_sources(keyed.withColumn("provenance", F.lit("public_dataset")))


@query(
    "list_platforms",
    """select row_number() over (order by o_orderpriority) as platform_id, o_orderpriority as platform_name,
         min(o_orderstatus) as content_type from orders group by o_orderpriority order by platform_id""",
)
def list_platforms(spark, sf_dir):
    platforms = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("platform_name")).agg(
        F.min("o_orderstatus").alias("content_type")
    )
    return serving.list_platforms(assign_surrogate_key(platforms, [F.col("platform_name")], "platform_id"))


def _values(rows, names: str) -> str:
    quoted = ", ".join(f"({r[0]}, '{r[1]}')" for r in rows)
    return f"(values {quoted}) {names}"


@query(
    "model_runs_joined",
    f"""select r.run_id, m.model_name, s.source_name, r.task_type, r.train_rows, r.test_rows, r.run_at from runs r
        join {_values(MODEL_ROWS, "m(model_id, model_name)")} on m.model_id = r.model_id
        join {_values(SOURCE_ROWS, "s(source_id, source_name)")} on s.source_id = r.source_id order by r.run_id""",
)
def model_runs_joined(spark, sf_dir):
    dims = (reference_rows(spark, t) for t in ("dim_model", "dim_source_dataset"))
    return serving.model_runs_joined(view(spark, sf_dir, "runs"), *dims)


@query(
    "run_metrics",
    "select metric_id, run_id, metric_name, metric_value, class_label from metrics where run_id = 7",
)
def run_metrics(spark, sf_dir):
    return serving.run_metrics(view(spark, sf_dir, "runs"), view(spark, sf_dir, "metrics"), 7)


@query(
    "metrics_pivot",
    """select * from (select r.run_id, max(metric_value) filter (where metric_name = 'f1_score') as f1_score,
         max(metric_value) filter (where metric_name = 'mae') as mae,
         max(metric_value) filter (where metric_name = 'rmse') as rmse
       from runs r left join metrics m on m.run_id = r.run_id group by r.run_id) where f1_score is not null""",
)
def metrics_pivot(spark, sf_dir):
    names = ["f1_score", "mae", "rmse"]
    return serving.metrics_pivot(view(spark, sf_dir, "runs"), view(spark, sf_dir, "metrics"), names, required="f1_score")


_STATUS = """select run_id, min(ts) filter (where event = 'start') as started_at, max(trigger_type) as trigger_type,
  max(ts) filter (where event = 'end') as finished_at,
  case when count(*) filter (where event = 'end') = 0 then 'RUNNING' when max(error_type) is not null then 'FAILED'
       else 'SUCCESS' end as status,
  case when max(error_type) is null then max(sources) end as sources_processed,
  case when max(error_type) is null then max(new_rows) end as total_new_rows,
  case when max(error_type) is null then max(updated_rows) end as total_updated_rows,
  case when max(error_type) is not null then concat(max(error_type), ': ', max(error_message)) end as error_message
  from run_events group by run_id"""


@query("run_status", _STATUS)
def run_status(spark, sf_dir):
    return serving.run_status(view(spark, sf_dir, "run_events"))


@query(
    "run_history",
    f"""select run_id, trigger_type, status, started_at,
          round(epoch(finished_at) - epoch(started_at), 6) as duration_seconds,
          coalesce(total_new_rows, 0) as total_new_rows, coalesce(total_updated_rows, 0) as total_updated_rows, error_message
        from ({_STATUS}) order by run_id desc""",
)
def run_history(spark, sf_dir):
    return serving.run_history(run_status(spark, sf_dir), limit=None)
